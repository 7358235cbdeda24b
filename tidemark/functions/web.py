from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import values as V


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, V.URL_HOST, 1)


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, V.URL_PATH, 1)


def referrer_channel(referrer_host: Column, page_host: Column) -> Column:
    """Traffic channel by the first rule that fits; hosts are matched as substrings."""
    direct, search, social, internal, referral = V.CHANNELS
    return (
        F.when(referrer_host == "", direct)
        .when(referrer_host.rlike(V.SEARCH_HOSTS), search)
        .when(referrer_host.rlike(V.SOCIAL_HOSTS), social)
        .when(referrer_host == page_host, internal)
        .otherwise(referral)
    )


def _ipv6_network(ip: Column) -> Column:
    """First three groups of an IPv6 address with the other 80 bits zero; null if malformed.

    A ``::`` is written out first, so that short forms are masked like full ones.
    ``split`` on the double colon gives one part (full form) or two (short form).
    """
    halves = F.split(ip, "::", -1)
    head = F.array_remove(F.split(halves[0], ":", -1), "")
    tail = F.array_remove(F.split(F.coalesce(F.try_element_at(halves, F.lit(2)), F.lit("")), ":", -1), "")
    written = F.size(head) + F.size(tail)
    short = F.size(halves) == 2
    well_formed = ip.rlike(V.IPV6) & ((~short & (written == 8)) | (short & (written <= 7)))
    groups = F.concat(head, F.array_repeat(F.lit("0"), 8 - written), tail)
    kept = F.concat(F.slice(groups, 1, 3), F.array_repeat(F.lit("0"), 5))
    return F.when(well_formed, F.array_join(kept, ":"))


def mask_ip(ip: Column) -> Column:
    """Network part only: /24 for IPv4, /48 for IPv6, null for anything else."""
    return F.when(ip.rlike(V.IPV4), F.regexp_replace(ip, V.IPV4_LAST_OCTET, ".0")).otherwise(_ipv6_network(ip))
