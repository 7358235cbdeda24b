from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import values as V


def lowered(c: Column) -> Column:
    return F.lower(F.trim(c))


def uppered(c: Column) -> Column:
    return F.upper(F.trim(c))


def order_status(c: Column) -> Column:
    """Status words of three storefront languages to one vocabulary."""
    word = F.lower(c)
    pairs = list(V.ORDER_STATUS_WORDS.items())
    chain = reduce(
        lambda acc, kv: acc.when(word.isin(kv[1]), kv[0]),
        pairs[1:],
        F.when(word.isin(pairs[0][1]), pairs[0][0]),
    )
    return chain.otherwise(V.ORDER_STATUS_DEFAULT)


def hash_email(c: Column) -> Column:
    return F.sha2(lowered(c), 256)


def hash_pii(c: Column) -> Column:
    """SHA-256 of a personal value; an empty or missing value has no hash."""
    return F.sha2(F.nullif(c.cast("string"), F.lit("")), 256)


def surrogate_key(*cols: Column | str) -> Column:
    """MD5 over key parts. A single part is hashed as it is; several are joined with a null marker."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    if len(parts) == 1:
        return F.md5(parts[0])
    marked = [F.coalesce(p, F.lit(V.NULL_KEY_MARKER)) for p in parts]
    return F.md5(F.concat_ws("-", *marked))


def row_hash(*cols: Column | str) -> Column:
    """Content hash for change detection: null and empty count as equal."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.md5(F.concat_ws("||", *[F.coalesce(p, F.lit("")) for p in parts]))


def json_field(c: Column, name: str) -> Column:
    """One field of a JSON text column; null for missing fields and broken JSON."""
    return F.get_json_object(c, f"$.{name}")
