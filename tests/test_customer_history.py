"""Account and profile versions as one history, against a walk over each customer's changes."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.test_skew import settings
from tidemark.plans import dimensions

T0 = dt.datetime(2024, 1, 1)
FIXED = ("email_hashed", "first_name", "last_name", "country_code", "acquisition_channel")
ACCOUNT = "customer_id string, city string, customer_segment string, crm_updated_at timestamp_ntz, has_left boolean"
PROFILE = "customer_id string, loyalty_tier string, phone_hash string, changed_at timestamp_ntz"


def logs(spark, accounts, profiles):
    full = spark.createDataFrame(accounts, ACCOUNT).withColumns({c: F.lit("x") for c in FIXED}).withColumn("acquisition_date", F.lit(None).cast("date"))
    return full.repartition(3), spark.createDataFrame(profiles, PROFILE).repartition(3)


def rows_of(dim):
    return sorted((r.customer_id, r.valid_from, r.valid_to, r.city, r.customer_segment, r.loyalty_tier, r.phone_hash, r.is_current) for r in dim.collect())


def walked(accounts, profiles):
    """Intervals by definition: at each change the last version of both; unchanged ones dropped; none while the customer is gone."""
    out = []
    for customer in {r[0] for r in accounts}:
        mine = {r[3]: r for r in accounts if r[0] == customer}
        theirs = {r[3]: r for r in profiles if r[0] == customer}
        account, profile, states = None, (None,) * 4, []
        for moment in sorted({*mine, *theirs}):
            account, profile = mine.get(moment, account), theirs.get(moment, profile)
            if account is None:
                continue
            state = None if account[4] else (account[1], account[2], profile[1], profile[2])
            if not states or states[-1][1] != state:
                states.append((moment, state))
        for n, (moment, state) in enumerate(states):
            end = states[n + 1][0] if n + 1 < len(states) else None
            if state:
                out.append((customer, moment, end, *state, end is None))
    return sorted(out, key=str)


def made(seed, customers=12, changes=120, hot=0.4):
    rng = random.Random(seed)
    pick = lambda: "hot" if rng.random() < hot else f"c{rng.randrange(customers)}"
    moments = lambda: T0 + dt.timedelta(hours=rng.randrange(200))
    accounts = {(c, t): (c, rng.choice(["Paris", "Rome"]), rng.choice(["mid", "low"]), t, rng.random() < 0.15) for _ in range(changes) for c, t in [(pick(), moments())]}
    profiles = {(c, t): (c, rng.choice(["gold", "silver", None]), rng.choice(["p", "q", None]), t) for _ in range(changes) for c, t in [(pick(), moments())]}
    return list(accounts.values()), list(profiles.values())


@pytest.mark.parametrize("seed, partitions", [(1, 1), (2, 16)])
def test_history_matches_the_walk(spark, seed, partitions):
    accounts, profiles = made(seed)
    with settings(spark, spark__sql__shuffle__partitions=str(partitions), spark__sql__adaptive__coalescePartitions__enabled="false"):
        dim = dimensions.dim_customers_scd2(dimensions.with_profile_history(*logs(spark, accounts, profiles)))
        got = rows_of(dim)
    assert sorted(got, key=str) == walked(accounts, profiles)
    assert len({r.customer_sk for r in dim.collect()}) == len(got)


def test_refresh_of_touched_customers_equals_a_full_build(spark):
    accounts, profiles = made(3)
    # Everything of ten hours, anywhere in time, arrives late.
    late = lambda r: r[3].hour < 10
    old = logs(spark, [r for r in accounts if not late(r)], [r for r in profiles if not late(r)])
    existing = dimensions.dim_customers_scd2(dimensions.with_profile_history(*old))
    whole = logs(spark, accounts, profiles)
    touched = spark.createDataFrame([(r[0],) for r in (*accounts, *profiles) if late(r)] + [(None,)], "customer_id string")
    fresh = dimensions.refresh_customers(existing, *whole, touched)
    assert sorted(rows_of(fresh), key=str) == walked(accounts, profiles)
    untouched = {r[0] for r in (*accounts, *profiles)} - {r.customer_id for r in touched.collect()}
    one = dimensions.refresh_customers(existing, *whole, touched.filter("customer_id = 'hot'"))
    assert {r for r in rows_of(one) if r[0] != "hot"} == {r for r in rows_of(existing) if r[0] != "hot"} and "hot" not in untouched


def test_odd_rows(spark):
    accounts = [("a", "Paris", "mid", T0, False), ("a", "Paris", "mid", T0, False), (None, "X", "mid", T0, False)]
    profiles = [("a", "gold", "p", T0), ("a", "gold", "p", T0), ("b", "gold", "p", T0), (None, "gold", "p", T0), ("a", None, None, T0 + dt.timedelta(1))]
    got = rows_of(dimensions.dim_customers_scd2(dimensions.with_profile_history(*logs(spark, accounts, profiles))))
    later = T0 + dt.timedelta(1)
    assert got == [("a", T0, later, "Paris", "mid", "gold", "p", False), ("a", later, None, "Paris", "mid", None, None, True)]
    # Without profiles the account's history stands alone; without accounts there is none.
    alone = rows_of(dimensions.dim_customers_scd2(dimensions.with_profile_history(*logs(spark, accounts[:1], []))))
    assert alone == [("a", T0, None, "Paris", "mid", None, None, True)]
    assert dimensions.dim_customers_scd2(dimensions.with_profile_history(*logs(spark, [], profiles))).count() == 0
