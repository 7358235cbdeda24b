"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query is run in full through the ``noop`` sink after one warm-up of the session, and the
best of ``$BENCH_REPEAT`` runs counts. ``silver_10m`` is the Silver chain over the events table
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import views  # noqa: E402
from catalog.all import QUERIES  # noqa: E402
from catalog.registry import AS_OF, DATE  # noqa: E402
from tidemark.operators import events  # noqa: E402
from tidemark.plans import silver  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = [
    "c1_filter_valid", "f1_dedup_first", "i11_silver", "i12_silver_lite", "c8_contract_quarantine",
    "e1_daily_sales", "e3_funnel", "e6_product_performance", "e8_session_stats", "e9_event_summary",
    "i1_stg_orders", "i2_stg_customers", "i6_dim_customers_scd2", "i7_dim_customers", "i8_dim_products",
    "i9_fact_lines", "i10_fact_orders", "d7_orphans", "d8_upsert_newer", "d9_upsert", "k3_append_dedup",
    "f4_order_rank", "j12_silver_suite", "h1_quality_gate", "a10_pages", "b18_extract",
]


def many_events(spark, sf_dir: str, rows: int):
    """Bronze events repeated with distinct ids until there are about ``rows`` of them."""
    base = views.bronze_events(spark, sf_dir)
    times = max(1, rows // max(base.count(), 1))
    # The table is one small file; a real landing has many, so the copies start from many tasks.
    spread = base.repartition(4 * spark.sparkContext.defaultParallelism)
    copies = spread.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(times))))
    return copies.withColumn("event_id", F.concat_ws("-", "event_id", "n")).drop("n")


def silver_six(spark, sf_dir: str):
    """The six operators of the reference's volume test over ten million events, counted."""
    df = many_events(spark, sf_dir, 10_000_000)
    valid = silver.stateless(df, AS_OF)
    return events.parse_revenue(events.anonymise_ip(silver.unique(valid)))


def silver_full(spark, sf_dir: str):
    return silver.silver_events(many_events(spark, sf_dir, 10_000_000), DATE, AS_OF)


def timed(action, repeat: int) -> float:
    best = None
    for _ in range(repeat):
        start = time.perf_counter()
        action()
        spent = time.perf_counter() - start
        best = spent if best is None else min(best, spent)
    return round(best, 3)


def run_all(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = [n for n in sys.argv[1:] if n in QUERIES] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * int(cpus)) if cpus.isdigit() else 16)
    run_all(QUERIES["e3_funnel"](spark, sf_dir))  # warm-up
    results = {n: timed(lambda n=n: run_all(QUERIES[n](spark, sf_dir)), repeat) for n in names}
    if not sys.argv[1:]:
        results["silver_10m_six_operators"] = timed(lambda: silver_six(spark, sf_dir).count(), 1)
        results["silver_10m_full_chain"] = timed(lambda: run_all(silver_full(spark, sf_dir)), 1)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total seconds over headline queries",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
