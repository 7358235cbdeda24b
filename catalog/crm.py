"""CRM streams from landed pages, in repeated runs: A14 with A10, K1-K3."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.views import table
from catalog.views_sql import ts
from tidemark.session import scratch
from tidemark.sources import sync

#: Stream: (table, key column).
SOURCES = {
    "Account": ("customer", "c_custkey"),
    "Contact": ("customer", "c_custkey"),
    "Opportunity": ("orders", "o_orderkey"),
    "Lead": ("supplier", "s_suppkey"),
}
FIELDS = "Id string, SystemModstamp timestamp, Name string"
PER_PAGE = 100


def changes(spark, sf, name):
    """A version of every row, and two later ones of every third, within five weeks."""
    of, key = SOURCES[name]
    rows = table(spark, sf, of).selectExpr(f"{key} AS k", f"explode(sequence(0, if({key} % 3 = 0, 2, 0))) AS v")
    return rows.selectExpr(
        "k", "v", f"concat('{name}-', k) AS Id", f"concat('{name} ', k, ' v', v) AS Name",
        "timestamp'2024-01-01 06:30:00' + make_interval(0, 0, 0, cast(k % 20 + 15 * v AS int)) AS at",
    )


def pages(changed):
    """Response pages of at most ``PER_PAGE`` records."""
    stamp = F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    records = changed.withColumn("record", F.to_json(F.struct("Id", stamp.alias("SystemModstamp"), "Name")))
    paged = records.groupBy("v", F.floor(F.col("k") / PER_PAGE).alias("page")).agg(F.collect_list("record").alias("records"))
    return paged.select(F.concat(F.lit('{"data":['), F.array_join("records", ","), F.lit("]}")).alias("body"))


def crm(name):
    of, key = SOURCES[name]

    @query(
        f"a14_{name.lower()}",
        f"""SELECT '{name}-' || k AS Id, '{name} ' || k || ' v' || v AS Name,
          {ts("TIMESTAMP '2024-01-01 06:30:00' + to_days(CAST(k % 20 + 15 * v AS INTEGER))")} AS SystemModstamp, CAST(v + 1 AS BIGINT) AS versions
        FROM (SELECT {key} AS k, CASE WHEN {key} % 3 = 0 THEN 2 ELSE 0 END AS v FROM {of})""",
    )
    def _(spark, sf):
        """Runs after two weeks, after three, and twice at the end: every version is stored once."""
        root = scratch(spark, "crm")
        every = changes(spark, sf, name)
        for until in ("2024-01-15", "2024-01-22", "2025-01-01", "2025-01-01"):
            sync.run_stream(name, sync.page_rows(pages(every.where(F.col("at") < F.lit(until))), FIELDS), root)
        versions = sync.read_history(spark, root, name).groupBy("Id").agg(F.count("*").alias("versions"))
        return sync.latest_rows(spark, root, name).join(versions, "Id").select("Id", "Name", "SystemModstamp", "versions")


for stream in SOURCES:
    crm(stream)
