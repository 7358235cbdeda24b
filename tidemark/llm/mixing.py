"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is cut into ``BLOCKS`` blocks by a hash of the document id. A source's target in words sets how often all
its blocks are taken (whole epochs) and which permuted blocks the last, partial epoch adds; one block is cut at a
document. The units (source, block, epoch) are then split among the output shards by a binary tree: at each node a
fixed number of units goes left, drawn without replacement, so the numbers by source follow a multivariate
hypergeometric distribution and sum up exactly. Documents follow their block; within a shard they are shuffled by
a hash. Everything is decided on a table of sources x blocks x epochs, whose size does not depend on the documents.

Defined results: a null source is a source, last in order; null and empty texts have size 0 and are taken with their
block; repeated rows are documents of their own, which share their fate; an empty table gives no rows; columns
named like a result column are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, md5_hex, text_of, unwrapped, wrapped

BLOCK_HEX = 3
BLOCKS = 16**BLOCK_HEX
SOURCE = ["_none", "_source"]


def words(column: str = "text"):
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source key, source_size, target): all words shared by weight; a target above ``most`` times its source stops
    there and the excess goes to the others by weight, until none is above.

    One row per source. In order of ``most * size / weight``, sources fill up one after the other; the first that
    does not fill under the level of its turn sets the level for all later ones.
    """
    by_source = sized.groupBy(*SOURCE).agg(F.sum("_size").alias("source_size"))
    rank = F.row_number().over(W.orderBy("_none", "_source")) - 1
    given = by_source.withColumn("w", F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(rank, F.lit(len(weights))) + 1))
    given = given.withColumn("cap", F.col("source_size") * most)
    every = W.partitionBy()
    turn = W.orderBy(F.col("cap") / F.col("w"), *SOURCE)
    earlier = turn.rowsBetween(W.unboundedPreceding, -1)
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(earlier), F.lit(0))
    weight = F.sum("w").over(every) - F.coalesce(F.sum("w").over(earlier), F.lit(0))
    levels = given.withColumns({"_rest": rest, "_weight": weight}).withColumn("_level", F.col("_rest") / F.col("_weight"))
    open_level = F.when(F.col("_rest") * F.col("w") <= F.col("cap") * F.col("_weight"), F.col("_level"))
    level = F.first(open_level, ignorenulls=True).over(turn.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    target = F.least(F.col("cap").cast("double"), F.col("w") * level)
    return levels.withColumn("target", F.coalesce(target, F.col("cap").cast("double"))).select(*SOURCE, "source_size", "target")


def decisions(sized: DataFrame, shards: int, weights: tuple[int, ...], most: int) -> DataFrame:
    """One row per source and block: copies of every document, the hash up to which the partial epoch takes
    documents of the block, and the shards of the copies."""
    goal = targets(sized, weights, most).withColumn(
        "_epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    ).withColumn("_quota", F.col("target") - F.col("_epochs") * F.col("source_size"))
    blocks = sized.groupBy(*SOURCE, "_block").agg(F.sum("_size").alias("_words"))
    blocks = blocks.join(goal, SOURCE)
    permuted = W.partitionBy(*SOURCE).orderBy(md5_hex(F.lit("block"), "_source", "_block"), "_block")
    blocks = blocks.withColumn("_end", F.sum("_words").over(permuted.rowsBetween(W.unboundedPreceding, 0)))
    blocks = blocks.withColumn("_start", F.col("_end") - F.col("_words"))
    blocks = blocks.withColumn("_cut_here", (F.col("_start") < F.col("_quota")) & (F.col("_quota") < F.col("_end")))
    # The one block of a source that the quota cuts: documents in hash order, up to the middle of the one at the edge.
    edge = sized.join(blocks.where("_cut_here").select(*SOURCE, "_block", "_start", "_quota"), [*SOURCE, "_block"])
    run = F.sum("_size").over(W.partitionBy(*SOURCE, "_block").orderBy("_hash").rowsBetween(W.unboundedPreceding, 0))
    edge = edge.withColumn("_run", run)
    middle = 2 * (F.col("_start") + F.col("_run")) - F.col("_size")
    cuts = edge.where(middle < 2 * F.col("_quota")).groupBy(*SOURCE, "_block").agg(F.max("_hash").alias("_cut"))
    blocks = blocks.join(cuts, [*SOURCE, "_block"], "left")
    partial = F.when(F.col("_end") <= F.col("_quota"), F.lit("g")).when(F.col("_cut_here"), F.coalesce("_cut", F.lit(""))).otherwise(F.lit(""))
    blocks = blocks.withColumn("_upto", partial)
    units = blocks.select(*SOURCE, "_block", F.explode(F.sequence(F.lit(1), F.col("_epochs") + 1)).alias("_epoch"), "_epochs", "_upto")
    units = split(units.where("_epoch <= _epochs or _upto <> ''"), shards)
    placed = units.groupBy(*SOURCE, "_block").agg(F.array_sort(F.collect_list(F.struct("_epoch", "_shard"))).alias("_units"))
    out = blocks.join(placed, [*SOURCE, "_block"], "left")
    return out.select(*SOURCE, "_block", "source_size", "target", "_epochs", "_upto", F.col("_units._shard").alias("_shards"))


def split(units: DataFrame, shards: int) -> DataFrame:
    """The splitting tree over the units: a node of shards [low, high) sends the share of its left half, rounded down,
    to the left. Levels are as many as the shards have binary digits."""
    out = units.withColumns({"_shard": F.lit(0), "_high": F.lit(shards)})
    for level in range((shards - 1).bit_length()):
        node = W.partitionBy("_shard")
        drawn = F.row_number().over(node.orderBy(md5_hex(F.lit(f"level{level}"), "_source", "_block", "_epoch"), *SOURCE, "_block", "_epoch"))
        width = F.col("_high") - F.col("_shard")
        half = F.floor((width + 1) / 2).cast("int")
        share = F.floor(F.count("*").over(node) * half / width)
        left = (drawn <= share) | (width == 1)
        out = out.withColumn("_left", left).select(
            *units.columns,
            F.when(F.col("_left"), F.col("_shard")).otherwise(F.col("_shard") + half).alias("_shard"),
            F.when(F.col("_left") & (width > 1), F.col("_shard") + half).otherwise(F.col("_high")).alias("_high"),
        )
    return out.select(*units.columns, "_shard")


def plan(docs: DataFrame, shards: int = 8, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``docs`` with size, source_size, target, copies and ``shards``, the shard of each copy."""
    rows = wrapped(docs).withColumns({
        "_none": F.col("row.source").isNull(),
        "_source": F.coalesce("row.source", F.lit("")),
        "_hash": md5_hex(F.col("row.doc_id").cast("string")),
        "_size": words("row.text"),
    })
    rows = rows.withColumn("_block", F.substring("_hash", 1, BLOCK_HEX))
    sized = rows.select(*SOURCE, "_hash", "_size", "_block")
    decided = decisions(sized, shards, weights, most)
    out = rows.join(decided, [*SOURCE, "_block"])
    copies = F.col("_epochs") + F.when(F.col("_hash") <= F.col("_upto"), 1).otherwise(0)
    out = out.withColumn("_copies", copies)
    mine = F.slice("_shards", F.lit(1), F.col("_copies"))
    return unwrapped(out, docs.columns, size="_size", source_size="source_size", target="target", copies="_copies", shards=F.coalesce(mine, F.array().cast("array<int>")))


def draw(planned: DataFrame, columns: list[str]) -> DataFrame:
    """The mixed rows: one per copy, with its shard and, as ``position``, a hash that shuffles the shard locally."""
    copies = planned.select(*columns, F.posexplode("shards").alias("epoch", "shard"))
    return copies.withColumn("position", F.xxhash64("doc_id", "epoch", "shard")).select(*columns, "shard", "position")


def op7_mix(docs: DataFrame) -> DataFrame:
    taken = (F.col("size") * F.col("copies")).cast("long")
    return plan(docs).select("doc_id", "size", "source_size", "target", taken.alias("taken"), F.array_join("shards", ",").alias("shards"))


OP7_SQL = """
WITH sized AS (
  SELECT doc_id, source IS NULL AS none, coalesce(source, '') AS src, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) AS BIGINT) AS size
  FROM documents),
by_source AS (SELECT none, src, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY ALL),
weighed AS (SELECT *, 1 + (row_number() OVER (ORDER BY none, src) - 1) % 3 AS w, 3 * source_size AS cap FROM by_source),
turns AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) AS rest,
    (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS ws
  FROM weighed WINDOW before AS (ORDER BY cap / w, none, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min(CAST(rest AS DOUBLE) / CAST(ws AS DOUBLE), (cap / w, none, src)) AS lv FROM turns WHERE rest * w <= cap * ws),
goal AS (
  SELECT none, src, source_size, coalesce(least(CAST(cap AS DOUBLE), w * lv), CAST(cap AS DOUBLE)) AS target
  FROM turns, level),
goals AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS INTEGER) ELSE 0 END AS epochs,
    target - (CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS INTEGER) ELSE 0 END) * source_size AS quota
  FROM goal),
ordered AS (
  SELECT s.*, substr(h, 1, 3) AS block, sum(size) OVER (
    PARTITION BY s.none, s.src ORDER BY md5('block:' || s.src || ':' || substr(h, 1, 3)), substr(h, 1, 3), h, doc_id) AS run,
    source_size, target, epochs, quota
  FROM sized s JOIN goals g ON s.none = g.none AND s.src = g.src),
chosen AS (
  SELECT *, sum(size) OVER (PARTITION BY none, src, block) AS block_words,
    max(run) OVER (PARTITION BY none, src, block) AS block_end FROM ordered),
fated AS (
  SELECT *, epochs + CASE WHEN block_end <= quota THEN 1
      WHEN block_end - block_words < quota AND h <= max(CASE WHEN 2 * run - size < 2 * quota THEN h END) OVER (PARTITION BY none, src, block)
      THEN 1 ELSE 0 END AS copies
  FROM chosen),
units AS (
  SELECT DISTINCT none, src, block, unnest(range(1, most + 1)) AS epoch
  FROM (SELECT none, src, block, max(copies) AS most FROM fated GROUP BY ALL)),
t0 AS (SELECT *, row_number() OVER (ORDER BY md5('level0:' || src || ':' || block || ':' || epoch), none, src, block, epoch)
    > floor(count(*) OVER () / 2) AS r0 FROM units),
t1 AS (SELECT *, row_number() OVER (PARTITION BY r0 ORDER BY md5('level1:' || src || ':' || block || ':' || epoch), none, src, block, epoch)
    > floor(count(*) OVER (PARTITION BY r0) / 2) AS r1 FROM t0),
t2 AS (SELECT *, row_number() OVER (PARTITION BY r0, r1 ORDER BY md5('level2:' || src || ':' || block || ':' || epoch), none, src, block, epoch)
    > floor(count(*) OVER (PARTITION BY r0, r1) / 2) AS r2 FROM t1),
placed AS (SELECT none, src, block, list(4 * r0::INT + 2 * r1::INT + r2::INT ORDER BY epoch) AS shards FROM t2 GROUP BY ALL)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken,
  coalesce(array_to_string(shards[1:copies], ','), '') AS shards
FROM fated f LEFT JOIN placed p ON f.none = p.none AND f.src = p.src AND f.block = p.block
"""
