"""The registered queries at the smallest scale, and the pipeline's decisions."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm.common import read
from tidemark.llm.queries import ORACLES, QUERIES
from tools import check_oracles

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_every_operator_has_a_query():
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in QUERIES)] == [] and "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name, monkeypatch):
    monkeypatch.setitem(check_oracles.QUERIES, name, QUERIES[name])
    monkeypatch.setitem(check_oracles.ORACLES, name, ORACLES[name])
    ok, note = check_oracles.compare(spark, check_oracles.duck(SF), name, SF)
    assert ok, note


def test_pipeline_decisions(spark):
    docs = read(spark, SF, "documents")
    out = corpus_pipeline.run(spark, SF)
    assert set(docs.columns) <= set(out.columns)
    kept = {r[0] for r in out.select("doc_id").collect()}
    toxic = {r[0] for r in read(spark, SF, "labels").where("toxic = 1").select("doc_id").collect()}
    assert 0 < len(kept) < docs.count() and len(kept & toxic) < 0.5 * len(toxic)


def test_stages_keep_and_drop_rows_with_null_and_repeated_ids(spark, tmp_path):
    from tests.llm.test_operators import words

    a, b, c, leak = (words(80, n) for n in range(1, 5))
    schema = "doc_id long, text string"
    rows = [(2, a), (2, b), (33, b), (None, b), (None, c), (None, c), (5, ""), (None, None), (None, leak), (7, leak)]
    docs = spark.createDataFrame(rows, schema).repartition(3)
    kept = corpus_pipeline.one_of_similar(spark, docs, "").collect()
    assert sorted(map(str, kept)) == sorted(map(str, spark.createDataFrame([(2, a), (2, b), (None, c), (5, ""), (None, None), (7, leak)], schema).collect()))
    spark.createDataFrame([(1, " ".join(leak.split()[10:50]))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = corpus_pipeline.drop_leaks(spark, docs, str(tmp_path)).collect()
    assert len(left) == 8 and not any(r["text"] == leak for r in left)
    assert corpus_pipeline.one_of_similar(spark, docs.limit(0), "").count() == corpus_pipeline.drop_leaks(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_columns_named_like_a_stage_s_own_come_back(spark):
    clashing = ["shard", "target", "size", "source_size", "copies", "shards", "score", "_score", "_row", "_hash", "row", "position", "_column3", "a.b"]
    read_first = spark.range(40).selectExpr("id AS doc_id", "concat('some words of text ', id) AS text", "concat('s', id % 3) AS source")
    docs = read_first.select("*", *[(F.col("doc_id") * 100 + i).alias(c) for i, c in enumerate(clashing)])
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for stage in (corpus_pipeline.one_of_similar, corpus_pipeline.mix_sources):
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.count() > 0
        assert all(r[c] == 100 * r["doc_id"] + i for r in out.collect() for i, c in enumerate(clashing))
    scored = corpus_pipeline.toxicity.score(corpus_pipeline.numbered(docs), corpus_pipeline.toxicity.fit(docs, labels))
    assert {tuple(r) for r in corpus_pipeline.named(scored, docs).collect()} == {tuple(r) for r in docs.collect()}
