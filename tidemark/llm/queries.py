"""The registered queries of the corpus operators: thin, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from catalog.registry import prepared
from tidemark.llm import chat, decontamination, exact_dedup, jaccard_join, mixing, repeats, scoring, sharding, spelling, token_files, toxicity, vector_codes, web_archives
from tidemark.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def texts_prepared(spark: SparkSession) -> SparkSession:
    """A session whose Arrow batches stay small when texts are long."""
    prepared(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(texts_prepared(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op2_shard")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op2_shard(read(spark, sf_dir, "documents"))


@query("op5_chat", chat.OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op5_chat(read(spark, sf_dir, "conversations"))


@query("op7_mix", mixing.OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op7_mix(read(spark, sf_dir, "documents"))


@query("op10_exact_dedup", exact_dedup.OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.op10_exact_dedup(spark, f"{sf_dir}/documents.parquet")


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op3_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op4_tokens")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.op4_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_decontaminate")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.op9_decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op8_jaccard")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.op8_jaccard(read(spark, sf_dir, "documents"))


@query("op6_repeats")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.op6_repeats(read(spark, sf_dir, "documents"))


@query("op1_score")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.op1_score(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query("op11_warc", web_archives.OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web_archives.op11_warc(read(spark, sf_dir, "pages"))


@query("op12_vector_codes", vector_codes.OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.op12_vector_codes(read(spark, sf_dir, "embeddings"))


@query("op13_spelling")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.op13_spelling(read(spark, sf_dir, "documents"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)
