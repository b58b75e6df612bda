"""Corpus pipeline: five stages over ``documents``, each a Parquet table that the next one reads."""
from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import exact_dedup, jaccard_join, language_id, mixing, sentencepiece_bpe
from strata.llm.common import drop_path, load, made, row_id, written
from strata.session import scratch_path

#: Words of a shingle and percent of similarity of near duplicates.
SHINGLE, PERCENT = 5, 80


_left: dict[str, list[str]] = {}


def _stage(function):
    """Scratch tables of a stage go when the next one begins: a stage's result is a table by then."""
    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for path in _left.pop(spark.sparkContext.applicationId, []):
            drop_path(spark, path)
        before = len(made)
        out = function(spark, docs, sf_dir)
        _left[spark.sparkContext.applicationId] = made[before:]
        return out

    return run_stage


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a row number under a name that it doesn't have, as a table, so that all reads agree on it."""
    name = "_strata_row"
    while any(c.lower().startswith(name) for c in docs.columns):
        name += "_"
    return written(docs.withColumn(name, row_id()), "numbered"), name


def _without(numbered: DataFrame, row: str, dropped: DataFrame) -> DataFrame:
    return numbered.join(dropped.select(F.col("_row").alias(row)), row, "left_anti").drop(row)


@_stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that get a language; those that are null or hold no letter are rejected."""
    net = language_id.train(docs)
    numbered, row = _numbered(docs)
    found = language_id.predict(numbered, net, row_col=row)
    return _without(numbered, row, found.where(F.col("lang_pred") == "und"))


@_stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, white space apart."""
    numbered, row = _numbered(docs)
    return _without(numbered, row, exact_dedup.exact_dedup(numbered, row_col=row).where(~F.col("kept")))


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similar shingle sets, the one with the smallest id (nulls last)."""
    numbered, row = _numbered(docs)
    linked = written(jaccard_join.similar_sets(numbered, row_col=row, n_words=SHINGLE, percent=PERCENT)
                     .select("_row", "doc_id", "root_row"), "linked")
    first = linked.groupBy("root_row").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(
        F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("_row").alias("c"))).alias("first"))
    several = written(first.where("n > 1").select("root_row", F.col("first.c").alias("stays")), "several")
    return _without(numbered, row, linked.join(several, "root_row").where(F.col("_row") != F.col("stays")))


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    numbered, row = _numbered(docs)
    copies = mixing.mix(numbered, row_col=row).where("copies > 0").select(
        F.col("_row").alias(row), F.col("copies").alias(f"{row}n"))
    times = F.sequence(F.lit(1), F.col(f"{row}n"))
    return numbered.join(copies, row).withColumn(f"{row}n", F.explode(times)).drop(row, f"{row}n")


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document, with digests of the ids and of the decoded text."""
    return sentencepiece_bpe.encode_decode(docs, sentencepiece_bpe.default_model(), digests=True).drop("_row")


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("encode", encode),
]

#: A trained network and a drawn mix aren't SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        result.write.parquet(path := scratch_path(spark, f"stage-{name}"))
        docs = spark.read.schema(result.schema).parquet(path)
    return docs
