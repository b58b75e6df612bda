"""Exact duplicates by deterministic block naming."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACES, load, row_id, sorted_names, written

BLOCK_BYTES = 4096


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None,
                block_bytes: int = BLOCK_BYTES, ignore: str = SPACES) -> DataFrame:
    """One row per input row: ``_row``, ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``name``.

    The text without the characters of ``ignore`` is cut into blocks of ``block_bytes``; sorting names the
    blocks by integers, then adjacent pairs of names are named again until one name is left.  Names compare
    contents, never digests, so equal names mean equal texts.  Of equal texts the row with the most code
    points stays, then the smallest ``id_col`` (nulls last), then the first row.

    Null texts count as empty, empty texts equal each other; repeated rows are copies of which one stays; an
    empty table gives an empty result; other columns are not read.  ``row_col`` names a unique row number of
    the caller; without it rows are numbered in the one scan.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        (F.col(row_col) if row_col else row_id()).alias("_row"), F.col(id_col).alias("doc_id"),
        F.length(text).cast("long").alias("n_chars"),
        F.translate(text, ignore, "").cast("binary").alias("_b"))
    count = F.greatest(F.ceil(F.octet_length("_b") / F.lit(block_bytes)), F.lit(1)).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), F.col("n_blocks") - 1),
                         lambda i: F.substring(F.col("_b"), i * block_bytes + 1, F.lit(block_bytes)))
    blocks = (base.withColumn("n_blocks", count)
              .select("_row", "doc_id", "n_chars", "n_blocks", F.unhex(F.sha2("_b", 256)).alias("_sha"),
                      F.posexplode(pieces).alias("_pos", "_block"))
              # Facts of the document ride on its first block only.
              .select("_row", "n_blocks", "_pos", "_block",
                      *[F.when(F.col("_pos") == 0, F.col(c)).alias(c) for c in ("doc_id", "n_chars", "_sha")]))
    named = sorted_names(blocks, ["_block"], "_row", "name", "blocks")
    facts = named.where("_pos = 0").select("_row", "doc_id", "n_chars", "n_blocks", "_sha", "name")
    left = named.where("n_blocks > 1").select("_row", "_pos", F.col("n_blocks").alias("_n"), "name")
    ends = []
    longest = named.agg(F.max("n_blocks")).first()[0] or 1
    while longest > 1:
        pairs = (left.groupBy("_row", F.expr("_pos div 2").cast("int").alias("_half"))
                 .agg(F.max(F.when(F.col("_pos") % 2 == 0, F.col("name"))).alias("_left"),
                      F.max(F.when(F.col("_pos") % 2 == 1, F.col("name"))).alias("_right"),
                      F.expr("(max(_n) + 1) div 2").cast("int").alias("_n"))
                 .withColumnRenamed("_half", "_pos"))
        named = sorted_names(pairs, ["_left", "_right"], "_row", "name", "pairs")
        ends.append(named.where("_n = 1").select(F.col("_row").alias("_end_row"), F.col("name").alias("_end")))
        left = named.where("_n > 1")
        longest = (longest + 1) // 2
    if ends:
        last = ends[0]
        for e in ends[1:]:
            last = last.unionByName(e)
        many = facts.where("n_blocks > 1").join(last, F.col("_row") == F.col("_end_row"))
        facts = facts.where("n_blocks = 1").unionByName(
            many.withColumn("name", F.col("_end")).select(facts.columns))
    facts = written(facts, "identities")
    # Names are unique among texts with as many blocks.
    best = facts.groupBy("n_blocks", "name").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct((-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"),
                       F.col("doc_id").alias("c"), F.col("_row").alias("d"))).alias("_best"))
    # Only texts with copies are looked up; from a table, so that both sides are shuffled and a large group is split.
    shared = written(best.where("group_size > 1"), "groups")
    return facts.join(shared, ["n_blocks", "name"], "left").select(
        "_row", "doc_id", F.when(F.col("_best").isNull(), F.col("doc_id")).otherwise(F.col("_best.c")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("_row") == F.col("_best.d"), F.lit(True)).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"), "n_blocks", "name")


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup(load(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP1_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n
           FROM documents),
     r AS (SELECT *, count(*) OVER (PARTITION BY n) AS group_size,
                  first_value(doc_id) OVER (PARTITION BY n ORDER BY length(t) DESC, doc_id) AS keep_id FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n) AS text_sha256 FROM r
"""

QUERIES = {"op1_exact_dedup": (op1_exact_dedup, OP1_SQL)}
