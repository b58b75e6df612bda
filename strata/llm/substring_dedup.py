"""Repeated word windows, found level by level."""
from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import drop_path, load, ship, written, written_path
from strata.llm.repeats import (content_classes, identified, order_of, removed_runs, repeated_anchors, repeated_windows,
                                segment_table, windows_of, with_candidates, with_items, with_runs)

WINDOW = 50
#: No level looks up strings of fewer words: shorter ones repeat by chance in any language.
START = 12


def levels(window: int = WINDOW, start: int = START) -> list[int]:
    """Lengths that are looked up before whole windows, each half the next (rounded up): 13 and 25 for 50."""
    out = [-(-window // 2)]
    while out[0] > 1 and -(-out[0] // 2) >= start:
        out.insert(0, -(-out[0] // 2))
    return out


def candidates(source: DataFrame, window: int, start: int):
    """For each level its length, the segments of all windows that reached it (and their path), and the survivors."""
    reached, lengths = source, levels(window, start)
    for core in lengths:
        every, path = written_path(segment_table(reached, "words", window, core), "segments")
        segs = repeated_anchors(every, across=True)
        yield core, every, path, segs
        if core != lengths[-1]:
            reached = with_candidates(source, segs)


def level_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                 start: int = START) -> DataFrame:
    """How many windows reach each level of ``substring_dedup`` and survive it: ``length``, ``windows``, ``survivors``."""
    ship(docs.sparkSession)
    out = None
    for core, every, _, segs in candidates(identified(docs, id_col, text_col, None), window, start):
        none = F.lit(0).alias
        row = (every.select("c", none("s")).unionByName(segs.select(none("c"), F.col("c").alias("s")))
               .agg(F.coalesce(F.sum("c"), F.lit(0)).alias("windows"), F.coalesce(F.sum("s"), F.lit(0)).alias("survivors"))
               .select(F.lit(core).alias("length"), "windows", "survivors"))
        out = row if out is None else out.unionByName(row)
    return out


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None,
                    window: int = WINDOW, start: int = START, texts: bool = True) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and, with ``texts``, ``kept``.

    A word goes if a window of ``window`` words that covers it also begins in a document with a smaller id;
    windows are judged on the input.  Level by level (``levels``), each twice as long as the one before: a window
    stays a candidate while its least string of the level's length (by hash; equal windows have equal ones at equal
    places) occurs in a document of another id, and only candidates are extended to the next level.  At the
    last, the whole windows that are left are looked up; segments of equal content count as one before
    that, so copies cost nothing further.  Levels are told by bitmaps of bounded size, which let a few windows more
    through; the last is exact.  Every lookup is an aggregate, so a string that any share of the documents holds
    meets in no single task.

    Null ids are larger than all others and not smaller than each other; ids may be of any type that sorts; rows
    with equal ids do not remove from each other; null and empty texts have no words; an empty table gives an empty
    result; extra columns are not read.  Words and windows compare by 64-bit hashes within equal 64-bit anchors.
    """
    ship(docs.sparkSession)
    source = identified(docs, id_col, text_col, row_col)
    paths = []
    for _, _, path, segs in candidates(source, window, start):
        paths.append(path)
    classes, open_ = content_classes(segs, counted=False)
    partial = repeated_windows(with_items(open_, source, "words", window))
    whole = classes.where(F.col("last") > F.col("at.ord")).select("anchor", "content", F.col("at.ord").alias("least"))
    runs = written(windows_of(segs, whole, partial, order_of(F.col("id")) > F.col("least")), "runs")
    for path in paths:
        drop_path(docs.sparkSession, path)
    kind = dict(docs.dtypes)[id_col]

    def keep(batches):
        for batch in batches:
            n_words, n_removed, digests, kept = [], [], [], []
            for text, found in zip(batch.column("_t"), batch.column("runs").to_pylist()):
                words, at, parts = text.as_py().split(), 0, []
                gone = 0
                for a, b in removed_runs(found, window):
                    parts += words[at:a]
                    gone += b - a
                    at = b
                left = b" ".join(parts + words[at:])
                n_words.append(len(words))
                n_removed.append(gone)
                digests.append(hashlib.sha256(left).hexdigest())
                if texts:
                    kept.append(left.decode())
            yield pa.RecordBatch.from_arrays(
                [*([batch.column("_row")] if row_col else []), batch.column("_id"), pa.array(n_words, pa.int64()),
                 pa.array(n_removed, pa.int64()), pa.array(digests, pa.string()), *([pa.array(kept, pa.string())] if texts else [])],
                names=[*(["_row"] if row_col else []), "doc_id", "n_words", "n_removed", "kept_sha256", *(["kept"] if texts else [])])

    schema = ("_row bigint, " if row_col else "") + f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string" \
        + (", kept string" if texts else "")
    return with_runs(source, runs).mapInArrow(keep, schema)


def op5_substring_dedup(spark, sf_dir):
    return substring_dedup(load(spark, sf_dir, "documents"), texts=False)


QUERIES = {"op5_substring_dedup": (op5_substring_dedup, None)}
