"""Repeated byte strings by suffix arrays of shards."""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import drop_path, load, ship, written, written_path
from strata.llm.repeats import (content_classes, identified, level_wise, removed_runs, repeated_anchors, segment_table,
                                windows_of, with_items, with_runs)
from strata.llm.suffix_array import long_repeats

LENGTH, CORE = 400, 160
#: Strings of one shard, bytes of the shards that are sorted together (sorting takes about 150 times their room), and
#: bytes up to which lengths don't matter.
SHARD_STRINGS = 8
TOGETHER, FEW = 1 << 19, 1 << 17


def _batches(groups: list, together: int):
    """Groups by size, so that what is sorted together is about equally long; a few groups go together anyhow, since a
    scan costs its steps rather than its columns then."""
    groups.sort(key=lambda g: g[0])
    held, longest = [], 0
    for g in groups:
        area = g[0] * (len(held) + 1)
        if held and (area > together or area > FEW and g[0] > 1.4 * held[0][0] + 64):
            yield held
            held = []
        held.append(g)
    if held:
        yield held


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None,
                 length: int = LENGTH, core: int = CORE, shard_strings: int = SHARD_STRINGS, texts: bool = True) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, with ``texts``, ``kept``.

    A byte of the UTF-8 text goes if a string of ``length`` bytes that covers it also begins anywhere else, in the
    same document or another; strings are judged on the input and never cross documents.  ``kept`` is binary,
    as a cut may split a character.

    Only strings with the same anchor (their least substring of ``core`` bytes by hash) can be equal, so the
    segments of one anchor are a shard.  Segments of equal content are counted first and stand in it once; the
    shard's suffix array, by induced sorting, then gives every further repeat from the common prefixes of
    neighbours.  Shards of more than ``shard_strings`` different segments, which grow with the corpus, are not
    gathered: they go through ``level_wise``, with the same verdicts.

    Null and empty texts have no bytes; repeated rows repeat each other; null ids are ids, and ids may be of
    any type that sorts; an empty table gives an empty result; extra columns are not read.  Strings compare by 64-bit hashes within equal 64-bit anchors.
    """
    ship(docs.sparkSession)
    source = identified(docs, id_col, text_col, row_col)
    every, path = written_path(segment_table(source, "bytes", length, core), "segments")
    segs = repeated_anchors(every, across=False)
    classes, open_ = content_classes(segs, counted=True)
    reps = with_items(open_, source, "bytes", length)

    def sort_shards(batches):
        def judge(groups):
            out = ([], [], [], [])
            for some in _batches(groups, TOGETHER):
                for (_, anchor, contents, _), found in zip(some, long_repeats([g[3] for g in some], length)):
                    for content, hit in zip(contents, found):
                        edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
                        for k, end in zip(edge[::2], edge[1::2]):
                            for o, v in zip(out, (anchor, content, int(k), int(end - k))):
                                o.append(v)
            return pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(
                out, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["anchor", "content", "k", "n"])

        groups, held, now = [], 0, None
        for batch in batches:
            for anchor, content, s in zip(*(batch.column(c) for c in ("anchor", "content", "s"))):
                anchor, content = anchor.as_py(), content.as_py()
                if anchor != now:
                    if held > 16 * TOGETHER:
                        yield judge([(sum(map(len, g[3])), *g[1:]) for g in groups])
                        groups, held = [], 0
                    groups.append((0, anchor, [], []))
                    now = anchor
                if groups[-1][2][-1:] != [content]:  # repeated rows give a content twice
                    groups[-1][2].append(content)
                    groups[-1][3].append(s.as_py())
                    held += len(groups[-1][3][-1])
        if groups:
            yield judge([(sum(map(len, g[3])), *g[1:]) for g in groups])

    small = (reps.where(F.col("contents") <= shard_strings).select("anchor", "content", "s")
             .repartition("anchor").sortWithinPartitions("anchor", "content"))
    by_array = written(small.mapInArrow(sort_shards, "anchor bigint, content bigint, k int, n int"), "by_array")
    by_level = level_wise(reps.where(F.col("contents") > shard_strings), length, core,
                          lambda n, least, own: n > 1)
    whole = classes.where("n > 1").select("anchor", "content", F.lit(0).cast("bigint").alias("least"))
    partial = by_array.unionByName(by_level.select("anchor", "content", "k", F.col("n").cast("int").alias("n")))
    runs = written(windows_of(segs, whole, partial, F.lit(True)), "runs")
    drop_path(docs.sparkSession, path)
    kind = dict(docs.dtypes)[id_col]

    def keep(batches):
        for batch in batches:
            counts, digests, kept = ([], [], []), [], []
            for text, found in zip(batch.column("_t"), batch.column("runs").to_pylist()):
                raw, cuts, at, parts = text.as_py(), removed_runs(found, length), 0, []
                for a, b in cuts:
                    parts.append(raw[at:a])
                    at = b
                parts.append(raw[at:])
                left = b"".join(parts)
                for c, v in zip(counts, (len(raw), len(raw) - len(left), len(cuts))):
                    c.append(v)
                digests.append(hashlib.sha256(left).hexdigest())
                if texts:
                    kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [*([batch.column("_row")] if row_col else []), batch.column("_id"), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array(digests, pa.string()), *([pa.array(kept, pa.binary())] if texts else [])],
                names=[*(["_row"] if row_col else []), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256",
                       *(["kept"] if texts else [])])

    schema = ("_row bigint, " if row_col else "") + \
        f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if texts else "")
    return with_runs(source, runs).mapInArrow(keep, schema)


def op9_suffix_dedup(spark, sf_dir):
    return suffix_dedup(load(spark, sf_dir, "documents"), texts=False)


QUERIES = {"op9_suffix_dedup": (op9_suffix_dedup, None)}
