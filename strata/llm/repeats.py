"""Repeated windows over all documents: segment tables, their classes, and exact verdicts on windows."""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.stats import global_index
from strata.llm import anchors
from strata.llm.common import flat, marked, null_safe, written
from strata.llm.words import prefix_hashes, range_hashes, words

_LAST = (1 << 63) - 1
VERDICT = ["anchor", "content", "k", "n"]


def items(column: pa.Array, unit: str) -> tuple[np.ndarray, np.ndarray]:
    """Items of all texts of a batch (hashes of words, or bytes) and where each text's items begin."""
    data, at = flat(column)
    if unit == "words":
        hashes, _, _, first = words(data, at, lower=False)
        return hashes, first
    return data[at[0]:at[-1]], at - at[0]


#: Bytes of texts that a task works on at once; a longer text goes alone.
PIECE = 1 << 22


def pieces(batches, most: int = PIECE):
    """Batches cut so that each holds at most ``most`` bytes of texts, or one text: numbers made of them (hashes, places)
    take many times their room."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = flat(batch.column("_t"))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(at, at[begin] + most, side="right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end


def identified(docs: DataFrame, id_col: str, text_col: str, row_col: str | None) -> DataFrame:
    """``_id``, its place ``id`` among all ids, ``th`` and the text as bytes: id and text hash name a row in every scan,
    and rows that share both are repeated rows with one result.  Whole numbers are their own place; ids of another
    type are numbered in their order by one sort of the distinct ids."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("th"), text.cast("binary").alias("_t"),
                       *([F.col(row_col).alias("_row")] if row_col else []))
    if isinstance(rows.schema["_id"].dataType, T.IntegralType):
        return rows.withColumn("id", F.col("_id").cast("bigint"))
    ids = written(global_index(rows.select("_id").where(F.col("_id").isNotNull()).distinct(), ["_id"], index_col="id"), "ids")
    return rows.join(ids.withColumnRenamed("_id", "_of"), F.col("_id") == F.col("_of"), "left").drop("_of")


def stretches(runs: pa.Array, first: np.ndarray, length: int):
    """Where the items of the windows in each text's runs begin and end among the items of all texts, neighbouring runs
    as one, and the text of each such stretch."""
    sizes = runs.value_lengths().to_numpy(zero_copy_only=False)
    flat_runs = runs.flatten()
    b, m = (flat_runs.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("b", "m"))
    text = np.repeat(np.arange(len(sizes)), sizes)
    at = np.lexsort((b, text))
    b, m, text = b[at], m[at], text[at]
    new = np.r_[True, (text[1:] != text[:-1]) | (b[1:] != (b + m)[:-1])]
    last = np.r_[new[1:], True]
    begin = first[text[new]] + b[new]
    return begin, first[text[last]] + (b + m)[last] + length - 1, text[new]


def segment_table(source: DataFrame, unit: str, length: int, core: int) -> DataFrame:
    """Segments of all texts: ``id``, ``th``, ``anchor``, ``content``, ``a`` (begin), ``c`` (windows), ``o`` (anchor's offset).

    Where ``source`` has ``runs`` (of windows, (b, m)), only these windows are cut into segments."""
    some = "runs" in source.columns
    chunk = anchors.CHUNK if unit == "words" else anchors.CHUNK >> 2  # a byte takes about 100 times its room

    def cut(batches):
        for batch in pieces(batches):
            values, first = items(batch.column("_t"), unit)
            if some:
                begin, end, of = stretches(batch.column("runs"), first, length)
                starts = np.r_[0, np.cumsum(end - begin)]
                pick = np.repeat(begin - starts[:-1], end - begin) + np.arange(starts[-1])
                text, a, c, o, anchor, content = anchors.segments(values[pick], starts, length, core)
                a, text = a + (begin - first[of])[text], of[text]
            else:
                text, a, c, o, anchor, content = anchors.segments(values, first, length, core, chunk)
            pick = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pick), batch.column("th").take(pick), pa.array(anchor, pa.int64()),
                 pa.array(content, pa.int64()), pa.array(a.astype(np.int32)), pa.array(c.astype(np.int32)),
                 pa.array(o.astype(np.int32))], names=["id", "th", "anchor", "content", "a", "c", "o"])

    return source.select("id", "th", "_t", *(["runs"] if some else [])).mapInArrow(
        cut, "id bigint, th bigint, anchor bigint, content bigint, a int, c int, o int")


def with_candidates(source: DataFrame, segs: DataFrame) -> DataFrame:
    """Texts with windows in ``segs``, and these windows as ``runs``; no other text is shuffled."""
    runs = written(segs.groupBy("id", "th").agg(F.collect_set(F.struct(F.col("a").alias("b"), F.col("c").alias("m"))).alias("runs")),
                   "candidates")
    key = [F.col("id"), F.col("th")]
    likely = marked(source.select("id", "th", "_t"), key, runs, key).where("_maybe").drop("_maybe")
    return null_safe(likely, runs, ["id", "th"])


def order_of(id_col: Column) -> Column:
    return F.coalesce(id_col, F.lit(_LAST))


def repeated_anchors(segs: DataFrame, across: bool) -> DataFrame:
    """Segments whose anchor occurs again (with another id, if ``across``), and a few others: the anchors are told by a
    bitmap of bounded size, so the other segments, most of all, are never shuffled again."""
    order = order_of(F.col("id"))
    found = F.min(order) < F.max(order) if across else F.count(F.lit(1)) > 1
    again = segs.groupBy("anchor").agg(found.alias("again")).where("again")
    return marked(segs, [F.col("anchor")], again, [F.col("anchor")], bits=27).where("_maybe").drop("_maybe")


def content_classes(segs: DataFrame, counted: bool) -> tuple[DataFrame, DataFrame]:
    """Segments of equal content as one row, with the number of them, least and greatest id; and of these the ones
    whose anchor has several contents, each with one place to read the content from.

    ``counted`` adds the number of contents by a join on anchors.  Without it a bitmap tells the open ones (and lets a
    few others through, which repeat nothing), so an anchor that any share of the contents has goes to no single task.
    """
    one = F.min(F.struct(order_of(F.col("id")).alias("ord"), "th", "a"))
    classes = written(segs.groupBy("anchor", "content").agg(
        F.count(F.lit(1)).alias("n"), one.alias("at"), F.max(order_of(F.col("id"))).alias("last"),
        F.min_by("id", order_of(F.col("id"))).alias("id"), F.first("c").alias("c"), F.first("o").alias("o")), "classes")
    several = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1")
    key = [F.col("anchor")]
    met = classes.join(several, "anchor") if counted else marked(classes, key, several, key, bits=27).where("_maybe")
    open_ = written(met.select(
        "anchor", "content", *(["contents"] if counted else []), "n", F.col("at.ord").alias("ord"), "id",
        F.col("at.th").alias("th"), F.col("at.a").alias("a"), "c", "o"), "open_classes")
    return classes, open_


def with_items(open_: DataFrame, source: DataFrame, unit: str, length: int) -> DataFrame:
    """Content of each open class, read from one of its documents: its bytes (``s``), or the hashes of its windows of
    words (``w``)."""
    types = {"anchor": pa.int64(), "content": pa.int64(), "contents": pa.int64(), "n": pa.int64(), "ord": pa.int64(),
             "a": pa.int32(), "c": pa.int32(), "o": pa.int32()}
    fields = [f for f in types if f in open_.columns]
    per = open_.groupBy("id", "th").agg(F.collect_list(F.struct(*fields)).alias("segs"))
    key = [F.col("id"), F.col("th")]
    likely = marked(source.select("id", "th", "_t"), key, open_, key).where("_maybe").drop("_maybe")
    met = null_safe(likely, per, ["id", "th"]).select("_t", "segs")
    name, kind, held_as = ("w", "array<bigint>", pa.list_(pa.int64())) if unit == "words" else ("s", "binary", pa.binary())

    def read(batches):
        for batch in pieces(batches):
            if unit == "words":
                values, first = items(batch.column("_t"), unit)
                prefix = prefix_hashes(values)
            else:
                values, first = flat(batch.column("_t"))
            out = {f: [] for f in fields}
            held = []
            for j, segs in enumerate(batch.column("segs").to_pylist()):
                for s in segs:
                    for f in fields:
                        out[f].append(s[f])
                    a = first[j] + s["a"]
                    if unit == "words":
                        begin = np.arange(a, a + s["c"])
                        held.append(range_hashes(prefix, begin, begin + length).view(np.int64))
                    else:
                        held.append(values[a:a + s["c"] - 1 + length].tobytes())
            yield pa.RecordBatch.from_arrays([*(pa.array(out[f], types[f]) for f in fields), pa.array(held, held_as)],
                                             names=[*fields, name])

    schema = ", ".join(f"{f} {'int' if types[f] == pa.int32() else 'bigint'}" for f in fields)
    return written(met.mapInArrow(read, f"{schema}, {name} {kind}"), "contents")


def repeated_windows(reps: DataFrame) -> DataFrame:
    """Verdicts (``VERDICT``) on the classes with window hashes: windows that a class with a smaller least id has too.

    Windows are counted by aggregates, so no group meets in one task; only repeated ones are shuffled again."""
    rows = reps.select("anchor", "content", "ord", F.posexplode("w").alias("k", "window"))
    at = ["anchor", "window"]
    least = written(rows.groupBy(*at).agg(F.min("ord").alias("least"), F.max("ord").alias("most"))
                    .where("least < most").drop("most"), "repeated_windows")
    key = [F.col(c) for c in at]
    hits = (marked(rows, key, least, key).where("_maybe").join(least, at).where("least < ord")
            .select("anchor", "content", "k").distinct())
    run = F.col("k") - F.row_number().over(Window.partitionBy("anchor", "content").orderBy("k"))  # at most a segment's windows
    return written(hits.withColumn("_run", run).groupBy("anchor", "content", "_run").agg(
        F.min("k").alias("k"), (F.max("k") - F.min("k") + 1).alias("n")).drop("_run"), "verdicts")


def level_wise(reps: DataFrame, length: int, core: int,
               repeated: Callable[[Column, Column, Column], Column]) -> DataFrame:
    """Verdicts (``VERDICT``: windows k .. k + n - 1 of the segments of a class) by extending repeated strings.

    The windows around an anchor, numbered by its offset t, fall into ranges, at first one.  All windows of a range
    share a string, the range's core, and lie in its hull.  Classes with equal hulls are equal there: they are
    judged at once by ``repeated(count, least id, own id)``; one of them goes on for the rest, and the unjudged do.
    Where a core belongs to one hull only, nothing else can be repeated; otherwise the range is halved, which
    extends cores towards the whole window, until no candidates survive.  Each level is a few aggregates and
    joins on (anchor, range, core); rows grow with the classes, not with pairs of them.
    """
    width = length - core + 1
    size = 1
    while size < width:
        size *= 2
    cut = lambda p, n: F.substring(F.col("s"), p + 1, n)
    rows = reps.dropDuplicates(["anchor", "content"]).select(
        "anchor", "content", "n", "ord", "c", "o", "s").withColumn("lo", F.lit(0))
    verdicts = None
    while True:
        rows = rows.withColumn("hi", F.least(F.col("lo") + size, F.lit(width)))
        span = F.col("hi") - F.col("lo")
        full = (F.col("lo") >= F.col("o") - F.col("c") + 1) & (F.col("hi") <= F.col("o") + 1)
        keyed = written(rows.withColumn("core", F.xxhash64(cut(F.col("o") - F.col("lo"), F.lit(length + 1) - span)))
                        .withColumn("full", full)
                        .withColumn("hull", F.when(full, F.xxhash64(cut(F.col("o") - F.col("hi") + 1, span + (length - 1))))
                                    .otherwise(F.col("content"))), "levels")
        at = ["anchor", "lo", "core", "full", "hull"]
        hulls = keyed.groupBy(*at).agg(F.sum("n").alias("_n"), F.min("ord").alias("_ord"),
                                       F.min_by("content", F.struct("ord", "content")).alias("_head"))
        found = keyed.join(hulls, at).where(F.col("full") & repeated(F.col("_n"), F.col("_ord"), F.col("ord"))).select(
            "anchor", "content", (F.col("o") - F.col("hi") + 1).alias("k"), span.alias("n"))
        found = written(found, "verdicts")
        verdicts = found if verdicts is None else verdicts.unionByName(found)
        if size == 1:
            return verdicts
        alive = hulls.groupBy("anchor", "lo", "core").agg(F.count(F.lit(1)).alias("_hulls")).where("_hulls > 1")
        heads = hulls.join(alive.select("anchor", "lo", "core"), ["anchor", "lo", "core"])
        size //= 2
        judged = F.col("full") & repeated(F.col("_n"), F.col("_ord"), F.col("ord"))
        rows = (keyed.join(heads, at).where((F.col("content") == F.col("_head")) | ~judged)
                .select("anchor", "content", F.col("_n").alias("n"), F.col("_ord").alias("ord"), "c", "o", "s",
                        F.explode(F.array(F.col("lo"), F.col("lo") + size)).alias("lo"))
                .where((F.col("lo") < width) & (F.col("lo") <= F.col("o")) & (F.col("lo") + size > F.col("o") - F.col("c") + 1)))


def windows_of(segs: DataFrame, whole: DataFrame, partial: DataFrame, of_row: Column) -> DataFrame:
    """Windows to remove of each document, (begin, number) as ``runs``: all windows of segments in ``whole`` (with
    ``least``, the least id) where ``of_row`` holds, and the judged ones of classes in ``partial``."""
    verdicts = whole.select("anchor", "content", "least", F.lit(0).alias("k"), F.lit(None).cast("int").alias("n")).unionByName(
        partial.select("anchor", "content", F.lit(None).cast("bigint").alias("least"), "k", F.col("n").cast("int")))
    met = segs.join(verdicts, ["anchor", "content"]).where(F.col("n").isNotNull() | of_row)
    return met.select("id", "th", (F.col("a") + F.col("k")).alias("b"), F.coalesce("n", "c").alias("m")).groupBy(
        "id", "th").agg(F.collect_set(F.struct("b", "m")).alias("runs"))


def with_runs(source: DataFrame, runs: DataFrame) -> DataFrame:
    """``source`` with its ``runs``, null without any; only texts that may have some are shuffled for it."""
    key = [F.col("id"), F.col("th")]
    told = marked(source, key, runs, key)
    met = null_safe(told.where("_maybe").drop("_maybe"), runs, ["id", "th"], "left")
    free = told.where(~F.col("_maybe")).drop("_maybe")
    return met.unionByName(free.withColumn("runs", F.lit(None).cast(met.schema["runs"].dataType))).drop("th")


def removed_runs(runs: list | None, length: int) -> list[tuple[int, int]]:
    """Maximal covered item ranges of windows that begin in the given runs."""
    out: list[tuple[int, int]] = []
    for b, m in sorted((r["b"], r["m"]) for r in runs or ()):
        end = b + m - 1 + length
        if out and b <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((b, end))
    return out
