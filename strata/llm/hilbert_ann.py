"""Nearest neighbours by inner product over shifted space-filling curves."""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import load, ship, written

CURVES, DIMS, BITS = 14, 6, 5
REACH = 0.05
BLOCK = 1024
FIT_ROWS = 2000


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of integer cells (rows, dims) along the Hilbert curve, as one integer a row.

    From the highest bit down, each coordinate's bit either inverts the lower bits of the first coordinate or
    swaps them with its own, which turns the sub-cube; the Gray code of the turned bits is the key.
    """
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for d in range(dims):
            on = (x[:, d] >> b) & 1 == 1
            swap = np.where(on, 0, (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] ^= np.where(on, low, swap)
            x[:, d] ^= swap
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    flip = np.zeros(len(x), np.int64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[:, -1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[:, d] >> b) & 1)
    return key


class Curves:
    """Random projections, their spread on a sample, and the shifts of the grids; a few KB."""

    def __init__(self, sample: np.ndarray, longest: float, curves: int, dims: int, bits: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.longest, self.bits = longest, bits
        width = sample.shape[1] + 1
        self.project = [np.linalg.qr(rng.standard_normal((width, min(dims, width))))[0] for _ in range(curves)]
        self.shift = rng.random((curves, min(dims, width)))
        lifted = self.lift(sample, False)
        self.mean = [(lifted @ p).mean(axis=0) for p in self.project]
        self.dev = [(lifted @ p).std(axis=0) + 1e-12 for p in self.project]

    def lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Unit vectors with one more component, so that a larger inner product is a smaller angle."""
        size = np.sqrt((x * x).sum(axis=1, keepdims=True))
        if query:
            return np.hstack([x / size, np.zeros_like(size)])
        y = x / self.longest
        return np.hstack([y, np.sqrt(np.maximum(0, 1 - (size / self.longest) ** 2))])

    def keys(self, c: int, lifted: np.ndarray) -> np.ndarray:
        u = 1 / (1 + np.exp(-1.702 * (lifted @ self.project[c] - self.mean[c]) / self.dev[c]))
        cells = ((u + self.shift[c]) / 2 * (1 << self.bits)).astype(np.int64)
        return hilbert_keys(np.clip(cells, 0, (1 << self.bits) - 1), self.bits)


def best(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Places of each row's ``top`` largest scores, in no order; of equal scores those of the smallest ids."""
    at = np.argpartition(-scores, top - 1, axis=1)[:, :top]
    edge = np.take_along_axis(scores, at, axis=1).min(axis=1)
    for r in np.flatnonzero((scores >= edge[:, None]).sum(axis=1) > top):
        tied = np.flatnonzero(scores[r] >= edge[r])
        at[r] = tied[np.lexsort((ids[tied], -scores[r, tied]))[:top]]
    return at


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            curves: int = CURVES, dims: int = DIMS, bits: int = BITS, reach: float = REACH, block: int = BLOCK) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` nearest found of rows whose id divides by ``every``.

    Nearness is the inner product in double precision, of single or double vectors as they are; ties go to the smaller
    id, also where a block's best are cut.  Each curve orders all
    vectors by the Hilbert key of a random projection on a shifted grid, by range partitioning; the order is cut
    into blocks, and the queries of a block meet the blocks that hold the next ``reach`` of all rows on either
    side, as matrix products.  Blocks may be of any size: their places on the curve are running sums of their rows.
    Windows of all curves merge by query.  As ``reach`` is a share of the table, recall keeps its level as the table
    grows, whatever the number of partitions; on directions spread evenly over 64 dimensions the curves tell little
    apart and about seven tenths of all pairs are computed for a recall above 0.9, on clustered vectors fewer do.

    Equal vectors are searched once with their ``k`` + 1 smallest ids, so no crowd of copies fills a window, and
    results list the copies.  The grid's spread is fitted on the ``FIT_ROWS`` rows of smallest id hash; every row
    is indexed.  Vectors that are null, zero, of another length than most, or hold null or non-finite
    components take no part, nor do null ids; rows that repeat an id with its vector count once; no valid query
    gives an empty result; extra columns are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    v = F.col("v")
    single = vectors.schema[vec_col].dataType.elementType == T.FloatType()
    kind = np.float32 if single else np.float64
    rows = (vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<float>" if single else "array<double>").alias("v"))
            .where(F.col("id").isNotNull() & v.isNotNull()
                   & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                   & F.exists(v, lambda x: x != 0)).distinct())
    rows = written(rows, "vectors")
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if sizes is None:
        return empty
    width = sizes["n"]
    rows = rows.where(F.size("v") == width)
    # The group limit works before the shuffle, so a vector with any number of copies sends few rows.
    first = Window.partitionBy("v").orderBy("id")
    unique = written(rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k + 1)
                     .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
                     .withColumn("rep", F.col("ids")[0]), "unique")
    asked = written(rows.where(F.col("id") % every == 0).join(unique.select("v", "rep"), "v")
                    .select(F.col("id").alias("query_id"), "rep"), "queries")
    sample = [r.v for r in unique.orderBy(F.xxhash64("rep")).limit(FIT_ROWS).collect()]
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    stats = unique.agg(F.max(norm2).alias("m"), F.count(F.lit(1)).alias("n")).first()
    plan = Curves(np.array(sample, np.float64), math.sqrt(stats["m"]), curves, dims, bits)
    size = int(max(1, min(block, math.ceil(stats["n"] * reach / 2))))
    far = math.ceil(stats["n"] * reach)

    def order(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("v").flatten().to_numpy().reshape(-1, width).astype(np.float64)
            blob = pa.array([r.tobytes() for r in x.astype(kind)], pa.binary())
            ask = batch.column("ask").to_numpy(zero_copy_only=False)
            for query in (False, True):
                pick = np.flatnonzero(ask) if query else np.arange(len(x))
                if not len(pick):
                    continue
                lifted = plan.lift(x[pick], query)
                for c in range(curves):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(pick), c, np.int32)), pa.array(plan.keys(c, lifted)),
                         batch.column("rep").take(pa.array(pick)), pa.array(np.full(len(pick), query)),
                         blob.take(pa.array(pick))], names=["curve", "key", "rep", "query", "x"])

    asking = asked.select("rep").distinct().withColumn("ask", F.lit(True))
    points = unique.join(asking, "rep", "left").select("rep", "v", F.coalesce("ask", F.lit(False)).alias("ask"))
    ordered = (points.mapInArrow(order, "curve int, key bigint, rep bigint, query boolean, x binary")
               .repartitionByRange("curve", "key", "rep").sortWithinPartitions("curve", "key", "rep", "query"))

    def pack(batches):
        part, seq, now = TaskContext.get().partitionId(), 0, None
        held = {False: ([], []), True: ([], [])}

        def block_row():
            (ci, cx), (qi, qx) = held[False], held[True]
            out = pa.RecordBatch.from_pydict({
                "curve": pa.array([now], pa.int32()), "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int64()),
                "n": pa.array([len(ci)], pa.int64()), "ids": [np.array(ci, np.int64).tobytes()], "xs": [b"".join(cx)],
                "q_ids": [np.array(qi, np.int64).tobytes()], "qs": [b"".join(qx)]})
            for a, b in held.values():
                a.clear()
                b.clear()
            return out

        for batch in batches:
            for c, rep, query, x in zip(*(batch.column(n).to_pylist() for n in ("curve", "rep", "query", "x"))):
                if now is not None and (c != now or len(held[False][0]) >= size or len(held[True][0]) >= size):
                    yield block_row()
                    seq += 1
                now = c
                held[query][0].append(rep)
                held[query][1].append(x)
        if now is not None:
            yield block_row()

    blocks = written(ordered.mapInArrow(pack, "curve int, part int, seq bigint, n bigint, ids binary, xs binary, q_ids binary, qs binary"),
                     "blocks")
    so_far = F.sum("n").over(Window.partitionBy("curve").orderBy("part", "seq"))
    places = blocks.select("curve", "part", "seq", so_far.alias("end"), (so_far - F.col("n")).alias("start"))
    blocks = blocks.join(places, ["curve", "part", "seq"])
    # Blocks go to the bin of ``size`` rows that they begin in, queries to all bins where a block within reach may begin.
    at = lambda place: F.floor(place / size)
    seekers = (blocks.where(F.octet_length("q_ids") > 0).select(
        "curve", "q_ids", "qs", (F.col("start") - far).alias("q_from"), (F.col("end") + far).alias("q_to"))
        .withColumn("bin", F.explode(F.sequence(at(F.col("q_from") - size), at(F.col("q_to"))))))
    met = (blocks.where("n > 0").select("curve", at(F.col("start")).alias("bin"), "start", "end", "ids", "xs")
           .join(seekers, ["curve", "bin"]).where("end > q_from and start < q_to").select("ids", "xs", "q_ids", "qs"))

    def score(batches):
        for batch in batches:
            out = ([], [], [])
            for ids, xs, q_ids, qs in zip(*(batch.column(n) for n in ("ids", "xs", "q_ids", "qs"))):
                ids, q_ids = np.frombuffer(ids.as_py(), np.int64), np.frombuffer(q_ids.as_py(), np.int64)
                x = np.frombuffer(xs.as_py(), kind).reshape(-1, width).astype(np.float64)
                q = np.frombuffer(qs.as_py(), kind).reshape(-1, width).astype(np.float64)
                s = q @ x.T
                top = min(k + 1, len(ids))
                at = best(s, ids, top)
                out[0].extend(q_ids.tolist())
                out[1].extend(ids[at].tolist())
                out[2].extend(np.take_along_axis(s, at, axis=1).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.int64())),
                 pa.array(out[2], pa.list_(pa.float64()))], names=["q", "reps", "scores"])

    found = met.mapInArrow(score, "q bigint, reps array<bigint>, scores array<double>")

    def merge(batches):
        now, held = None, {}

        def cut(b):
            return dict(sorted(b.items(), key=lambda t: (-t[1], t[0]))[:k + 1])

        for batch in batches:
            done = []
            for q, reps, scores in zip(*(batch.column(n).to_pylist() for n in ("q", "reps", "scores"))):
                if q != now:
                    if now is not None:
                        done.append((now, cut(held)))
                    now, held = q, {}
                for r, s in zip(reps, scores):
                    held.setdefault(r, s)
                if len(held) > 40 * (k + 1):
                    held = cut(held)
            yield rows_of(done)
        if now is not None:
            yield rows_of([(now, cut(held))])

    def rows_of(done):
        flatten = [(q, r, s) for q, b in done for r, s in b.items()]
        return pa.RecordBatch.from_arrays(
            [pa.array([t[i] for t in flatten], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))],
            names=["q", "rep", "score"])

    tops = found.repartition("q").sortWithinPartitions("q").mapInArrow(merge, "q bigint, rep bigint, score double")
    # Copies of the found vectors: k + 1 vectors of at most k + 1 ids for each searched vector.
    listed = (tops.join(unique.select("rep", "ids"), "rep").select(
        "q", F.explode(F.transform("ids", lambda i: F.struct((-F.col("score")).alias("s"), i.alias("i")))).alias("t"))
        .groupBy("q").agg(F.slice(F.array_sort(F.collect_list("t")), 1, k + 1).alias("ts")))
    own = asked.join(listed, asked["rep"] == listed["q"])
    kept = F.slice(F.filter("ts", lambda t: t["i"] != F.col("query_id")), 1, k)
    return own.select("query_id", F.posexplode(kept).alias("_p", "t")).select(
        "query_id", (F.col("_p") + 1).cast("int").alias("rank"), F.col("t.i").alias("vec_id"), (-F.col("t.s")).alias("score"))


def op2_hilbert_ann(spark, sf_dir):
    return nearest(load(spark, sf_dir, "embeddings"))


QUERIES = {"op2_hilbert_ann": (op2_hilbert_ann, None)}
