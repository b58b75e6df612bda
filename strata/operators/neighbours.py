"""k nearest neighbours of seed rows: exact by adaptive cells, or by locality-sensitive hashing.

Cells are the leaves of a k-d tree.  Its splits are medians of a bounded sample; cells that turn out over-full when
all rows are counted are sampled and split again, so a dense cluster gets small cells however far away the other
rows lie.  A seed first looks at its own cell, which bounds its k-th distance; then only the cells whose box
reaches into that ball are looked at.  Two rounds, whatever the data; no cell pairs all rows.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import global_index
from ..session import stored

#: Rows of a cell; a tree has at most ``MOST_CELLS``, beyond which cells grow.  Rows of a sample that the driver sees.
CELL_ROWS, MOST_CELLS, SAMPLE_ROWS = 500, 1 << 17, 20_000
#: Seeds that one task takes into a cell at a time.
VISITORS = 20_000


def thin_duplicates(points: DataFrame, cols: list[str], key: str, keep: int) -> DataFrame:
    """Keep at most ``keep`` copies (smallest keys) of every distinct coordinate tuple.

    In (distance, key) order the copies of one tuple are contiguous and sorted by key, so
    with ``keep = k + 1`` (one spare for the excluded seed itself) no k-NN result changes,
    while a hot duplicate group no longer reaches the neighbour search.  Copy ranks come from
    a global position over (coordinates, key) and a per-tuple minimum (partial aggregate), so
    a group holding a third of the rows is still spread over many tasks.
    """
    heavy = points.groupBy(*cols).count().where(F.col("count") > keep).limit(1).count()
    if heavy == 0:  # no tuple has spare copies (one partial aggregate decides)
        return points.select(key, *cols)
    pos = global_index(points.select(key, *cols), [*cols, key], index_col="_g")
    starts = pos.groupBy(*cols).agg(F.min("_g").alias("_g0"))
    return (pos.join(starts, cols).where(F.col("_g") - F.col("_g0") < keep)
            .select(key, *cols))


class Cells:
    """A k-d tree as arrays: rows with ``x[feature] <= split`` lie in the left child; leaves have feature -1."""

    def __init__(self, dims: int):
        self.dims = dims
        self.feature, self.split = [-1], [0.0]
        self.left, self.right, self.up = [-1], [-1], [-1]
        self.counts = np.zeros(1, np.int64)

    def grow(self, node: int, sample: np.ndarray, rows: float, most: float) -> None:
        """Split ``node`` at medians of its sample, which stands for ``rows`` rows, until no cell has over ``most``."""
        todo = [(node, sample, rows)]
        while todo:
            node, some, rows = todo.pop()
            if rows <= most or len(some) < 4:
                continue
            spread = some.max(0) - some.min(0)
            at = int(np.argmax(spread))
            if not spread[at] > 0:
                continue
            x = np.sort(some[:, at])
            split = x[(len(x) - 1) // 2]
            if split == x[-1]:  # half the sample and more at the upper end
                split = x[np.searchsorted(x, split, "left") - 1]
            low = some[:, at] <= split
            self.feature[node], self.split[node] = at, float(split)
            for side, part in ((self.left, some[low]), (self.right, some[~low])):
                side[node] = len(self.feature)
                self.feature.append(-1)
                self.split.append(0.0)
                self.left.append(-1)
                self.right.append(-1)
                self.up.append(node)
                todo.append((side[node], part, rows * len(part) / len(some)))

    def freeze(self) -> "Cells":
        for name, kind in (("feature", np.int32), ("split", np.float64), ("left", np.int32), ("right", np.int32), ("up", np.int32)):
            setattr(self, name, np.array(getattr(self, name), kind))
        n = len(self.feature)
        self.low, self.high = np.full((n, self.dims), -np.inf), np.full((n, self.dims), np.inf)
        for i in range(1, n):  # a child comes after its parent
            p, f = self.up[i], self.feature[self.up[i]]
            self.low[i], self.high[i] = self.low[p], self.high[p]
            if self.left[p] == i:
                self.high[i, f] = self.split[p]
            else:
                self.low[i, f] = self.split[p]
        return self

    def thaw(self) -> "Cells":
        for name in ("feature", "split", "left", "right", "up"):
            setattr(self, name, getattr(self, name).tolist())
        return self

    def of(self, x: np.ndarray) -> np.ndarray:
        """The cell of each row."""
        node = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(self.feature[node] >= 0)
            if not len(inner):
                return node
            f = self.feature[node[inner]]
            low = x[inner, f] <= self.split[node[inner]]
            node[inner] = np.where(low, self.left[node[inner]], self.right[node[inner]])

    def home(self, cell: np.ndarray, least: int) -> np.ndarray:
        """The smallest node around each cell that holds at least ``least`` rows."""
        node = cell.copy()
        while True:
            small = np.flatnonzero((self.counts[node] < least) & (node > 0))
            if not len(small):
                return node
            node[small] = self.up[node[small]]

    def below(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, cell) for all cells under each node."""
        which, out = np.arange(len(node)), []
        while len(which):
            leaf = self.feature[node] < 0
            out.append((which[leaf], node[leaf]))
            which, node = np.tile(which[~leaf], 2), np.concatenate([self.left[node[~leaf]], self.right[node[~leaf]]])
        return tuple(map(np.concatenate, zip(*out))) if out else (which, node)

    def reached(self, x: np.ndarray, d2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) for all cells whose box lies within the distance of a row; the bound is a little wide, so
        rounding loses none."""
        which, node, out = np.arange(len(x)), np.zeros(len(x), np.int64), []
        while len(which):
            away = np.maximum(np.maximum(self.low[node] - x[which], x[which] - self.high[node]), 0.0)
            near = (away * away).sum(1) <= d2[which] * (1 + 1e-9)
            which, node = which[near], node[near]
            leaf = self.feature[node] < 0
            out.append((which[leaf], node[leaf]))
            which, node = np.tile(which[~leaf], 2), np.concatenate([self.left[node[~leaf]], self.right[node[~leaf]]])
        return tuple(map(np.concatenate, zip(*out))) if out else (which, node)

    def count(self, cells: dict[int, int]) -> None:
        self.counts = np.zeros(len(self.feature), np.int64)
        for c, n in cells.items():
            self.counts[c] = n
        for i in range(len(self.feature) - 1, 0, -1):
            self.counts[self.up[i]] += self.counts[i]


def _matrix(batch, cols: list[str]) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in cols], 1) if batch.num_rows else np.zeros((0, len(cols)))


def _celled(points: DataFrame, cols: list[str], tree: Cells, only: list[int] | None = None) -> DataFrame:
    """``points`` with their cell, those in the cells of ``only`` if given."""
    schema = T.StructType([*points.schema.fields, T.StructField("_cell", T.IntegerType())])
    asked = None if only is None else np.array(sorted(only), np.int64)

    def run(batches):
        for batch in batches:
            cell = tree.of(_matrix(batch, cols))
            out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], names=schema.names)
            yield out if asked is None else out.filter(pa.array(np.isin(cell, asked)))

    return points.mapInArrow(run, schema)


def build_cells(points: DataFrame, cols: list[str], cell_rows: int = CELL_ROWS, sample_rows: int = SAMPLE_ROWS) -> Cells:
    """Cells of about ``cell_rows`` rows (up to twice as many) of a stored table without spare copies.

    Every round counts all rows by cell and takes one bounded sample of those in over-full cells (``sample_rows``,
    or 16 a cell), which are split by it; it ends when no cell is over-full or the sample shows no way to split one.
    """
    coordinates = points.select(*cols)
    tree = Cells(len(cols)).freeze()
    tree.count({0: (n := points.count())})
    most = max(cell_rows, n / MOST_CELLS)
    full = {0: n} if n > most else {}
    while full:
        rows, before = sum(full.values()), len(tree.feature)
        share = min(1.0, max(sample_rows, 16 * len(full)) / rows)
        got = _celled(coordinates.sample(share, seed=before), cols, tree, list(full)).toPandas()
        values, cell = got[cols].to_numpy(float), got["_cell"].to_numpy()
        tree.thaw()
        for c, m in full.items():
            tree.grow(c, values[cell == c], m, most)
        tree.freeze()
        if len(tree.feature) == before:
            break
        cells = {r["_cell"]: r["count"] for r in _celled(coordinates, cols, tree).groupBy("_cell").count().collect()}
        tree.count(cells)
        full = {c: m for c, m in cells.items() if m > 2 * most}
    return tree


def _best_of_cells(points: DataFrame, visits: DataFrame, cols: list[str], key: str, k: int) -> DataFrame:
    """(_sid, _pkey, _d2, p_<col>...): the k nearest points of each visited cell, by (distance, key), the seed itself left out.

    ``visits``: (_sid, _skey, s_<col>..., _cell).  A cell with many visitors is looked at by several tasks.
    """
    parts = stored(visits.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(VISITORS)).cast("int").alias("_parts")), "visits")
    seeds = visits.join(parts, "_cell").withColumn("_part", F.pmod(F.xxhash64("_sid"), F.col("_parts")).cast("int")).drop("_parts")
    held = points.join(parts, "_cell").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    key_type = points.schema[key].dataType
    schema = T.StructType([T.StructField("_sid", T.LongType()), T.StructField("_pkey", key_type), T.StructField("_d2", T.DoubleType()),
                           *[T.StructField(f"p_{c}", T.DoubleType()) for c in cols]])
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by(key)  # so that places are in the order of keys
        p = np.stack([right.column(c).to_numpy() for c in cols], 1)
        s = np.stack([left.column(f"s_{c}").to_numpy() for c in cols], 1)
        keys = {v: i for i, v in enumerate(right.column(key).to_pylist())}
        own = np.array([keys.get(v, -1) for v in left.column("_skey").to_pylist()], np.int64)
        seeds_of, found, dist = [], [], []
        step = max(1, 2_000_000 // max(1, len(p)))
        for a in range(0, len(s), step):
            d2 = np.zeros((len(s[a:a + step]), len(p)))
            for j in range(len(cols)):
                d2 += (p[None, :, j] - s[a:a + step, None, j]) ** 2
            mine = own[a:a + step]
            d2[np.flatnonzero(mine >= 0), mine[mine >= 0]] = np.inf
            m = min(k, len(p))
            last = np.partition(d2, m - 1, axis=1)[:, m - 1:m] if m else np.zeros((len(d2), 1))
            r, c = np.nonzero((d2 <= last) & np.isfinite(d2))
            order = np.lexsort((c, d2[r, c], r))
            r, c = r[order], c[order]
            rank = np.arange(len(r)) - np.searchsorted(r, r)
            r, c = r[rank < k], c[rank < k]
            seeds_of.append(r + a)
            found.append(c)
            dist.append(d2[r, c])
        r, c, d = (np.concatenate(x) for x in (seeds_of, found, dist))
        return pa.Table.from_arrays([left.column("_sid").take(pa.array(r)).combine_chunks(), right.column(key).take(pa.array(c)).combine_chunks(),
                                     pa.array(d), *[pa.array(p[c, j]) for j in range(len(cols))]], schema=arrow)

    return (seeds.groupBy("_cell", "_part").cogroup(held.groupBy("_cell", "_part"))
            .applyInArrow(lambda l, r: nearest(l, r) if l.num_rows and r.num_rows else arrow.empty_table(), schema))


def _visits(seeds: DataFrame, cols: list[str], tree: Cells, k: int, bound: bool) -> DataFrame:
    """One row a seed and cell: the seed's home cells, or with ``bound`` all other cells that reach into its ball
    (``_kd2``: squared distance of the k-th neighbour found at home)."""
    names = ["_sid", "_skey", *[f"s_{c}" for c in cols]]
    schema = T.StructType([*[seeds.schema[n] for n in names], T.StructField("_cell", T.IntegerType())])

    def run(batches):
        for batch in batches:
            x = _matrix(batch, [f"s_{c}" for c in cols])
            at_home, home = tree.below(tree.home(tree.of(x), k + 1))
            which, cell = at_home, home
            if bound:
                which, cell = tree.reached(x, batch.column("_kd2").to_numpy(zero_copy_only=False))
                known = np.isin(which * len(tree.feature) + cell, at_home * len(tree.feature) + home)
                which, cell = which[~known], cell[~known]
            took = batch.select(names).take(pa.array(which))
            yield pa.RecordBatch.from_arrays([*took.columns, pa.array(cell.astype(np.int32))], names=[*names, "_cell"])

    return seeds.mapInArrow(run, schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("_sid").orderBy("_d2", "_pkey")
    return found.withColumn("_rnk", F.row_number().over(order)).where(F.col("_rnk") <= k)


def _seed_rows(seeds: DataFrame, cols: list[str], key: str, seed_id: str) -> DataFrame:
    return seeds.select(F.col(seed_id).alias("_sid"), F.col(key).alias("_skey"),
                        *[F.col(c).cast("double").alias(f"s_{c}") for c in cols])


def _result(found: DataFrame, cols: list[str], seed_id: str) -> DataFrame:
    return found.select(F.col("_sid").alias(seed_id), "_rnk", *[F.col(f"p_{c}").alias(f"n_{c}") for c in cols])


def knn_for_seeds(points: DataFrame, seeds: DataFrame, cols: list[str], key: str, k: int, seed_id: str = "_pos",
                  cell_rows: int = CELL_ROWS) -> DataFrame:
    """Exact k nearest neighbours (Euclidean, ties by ``key``, self excluded) of every seed.

    ``points``: (key, *cols), more than k rows, no nulls; ``seeds``: (seed_id, key, *cols), some of them.
    Returns (seed_id, _rnk 1..k, n_<col> for each col).  Keys may be of any type that Spark orders.
    """
    points = stored(thin_duplicates(points, cols, key, k + 1).select(key, *[F.col(c).cast("double").alias(c) for c in cols]), "points")
    tree = build_cells(points, cols, max(cell_rows, 2 * (k + 1)))
    placed = _celled(points, cols, tree)
    wanted = stored(_seed_rows(seeds, cols, key, seed_id), "seeds")
    first = stored(_ranked(_best_of_cells(placed, _visits(wanted, cols, tree, k, False), cols, key, k), k), "first")
    reach = first.groupBy("_sid").agg(F.max("_d2").alias("_kd2"))
    further = _best_of_cells(placed, _visits(wanted.join(reach, "_sid"), cols, tree, k, True), cols, key, k)
    return _result(_ranked(first.drop("_rnk").unionByName(further), k), cols, seed_id)


def lsh_for_seeds(points: DataFrame, seeds: DataFrame, cols: list[str], key: str, k: int, seed_id: str = "_pos",
                  tables: int = 8, buckets: float = 2.0, seed: int = 42) -> DataFrame:
    """k near neighbours by locality-sensitive hashing (``BucketedRandomProjectionLSH.approxSimilarityJoin``), for
    classes and column counts where exact search is too dear.

    The join's distance is the largest k-th distance among a bounded sample of seeds, found exactly; a bucket is
    ``buckets`` times as wide.  Seeds that meet fewer than k rows are searched exactly, so every seed gets k.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH, VectorAssembler
    points = stored(thin_duplicates(points, cols, key, k + 1).select(key, *[F.col(c).cast("double").alias(c) for c in cols]), "points")
    wanted = stored(seeds.select(seed_id, key, *[F.col(c).cast("double").alias(c) for c in cols]), "seeds")
    some = wanted.orderBy(F.xxhash64(seed_id, F.lit(seed))).limit(200)
    exact = knn_for_seeds(points, some, cols, key, k, seed_id).join(some.select(seed_id, *cols), seed_id)
    far = F.sqrt(sum(((F.col(f"n_{c}") - F.col(c)) * (F.col(f"n_{c}") - F.col(c)) for c in cols), F.lit(0.0)))
    radius = exact.agg(F.max(far)).first()[0] or 1e-9
    vector = VectorAssembler(inputCols=cols, outputCol="_v")
    p, s = vector.transform(points), vector.transform(wanted)
    lsh = BucketedRandomProjectionLSH(inputCol="_v", outputCol="_h", bucketLength=buckets * radius, numHashTables=tables, seed=seed)
    met = lsh.fit(p).approxSimilarityJoin(s, p, radius, distCol="_d")
    d2 = sum(((F.col(f"datasetB.{c}") - F.col(f"datasetA.{c}")) * (F.col(f"datasetB.{c}") - F.col(f"datasetA.{c}")) for c in cols), F.lit(0.0))
    near = met.where(F.col(f"datasetA.{key}") != F.col(f"datasetB.{key}")).select(
        F.col(f"datasetA.{seed_id}").alias("_sid"), F.col(f"datasetB.{key}").alias("_pkey"), d2.alias("_d2"),
        *[F.col(f"datasetB.{c}").alias(f"p_{c}") for c in cols])
    found = stored(_ranked(near, k), "near")
    whole = found.where(F.col("_rnk") == k).select(F.col("_sid").alias(seed_id))
    rest = stored(wanted.join(whole, seed_id, "left_anti"), "lonely")
    done = _result(found.join(whole.select(F.col(seed_id).alias("_sid")), "_sid", "left_semi"), cols, seed_id)
    return done.unionByName(knn_for_seeds(points, rest, cols, key, k, seed_id))
