"""Reproducible splits, folds and search spaces.

Draws come from md5 of (seed, key) – the same value in any engine and on any re-run –
never from ``rand()``.  Exact cuts of a class come from counts of its draws and an order of the few rows
near the cut; folds, which need every row's rank, use a global position in (class, draw, key)
order from the K2 helper instead of one window per class, so a class holding most rows is
still spread over many tasks.
"""
from __future__ import annotations

import itertools
import random
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import hash_uniform
from ..functions.stats import global_index
from ..session import stored


def _rank_in_class(df: DataFrame, y: str, key: str, seed: int) -> DataFrame:
    drawn = df.withColumn("_u", hash_uniform(key, seed))
    counts = drawn.groupBy(y).agg(F.count(F.lit(1)).alias("_n_class"))
    # class offsets from the per-class counts (one row per class): smaller labels come first
    before = Window.orderBy(F.col(y).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(y, "_n_class", F.coalesce(F.sum("_n_class").over(before), F.lit(0)).alias("_off"))
    pos = global_index(drawn, [y, "_u", key])
    # null-safe: rows without a label are a class of their own
    offsets = offsets.withColumnRenamed(y, "_class")
    return (pos.join(offsets, pos[y].eqNullSafe(offsets["_class"])).drop("_class")
            .withColumn("_rank", F.col("_gidx") - F.col("_off"))
            .drop("_gidx", "_off"))


#: Equal parts of [0, 1) into which draws are counted by class.
DRAW_PARTS = 4096


def class_cuts(df: DataFrame, y: str, key: str, share: float, seed: int) -> DataFrame:
    """(_class, _cut_u, _cut_key): of each class the last row, by (draw, key), of its round(share x rows) first ones;
    null where that is none.

    Draws are counted by class and part of [0, 1): the part that holds the last row is known from counts alone, and
    only the rows in it, one in ``DRAW_PARTS``, are put in order.
    """
    drawn = df.select(F.col(y).alias("_class"), F.col(key).alias("_key"), hash_uniform(key, seed).alias("_u"))
    part = F.floor(F.col("_u") * DRAW_PARTS).cast("int")
    counts = stored(drawn.groupBy("_class", part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")), "draws")
    classes = counts.groupBy("_class").agg(F.sum("_n").alias("_rows")).withColumn(
        "_want", F.round(F.lit(float(share)) * F.col("_rows")).cast("long"))
    # checked inside the plan (no extra job): fails the query when a class is too small
    classes = classes.where(F.assert_true(F.col("_rows") >= 2, "a class has fewer than 2 rows").isNull())
    upto = Window.partitionBy("_class").orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = null_safe_join(counts.withColumn("_upto", F.sum("_n").over(upto)), classes, "_class").where(
        (F.col("_want") <= F.col("_upto")) & (F.col("_want") > F.col("_upto") - F.col("_n"))).select(
        "_class", "_part", (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_nth"))  # one row a class
    near = null_safe_join(drawn.withColumn("_part", part), edge.withColumnRenamed("_part", "_edge"), "_class").where(
        F.col("_part") == F.col("_edge")).select("_class", "_u", "_key", "_nth")
    ranked = global_index(near, ["_class", "_u", "_key"], index_col="_at")
    first = ranked.groupBy("_class").agg(F.min("_at").alias("_first"))
    last = null_safe_join(ranked, first, "_class").where(F.col("_at") - F.col("_first") == F.col("_nth") - 1)
    return null_safe_join(classes.select("_class"), last.select("_class", F.col("_u").alias("_cut_u"), F.col("_key").alias("_cut_key")),
                          "_class", "left")


def null_safe_join(a: DataFrame, b: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join on one column in which null equals null; ``b`` has a row a class."""
    right = b.withColumnRenamed(on, "_on")
    return a.join(right, F.col(on).eqNullSafe(F.col("_on")), how).drop("_on")


def stratified_split(df: DataFrame, y: str, key: str, test: float = 0.2, seed: int = 42,
                     mode: str = "exact", split_col: str = "split") -> DataFrame:
    """G1: per class, the round(test x n_class) rows with the smallest (draw, key) go to ``test``.

    ``class_cuts`` finds each class's last test row; every row is then compared with its class's (one row a class
    is joined), so rows are neither ordered nor, as a rule, shuffled.  ``mode="approx"`` keeps only the hash threshold
    (draw < test): no exact counts, no extra pass.  A class with fewer than two rows fails the query (as
    scikit-learn refuses it); rows without a label are a class of their own.
    """
    if mode == "approx":
        return df.withColumn(split_col, F.when(hash_uniform(key, seed) < F.lit(test), "test").otherwise("train"))
    cuts = class_cuts(df, y, key, test, seed)
    drawn = df.withColumn("_u", hash_uniform(key, seed))
    met = drawn.join(cuts, F.col(y).eqNullSafe(F.col("_class")))
    inside = (F.col("_u") < F.col("_cut_u")) | ((F.col("_u") == F.col("_cut_u")) & (F.col(key) <= F.col("_cut_key")))
    return met.withColumn(split_col, F.when(inside, "test").otherwise("train")).drop("_u", "_class", "_cut_u", "_cut_key")


def temporal_split(df: DataFrame, period: str = "period", cut: int = 2021, split_col: str = "split",
                   drop_period: bool = True) -> DataFrame:
    """Train before ``cut``, test from ``cut`` on; the period column is then dropped."""
    out = df.where(F.col(period).isNotNull()).withColumn(
        split_col, F.when(F.col(period) < cut, "train").otherwise("test"))
    return out.drop(period) if drop_period else out


def train_test(df: DataFrame, split_col: str = "split") -> tuple[DataFrame, DataFrame]:
    return (df.where(F.col(split_col) == "train").drop(split_col),
            df.where(F.col(split_col) == "test").drop(split_col))


def stratified_folds(df: DataFrame, y: str, key: str, k: int = 5, seed: int = 42,
                     fold_col: str = "fold") -> DataFrame:
    """fold = (position of the row's draw inside its class) mod k, so every fold gets
    an equal share of each class.  Feeds ``CrossValidator(foldCol=...)``."""
    ranked = _rank_in_class(df, y, key, seed)
    return ranked.withColumn(fold_col, (F.col("_rank") % k).cast("int")).drop("_u", "_rank", "_n_class")


def expanding_folds(df: DataFrame, period: str = "period", k: int = 5) -> DataFrame:
    """Expanding-window folds over the sorted distinct periods (train on the past, validate
    on the next block), as a (fold, period, role) table; join it to the rows.

    Positions of the distinct periods come from ``global_index``; only their number reaches the driver.
    """
    periods = global_index(df.select(period).where(F.col(period).isNotNull()).distinct(), [period], index_col="_i")
    n = periods.count()
    size = n // (k + 1)
    if size < 1:
        raise ValueError(f"{n} periods cannot make {k} folds")
    start = F.lit(n - k * size) + F.col("fold") * size
    return (periods.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
            .where(F.col("_i") < start + size)
            .select("fold", period, F.when(F.col("_i") < start, "train").otherwise("test").alias("role")))


def fold_rows(df: DataFrame, folds: DataFrame, period: str = "period") -> DataFrame:
    """Rows of every fold with their role."""
    return df.join(folds, period)


# ------------------------------------------------------------------ search spaces (driver side, tiny)

def _draw(seed: int, *parts) -> float:
    import hashlib
    h = hashlib.md5(":".join([str(seed), *map(str, parts)]).encode()).hexdigest()
    return int(h[:8], 16) / 4294967296.0


def random_params(space: dict[str, Any], n: int = 20, seed: int = 42) -> list[dict[str, Any]]:
    """N draws; a spec is ("randint", lo, hi) (hi exclusive), ("uniform", loc, scale) or a
    list of choices.  Same seed, same draws."""
    out = []
    for i in range(n):
        d = {}
        for name in sorted(space):
            spec = space[name]
            u = _draw(seed, name, i)
            if isinstance(spec, (list, tuple)) and spec and spec[0] == "randint":
                d[name] = int(spec[1] + int(u * (spec[2] - spec[1])))
            elif isinstance(spec, (list, tuple)) and spec and spec[0] == "uniform":
                d[name] = float(spec[1] + u * spec[2])
            else:
                d[name] = list(spec)[int(u * len(spec))]
        out.append(d)
    return out


def grid_params(grid: dict[str, list]) -> list[dict[str, Any]]:
    """Cartesian product in key order."""
    keys = list(grid)
    return [dict(zip(keys, combo)) for combo in itertools.product(*[grid[k] for k in keys])]


def set_seeds(seed: int) -> None:
    """Seed the driver-side generators (Spark draws are seeded per call)."""
    random.seed(seed)
    try:
        import numpy as np
        np.random.seed(seed)
    except ImportError:  # pragma: no cover
        pass
