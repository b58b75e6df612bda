"""Fills and lags of entities of any size: a segmented scan over ranges.

A window per entity sorts the whole entity in one task.  Here the rows of large entities are ordered by
(entity, period) in ranges (K2), so an entity lies in as many ranges as it needs.  Every range reports the first
and the last known value of each of its entities with their positions, one row a range and entity; over these
few rows the values before and after each range are carried across, and windows inside the ranges do the rest.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import global_index
from ..session import stored


def _c(name: str):
    return F.col(f"`{name}`")


def split_hot(df: DataFrame, entity: str, null_entity: str, hot_rows: int | None) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary entities, and those of entities with more than ``hot_rows`` rows (None: none asked for, or
    none found).  Rows without an entity are one only with ``null_entity="keep"``; else they never meet."""
    if hot_rows is None:
        return df, None
    sizes = df.groupBy(_c(entity).alias("_e")).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
    if null_entity == "reset":
        sizes = sizes.where("_e IS NOT NULL")
    large = stored(sizes.select("_e"), "hot-entities")
    if not large.limit(1).count():
        return df, None
    same = _c(entity).eqNullSafe(F.col("_e"))
    return df.join(large, same, "left_anti"), df.join(large, same, "left_semi")


def _placed(df: DataFrame, entity: str, period: str) -> DataFrame:
    """``df`` with its position ``_at`` in the order of (entity, period; nulls last) and its range ``_range``."""
    keyed = df.withColumn("_late", _c(period).isNull()).withColumn("_tie", F.xxhash64(*[_c(c) for c in df.columns]))
    placed = global_index(keyed, [f"`{entity}`", "_late", f"`{period}`", "_tie"], index_col="_at", bucket_col="_range")
    return placed.drop("_late", "_tie")


def neighbours(df: DataFrame, cols: list[str], entity: str, period: str) -> DataFrame:
    """``df`` with ``_at`` and, for column i of ``cols``, ``_back{i}`` and ``_next{i}``: position and value of the last
    known value up to the row and of the first from it on, within the entity (null if there is none)."""
    placed = _placed(df, entity, period)
    known = [F.when(_c(c).isNotNull(), F.struct(F.col("_at").alias("x"), _c(c).alias("v"))) for c in cols]
    ends = placed.groupBy(_c(entity).alias("_e"), F.col("_range").alias("_r")).agg(
        *[F.min(k).alias(f"first{i}") for i, k in enumerate(known)],
        *[F.max(k).alias(f"last{i}") for i, k in enumerate(known)])
    across = Window.partitionBy("_e").orderBy("_r")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    after = across.rowsBetween(1, Window.unboundedFollowing)
    carried = stored(ends.select("_e", "_r", *[e for i in range(len(cols)) for e in (
        F.last(f"last{i}", True).over(before).alias(f"_before{i}"),
        F.first(f"first{i}", True).over(after).alias(f"_after{i}"))]), "carried")
    inside = Window.partitionBy(_c(entity), "_range").orderBy("_at")
    back = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = inside.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    local = placed.select("*", *[e for i, k in enumerate(known) for e in (
        F.last(k, True).over(back).alias(f"_b{i}"), F.first(k, True).over(ahead).alias(f"_a{i}"))])
    met = local.join(carried, _c(entity).eqNullSafe(F.col("_e")) & (F.col("_range") == F.col("_r")))
    return met.select(*[_c(c) for c in df.columns], "_at", *[e for i in range(len(cols)) for e in (
        F.coalesce(f"_b{i}", f"_before{i}").alias(f"_back{i}"), F.coalesce(f"_a{i}", f"_after{i}").alias(f"_next{i}"))])


def fill(df: DataFrame, cols: list[str], entity: str, period: str, how: str) -> DataFrame:
    """``cols`` filled within the entity: ``linear`` by position with the nearest value at the edges, ``forward`` or
    ``backward`` by the last or next known value."""
    met = neighbours(df, cols, entity, period)
    out = {}
    for i, c in enumerate(cols):
        back, ahead = F.col(f"_back{i}"), F.col(f"_next{i}")
        if how == "linear":
            b, a = back["v"].cast("double"), ahead["v"].cast("double")
            inner = b + (a - b) * (F.col("_at") - back["x"]) / F.nullif(ahead["x"] - back["x"], F.lit(0))
            out[c] = F.coalesce(_c(c).cast("double"), inner, a, b)
        else:
            out[c] = (back if how == "forward" else ahead)["v"]
    return met.select(*[out[c].alias(c) if c in out else _c(c) for c in df.columns])


def lags(df: DataFrame, cols: list[str], periods: list[int], entity: str, period: str) -> DataFrame:
    """``df`` with ``<col>_lag<p>``: every row is sent to the positions that look back to it, and taken there if the
    entity is the same."""
    placed = _placed(df, entity, period)
    steps = sorted(set(periods))
    sent = placed.select(_c(entity).alias("_e"), F.struct(*[_c(c).alias(f"c{i}") for i, c in enumerate(cols)]).alias("_row"),
                         F.explode(F.array(*[F.lit(p) for p in steps])).alias("_p"), "_at")
    received = sent.groupBy("_e", (F.col("_at") + F.col("_p")).alias("_to")).agg(
        *[F.first(F.when(F.col("_p") == p, F.col("_row")), True).alias(f"_lag{p}") for p in steps])
    met = placed.join(received, _c(entity).eqNullSafe(F.col("_e")) & (F.col("_at") == F.col("_to")), "left")
    return met.select(*[_c(c) for c in df.columns],
                      *[F.col(f"_lag{p}")[f"c{i}"].alias(f"{c}_lag{p}") for i, c in enumerate(cols) for p in periods])
