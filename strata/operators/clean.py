"""Projections, filters and scalar rules."""
from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import coerce_double, numeric_columns  # noqa: F401  (re-export B3)
from ..functions.stats import column_medians
from .joins import with_scalar


def _c(name: str):
    return F.col(f"`{name}`")


def select_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """B1: exactly these columns, in this order; a missing one is an error."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.select(*[_c(c) for c in cols])


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """B2: drop the listed columns, ignoring absent ones."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present) if present else df


def coerce_numeric(df: DataFrame, except_cols: list[str] = ()) -> DataFrame:
    """Every text column not in ``except_cols`` becomes double; unparsable text -> null."""
    keep = set(except_cols)
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType) and f.name not in keep:
            out.append(coerce_double(_c(f.name)).alias(f.name))
        else:
            out.append(_c(f.name))
    return df.select(*out)


def cast_label(df: DataFrame, col: str) -> DataFrame:
    """Label to int, truncating toward zero."""
    return df.withColumn(col, _c(col).cast("int"))


def drop_periods(df: DataFrame, years: list[int] | None, period: str = "period") -> DataFrame:
    """Remove listed periods; rows with a null period are kept (pandas ``~isin``)."""
    if not years:
        return df
    return df.where(F.coalesce(~_c(period).isin(list(years)), F.lit(True)))


def drop_sparse_entities(df: DataFrame, col: str, entity: str, threshold: float = 0.9) -> DataFrame:
    """Drop entities whose share of nulls in ``col`` is above ``threshold``.

    Rates come from a partial aggregate per entity (skew safe); the removal is a left anti
    join, so rows with a null entity are kept.  AQE broadcasts the removal set when small
    and splits skewed partitions of the big side.
    """
    rates = (df.groupBy(_c(entity).alias(entity))
             .agg(F.avg(_c(col).isNull().cast("double")).alias("_rate")))
    removed = rates.where(F.col("_rate") > F.lit(float(threshold))).select(entity)
    # Rows without an entity are always kept; split off, they don't meet in one partition of the join.
    known = df.where(_c(entity).isNotNull()).join(removed.where(_c(entity).isNotNull()), entity, "left_anti")
    return known.select(*[_c(c) for c in df.columns]).unionByName(df.where(_c(entity).isNull()))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> dict:
    cols = cols or df.columns
    row = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(_c(c).isNull()).alias(c) for c in cols]).first()
    return row.asDict()


def drop_sparse_columns(df: DataFrame, frac: float = 0.8) -> DataFrame:
    """Drop columns whose null count is above ``frac`` x rows (one aggregate)."""
    counts = null_counts(df)
    limit = counts["__rows"] * frac
    drop = [c for c in df.columns if counts[c] > limit]
    return df.drop(*drop) if drop else df


def replace_inf_dropna(df: DataFrame) -> DataFrame:
    """+-inf -> null on floating columns, then drop rows with any null."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = _c(f.name)
            out.append(F.when(F.abs(c) == F.lit(float("inf")), F.lit(None).cast(f.dataType))
                       .otherwise(c).alias(f.name))
        else:
            out.append(_c(f.name))
    return df.select(*out).dropna(how="any")


def _median_filled(df: DataFrame, col: str) -> DataFrame:
    base = df.withColumn(col, coerce_double(_c(col)) if isinstance(df.schema[col].dataType, T.StringType)
                         else _c(col).cast("double"))
    med = column_medians(base.select(col), [col]).select(F.col(col).alias("_median"))
    return (with_scalar(base, med)
            .withColumn(col, F.coalesce(_c(col), F.col("_median"))).drop("_median"))


def label_strict_lt(df: DataFrame, col: str, cut: float = 90.0, label: str = "label",
                    keep_source: bool = False) -> DataFrame:
    """Coerce, fill nulls with the global median, label 1 if value < cut else 0."""
    out = _median_filled(df, col).withColumn(
        label, F.when(_c(col) < F.lit(float(cut)), F.lit(1)).otherwise(F.lit(0)))
    return out if keep_source else out.drop(col)


def label_strict_gt(df: DataFrame, col: str, cut: float = 90.0, label: str = "label",
                    keep_source: bool = False) -> DataFrame:
    """Coerce, fill nulls with the global median, label 0 if value > cut else 1."""
    out = _median_filled(df, col).withColumn(
        label, F.when(_c(col) > F.lit(float(cut)), F.lit(0)).otherwise(F.lit(1)))
    return out if keep_source else out.drop(col)


def drop_null_target(df: DataFrame, col: str) -> DataFrame:
    """Keep rows with a target."""
    return df.dropna(subset=[col])


SANITIZE_PATTERN = r"[^A-Za-z0-9_]+"


def sanitize_name(name: str) -> str:
    return re.sub(SANITIZE_PATTERN, "_", name)


def sanitize_names(df: DataFrame) -> DataFrame:
    """Runs of characters outside [A-Za-z0-9_] -> '_' in column names."""
    names = [sanitize_name(c) for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"sanitized column names collide: {names}")
    return df.toDF(*names)


def entity_history(df: DataFrame, entity_value, entity: str = "entity_id", period: str = "period") -> DataFrame:
    """Rows of one entity ordered by period."""
    return df.where(_c(entity) == F.lit(entity_value)).orderBy(_c(period).asc_nulls_last())


def clean_columns(df: DataFrame, drop: list[str] = (), categorical: list[str] = (),
                  frac: float = 0.8) -> DataFrame:
    """Drop listed columns -> coerce text columns -> drop sparse columns, in this order."""
    return drop_sparse_columns(coerce_numeric(drop_columns(df, list(drop)), list(categorical)), frac)


def clean_panel(df: DataFrame | None, target: str, entity: str, threshold: float = 0.9,
                years: list[int] | None = None, period: str = "period") -> DataFrame | None:
    """Drop periods, then sparse entities; ``None`` in gives ``None`` out."""
    if df is None:
        return None
    return drop_sparse_entities(drop_periods(df, years, period), target, entity, threshold)


def null_matrix(df: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Is-null flag per cell (keys passed through)."""
    return df.select(*[_c(k) for k in keys],
                     *[_c(c).isNull().alias(c) for c in df.columns if c not in set(keys)])
