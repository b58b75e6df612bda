"""Time-series gap filling within each entity.

All fills of all columns share one window specification (partition by entity, order by
period), so Catalyst evaluates them over a single sort.  Entity windows are short as a rule (one
row per period); entities of any size go through ``segments``.  The global median fallback goes
through the scalable K1 helper.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import numeric_columns
from ..functions.stats import column_medians
from ..session import stored
from .segments import fill, split_hot


def _c(name: str):
    return F.col(f"`{name}`")


def _grouped(df: DataFrame, entity: str, null_entity: str) -> DataFrame:
    """Add the window group column ``_grp``.

    With ``null_entity="reset"`` the rows without an entity get nothing from the window, so
    they must not form one (possibly huge) partition either: ``_grp`` is a hash of the row for
    them (null otherwise), which spreads them into tiny groups that never meet a real
    entity's rows.  Computed once, so every window of the pass shares one partitioning.
    """
    if null_entity == "reset":
        return df.withColumn("_grp", F.when(_c(entity).isNull(), F.xxhash64(*[_c(c) for c in df.columns])))
    return df.withColumn("_grp", F.lit(None).cast("long"))


def _spec(entity: str, period: str):
    return Window.partitionBy(_c(entity), F.col("_grp")).orderBy(_c(period).asc_nulls_last())


def _reset_null_entity(expr, entity: str, null_entity: str):
    # pandas groupby().transform leaves rows with a missing group key without a value
    if null_entity == "reset":
        return F.when(_c(entity).isNull(), F.lit(None).cast("double")).otherwise(expr)
    return expr


def _interp_exprs(cols, entity, period, rn="_rn"):
    w = _spec(entity, period)
    back = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    out = {}
    for c in cols:
        v = _c(c).cast("double")
        known_x = F.when(v.isNotNull(), F.col(rn))
        px, pv = F.last(known_x, True).over(back), F.last(v, True).over(back)
        nx, nv = F.first(known_x, True).over(ahead), F.first(v, True).over(ahead)
        # linear by position (row number), not by period value, as pandas interpolate('linear')
        interp = pv + (nv - pv) * (F.col(rn) - px) / F.nullif(nx - px, F.lit(0))
        out[c] = F.coalesce(v, interp, nv, pv)
    return out


def _with_hot(df, cols, entity, period, null_entity, hot_rows, how, ordinary):
    """``ordinary`` windows for entities of up to ``hot_rows`` rows, the segmented scan for larger ones."""
    cool, hot = split_hot(df, entity, null_entity, hot_rows)
    out = ordinary(cool)
    return out if hot is None else out.unionByName(fill(hot, cols, entity, period, how))


def interpolate_linear(df: DataFrame, cols: list[str], entity: str = "entity_id", period: str = "period",
                       null_entity: str = "reset", hot_rows: int | None = None) -> DataFrame:
    """Inner gaps linear by position, edges by the nearest known value; all-null groups stay null.

    With ``hot_rows`` (as in E2, E3, E8) entities of more rows than that are filled by a segmented scan over
    ranges instead of one window each, which counts the input's rows by entity once.
    """
    def ordinary(cool):
        ranked = _grouped(cool, entity, null_entity).withColumn("_rn", F.row_number().over(_spec(entity, period)))
        ex = _interp_exprs(cols, entity, period)
        return ranked.select(*[(_reset_null_entity(ex[c], entity, null_entity).alias(c) if c in ex else _c(c))
                               for c in df.columns])
    return _with_hot(df, cols, entity, period, null_entity, hot_rows, "linear", ordinary)


def forward_fill(df: DataFrame, cols: list[str], entity: str = "entity_id", period: str = "period",
                 null_entity: str = "reset", hot_rows: int | None = None) -> DataFrame:
    """Last known value within the entity."""
    back = _spec(entity, period).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def ordinary(cool):
        return _grouped(cool, entity, null_entity).select(*[
            (_reset_null_entity(F.last(_c(c), True).over(back), entity, null_entity).alias(c) if c in cols else _c(c))
            for c in df.columns])
    return _with_hot(df, cols, entity, period, null_entity, hot_rows, "forward", ordinary)


def backward_fill(df: DataFrame, cols: list[str], entity: str = "entity_id", period: str = "period",
                  null_entity: str = "reset", hot_rows: int | None = None) -> DataFrame:
    """Next known value within the entity."""
    ahead = _spec(entity, period).rowsBetween(Window.currentRow, Window.unboundedFollowing)

    def ordinary(cool):
        return _grouped(cool, entity, null_entity).select(*[
            (_reset_null_entity(F.first(_c(c), True).over(ahead), entity, null_entity).alias(c) if c in cols else _c(c))
            for c in df.columns])
    return _with_hot(df, cols, entity, period, null_entity, hot_rows, "backward", ordinary)


def temporal_fill(df: DataFrame, cols: list[str], entity: str = "entity_id", period: str = "period",
                  null_entity: str = "reset", hot_rows: int | None = None) -> DataFrame:
    """E1 -> E2 -> E3 as one expression per column (``limit_direction='both'`` already covers
    the edges, so the forward and backward passes are folded into the same coalesce)."""
    return interpolate_linear(df, cols, entity, period, null_entity, hot_rows)


def impute_panel(df: DataFrame, entity: str = "entity_id", period: str = "period",
                 cols: list[str] | None = None, null_entity: str = "reset",
                 check: bool = False, materialize: bool = True, hot_rows: int | None = None) -> DataFrame:
    """Temporal fills per entity, then the global median of each filled column for what
    is left (entities with no value at all), then optionally D24.

    The filled panel feeds both the median aggregate and the output; with ``materialize`` it
    is written once as Parquet (shared storage, lineage cut), of which the median reads its columns
    only, instead of being evaluated twice from its upstream plan.
    """
    cols = cols or numeric_columns(df, exclude=[period, entity])
    filled = temporal_fill(df, cols, entity, period, null_entity, hot_rows)
    if materialize:
        filled = stored(filled, "filled")
    med = column_medians(filled.select(*cols), cols, stored=materialize)
    med = med.select(*[F.col(f"`{c}`").alias(f"_med_{i}") for i, c in enumerate(cols)])
    idx = {c: i for i, c in enumerate(cols)}
    out = filled.crossJoin(F.broadcast(med)).select(*[
        (F.coalesce(_c(c), F.col(f"_med_{idx[c]}")).alias(c) if c in idx else _c(c)) for c in df.columns])
    if check:
        from .profile import assert_complete
        assert_complete(out)
    return out
