"""Aggregations and data-quality checks.

Column-wise checks are folded into one wide aggregate (a single scan) and then unpivoted,
instead of one pass per column.
"""
from __future__ import annotations

import logging
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import fround, numeric_columns
from ..functions.stats import column_quantiles
from ..session import scratch_path, stored

log = logging.getLogger(__name__)


def _c(name: str):
    return F.col(f"`{name}`")


def _unpivot_row(df: DataFrame, names: list[str], value_name: str, value_type: str,
                 carry: list[str] = ()) -> DataFrame:
    """Turn a one-row wide aggregate into (column, value) rows, carrying scalar columns along."""
    pairs = ", ".join(f"'{n}', CAST(`{n}` AS {value_type})" for n in names)
    return df.selectExpr(*[f"`{c}`" for c in carry],
                         f"stack({len(names)}, {pairs}) AS (`column`, `{value_name}`)")


def missing_by_entity(df: DataFrame, col: str, entity: str = "entity_id") -> DataFrame:
    """% of null ``col`` per entity, descending (ties by entity)."""
    return (df.groupBy(entity).agg((F.avg(_c(col).isNull().cast("double")) * 100).alias("missing_pct"))
            .orderBy(F.col("missing_pct").desc(), F.col(entity).asc_nulls_last()))


def missing_by_period(df: DataFrame, col: str, period: str = "period") -> DataFrame:
    """% of null ``col`` per period."""
    return (df.groupBy(period).agg((F.avg(_c(col).isNull().cast("double")) * 100).alias("missing_pct"))
            .orderBy(period))


def _null_count_row(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count_if(_c(c).isNull()).alias(c) for c in df.columns])


def missing_by_column(df: DataFrame) -> DataFrame:
    """D3: null count and % (2 decimals) per column, only columns with nulls."""
    wide = _null_count_row(df)
    long = _unpivot_row(wide, df.columns, "missing_count", "BIGINT", carry=["__rows"])
    return (long.where(F.col("missing_count") > 0)
            .select("column", "missing_count",
                    fround(F.col("missing_count") / F.col("__rows") * 100, 2).alias("missing_pct")))


def missing_cells(df: DataFrame) -> DataFrame:
    """Total null cells and their share of all cells (0 when the table is empty)."""
    ncols = len(df.columns)
    wide = _null_count_row(df)
    total = sum((F.col(f"`{c}`") for c in df.columns), F.lit(0))
    return wide.select(
        total.cast("long").alias("null_cells"),
        (F.col("__rows") * ncols).cast("long").alias("total_cells"),
        F.when(F.col("__rows") * ncols > 0, total / (F.col("__rows") * ncols) * 100)
        .otherwise(F.lit(0.0)).alias("null_pct"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first copy (nulls compare equal); partial aggregation per group."""
    return (df.groupBy(*[_c(c) for c in df.columns]).count()
            .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicate_rows")))


def inf_by_column(df: DataFrame) -> DataFrame:
    """Count of +-inf per floating column, only columns with any."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, inf_count bigint")
    wide = df.agg(*[F.count_if(F.abs(_c(c)) == F.lit(float("inf"))).alias(c) for c in cols])
    return _unpivot_row(wide, cols, "inf_count", "BIGINT").where(F.col("inf_count") > 0)


def zero_variance_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Numeric columns that are constant (min = max over more than one value).

    ``var() == 0`` misses constants like [.1, .1, .1] through rounding; min = max does not.
    """
    cols = cols or numeric_columns(df)
    wide = df.agg(*[(F.count(_c(c)) > 1) & (F.min(_c(c)) == F.max(_c(c))) for c in cols])
    wide = wide.toDF(*cols)
    return _unpivot_row(wide, cols, "is_constant", "BOOLEAN").where(F.col("is_constant")).select("column")


def null_target_count(df: DataFrame, target: str) -> DataFrame | None:
    """Nulls in the target; warns and returns None when the column is absent."""
    if target not in df.columns:
        log.warning("target column %s not found", target)
        return None
    return df.agg(F.count_if(_c(target).isNull()).cast("long").alias("null_target"))


def class_distribution(df: DataFrame, col: str) -> DataFrame:
    """Relative frequency per class (nulls ignored), descending."""
    counts = df.where(_c(col).isNotNull()).groupBy(col).count()
    # the window runs over the grouped rows (one per class), never over row-level data
    return (counts.select(col, (F.col("count") / F.sum("count").over(Window.partitionBy())).alias("share"))
            .orderBy(F.col("share").desc(), F.col(col)))


def positive_weight(df: DataFrame, y: str) -> DataFrame:
    """n0 / n1, or 1 when there is no positive row."""
    agg = df.agg(F.count_if(_c(y) == 0).alias("n0"), F.count_if(_c(y) == 1).alias("n1"))
    return agg.select("n0", "n1", F.when(F.col("n1") > 0, F.col("n0") / F.col("n1"))
                      .otherwise(F.lit(1.0)).alias("pos_weight"))


def describe_panel(df: DataFrame, cols: list[str] | None = None, decimals: int = 2) -> DataFrame:
    """Count, mean, sample sd, min, quartiles (linear), max per column, rounded.

    Moments are one wide aggregate, unpivoted afterwards; quartiles come from K1.  The columns are
    written once and both read that table, so the input's plan runs once.
    """
    cols = cols or numeric_columns(df)
    path = scratch_path(df.sparkSession, "describe")
    df.select(*[_c(c).cast("double").alias(c) for c in cols]).write.parquet(path)
    kept = df.sparkSession.read.parquet(path)
    quants = column_quantiles(kept, cols, [0.25, 0.5, 0.75], stored=True)
    one = kept.agg(*[e for i, c in enumerate(cols) for e in (
        F.count(_c(c)).cast("long").alias(f"n{i}"), F.avg(_c(c)).alias(f"mean{i}"), F.stddev_samp(_c(c)).alias(f"std{i}"),
        F.min(_c(c)).alias(f"min{i}"), F.max(_c(c)).alias(f"max{i}"))]).crossJoin(F.broadcast(quants))  # one row each
    body = ", ".join(f"'{c}', n{i}, mean{i}, std{i}, min{i}, `{c}__q0.25`, `{c}__q0.5`, `{c}__q0.75`, max{i}"
                     for i, c in enumerate(cols))
    g = one.selectExpr(f"stack({len(cols)}, {body}) AS (`column`, `count`, mean, std, min, p25, p50, p75, max)")
    return g.select("column", "count", *[fround(F.col(s), decimals).alias(s)
                                         for s in ("mean", "std", "min", "p25", "p50", "p75", "max")])


#: Rows of which one block of moments is made, and the relative variance below which a column may be constant.
MOMENT_ROWS, NEARLY_CONSTANT = 4096, 1e-9


def _block_moments(x: np.ndarray, out: np.ndarray) -> None:
    """Add the moments of a block (rows x columns, NaN for null) to ``out`` (4, columns, columns).

    Entry [., a, b] belongs to the rows in which both columns have a value: their number, the sums of a and of a
    squared, and the sum of a * b.  Rows with an infinite value are taken one by one, as 0 * inf is no 0.
    """
    there = ~np.isnan(x)
    odd = np.isinf(x).any(1)
    m, v = there[~odd].astype(float), np.where(there[~odd], x[~odd], 0.0)
    out[0] += m.T @ m
    out[1] += v.T @ m
    out[2] += (v * v).T @ m
    out[3] += v.T @ v
    with np.errstate(invalid="ignore"):
        for row, ok in zip(x[odd], there[odd]):
            at = np.flatnonzero(ok)
            both = np.ix_(at, at)
            out[0][both] += 1
            out[1][both] += row[at, None]
            out[2][both] += row[at, None] ** 2
            out[3][both] += row[at, None] * row[None, at]


def pair_moments(table: DataFrame, cols: list[str], centre: dict[str, float]) -> DataFrame:
    """(i, j, n, sa, sb, saa, sbb, sab) for each pair i <= j of ``cols``: moments over the rows in which both have a
    value, of values less ``centre``.  One pass; a task multiplies blocks of columns and gives out one row a pair."""
    shift = np.array([centre[c] for c in cols])

    def run(batches):
        total = np.zeros((4, len(cols), len(cols)))
        for batch in batches:
            for a in range(0, batch.num_rows, MOMENT_ROWS):
                some = batch.slice(a, MOMENT_ROWS)
                _block_moments(np.stack([pc.cast(some.column(c), pa.float64()).to_numpy(zero_copy_only=False) for c in cols], 1) - shift, total)
        i, j = np.triu_indices(len(cols))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[0][i, j].astype(np.int64)),
             *[pa.array(x) for x in (total[1][i, j], total[1][j, i], total[2][i, j], total[2][j, i], total[3][i, j])]],
            names=["i", "j", "n", "sa", "sb", "saa", "sbb", "sab"])

    sums = table.select(*[_c(c).cast("double").alias(c) for c in cols]).mapInArrow(
        run, "i int, j int, n bigint, sa double, sb double, saa double, sbb double, sab double")
    return sums.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")])


def correlation_matrix(df: DataFrame, cols: list[str] | None = None, decimals: int | None = 6) -> DataFrame:
    """Pearson correlation of every pair (pairwise complete), long form, mirrored.

    The columns are written once.  One pass over them gives the moments of all pairs by products of column
    blocks (``pair_moments``; values are centred by their column's mean, so that sums of squares keep their digits);
    rows are not expanded, and one row a pair and task is shuffled.  A pair in which a column has one value only
    has no correlation; the few pairs whose variance is nearly 0 are looked at by minimum and maximum.
    """
    cols = cols or numeric_columns(df)
    spark = df.sparkSession
    plain = [f"c{i}" for i in range(len(cols))]
    kept = stored(df.select(*[_c(c).cast("double").alias(x) for c, x in zip(cols, plain)]), "correlation")
    mean = kept.agg(*[F.avg(x).alias(x) for x in plain]).first()
    centre = {x: mean[x] if mean[x] is not None and math.isfinite(mean[x]) else 0.0 for x in plain}
    sums = stored(pair_moments(kept, plain, centre), "moments")
    va, vb = (F.col("n") * F.col(f"s{x}{x}") - F.col(f"s{x}") * F.col(f"s{x}") for x in "ab")
    flat = (va <= NEARLY_CONSTANT * F.col("n") * F.col("saa")) | (vb <= NEARLY_CONSTANT * F.col("n") * F.col("sbb"))
    doubtful = [(r["i"], r["j"]) for r in sums.where(F.col("n") >= 2).where(flat).select("i", "j").collect()]
    constant: list[tuple[int, int]] = []
    for start in range(0, len(doubtful), 50):
        some = doubtful[start:start + 50]
        ends = kept.agg(*[e for k, (i, j) in enumerate(some) for x, y in ((i, j), (j, i)) for e in (
            F.min(F.when(F.col(plain[y]).isNotNull(), F.col(plain[x]))).alias(f"lo{k}_{x}_{y}"),
            F.max(F.when(F.col(plain[y]).isNotNull(), F.col(plain[x]))).alias(f"hi{k}_{x}_{y}"))]).first()
        constant += [(i, j) for k, (i, j) in enumerate(some) if any(
            ends[f"lo{k}_{x}_{y}"] == ends[f"hi{k}_{x}_{y}"] for x, y in ((i, j), (j, i)))]
    name = F.array(*[F.lit(c) for c in cols])
    no = F.lit(False) if not constant else F.struct("i", "j").isin(
        [F.struct(F.lit(i).cast("int").alias("i"), F.lit(j).cast("int").alias("j")) for i, j in constant])
    n = F.col("n")
    covariance = n * F.col("sab") - F.col("sa") * F.col("sb")
    corr = F.when((n < 2) | no, F.lit(None).cast("double")).otherwise(
        F.try_divide(covariance, F.nullif(F.sqrt(va) * F.sqrt(vb), F.lit(0.0))))
    upper = sums.select(name[F.col("i")].alias("col_a"), name[F.col("j")].alias("col_b"),
                        F.when(F.col("i") == F.col("j"), F.when(corr.isNotNull(), F.lit(1.0) + corr * 0)).otherwise(corr).alias("corr"))
    mirrored = upper.where("col_a <> col_b").select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr")
    out = upper.unionByName(mirrored)
    return out.withColumn("corr", fround("corr", decimals)) if decimals is not None else out


def nullity_correlation(df: DataFrame, cols: list[str] | None = None, decimals: int | None = 6) -> DataFrame:
    """Correlation of is-null flags; columns never or always null are left out.

    Closed form from n, n_a, n_b, n_ab (all counts from one aggregate).
    """
    cols = cols or df.columns
    counts = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(_c(c).isNull()).alias(c) for c in cols]).first()
    n = counts["__n"]
    keep = [c for c in cols if 0 < counts[c] < n]
    if not keep:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, corr double")
    pairs = [(a, b) for i, a in enumerate(keep) for b in keep[i:]]
    wide = df.agg(F.count(F.lit(1)).alias("n"),
                  *[F.count_if(_c(c).isNull()).alias(f"n_{j}") for j, c in enumerate(keep)],
                  *[F.count_if(_c(a).isNull() & _c(b).isNull()).alias(f"nab_{i}") for i, (a, b) in enumerate(pairs)])
    idx = {c: j for j, c in enumerate(keep)}
    exprs = []
    for i, (a, b) in enumerate(pairs):
        # products of counts in double: in long they overflow from 3e9 rows on
        na, nb, nab, n_ = (F.col(x).cast("double") for x in (f"n_{idx[a]}", f"n_{idx[b]}", f"nab_{i}", "n"))
        num = n_ * nab - na * nb
        den = F.sqrt(na * (n_ - na)) * F.sqrt(nb * (n_ - nb))
        exprs.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                              (num / den).alias("corr")))
    upper = wide.select(F.explode(F.array(*exprs)).alias("r")).select("r.*")
    mirrored = upper.where("col_a <> col_b").select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr")
    out = upper.unionByName(mirrored)
    return out.withColumn("corr", fround("corr", decimals)) if decimals is not None else out


def cleaning_report(before: DataFrame, after: DataFrame, entity: str = "entity_id",
                    removed_years: list[int] | None = None) -> DataFrame:
    """One-row before/after summary of a cleaning step (counts; removed ids: ``removed_entities``)."""
    def side(df, tag):
        ncols = len(df.columns)
        nulls = sum((F.count_if(_c(c).isNull()) for c in df.columns), F.lit(0))
        # pandas' unique() counts a missing entity as one more value
        ents = F.count_distinct(_c(entity)) + F.max(_c(entity).isNull().cast("int"))
        return df.agg(F.count(F.lit(1)).alias(f"rows_{tag}"), F.lit(ncols).alias(f"cols_{tag}"),
                      F.coalesce(ents, F.lit(0)).cast("long").alias(f"entities_{tag}"),
                      nulls.cast("long").alias(f"null_cells_{tag}"))
    b, a = side(before, "before"), side(after, "after")
    rep = b.crossJoin(a)
    years = ",".join(str(y) for y in (removed_years or [])) or "none"
    for tag in ("before", "after"):
        cells = F.col(f"rows_{tag}") * F.col(f"cols_{tag}")
        rep = rep.withColumn(f"null_pct_{tag}", fround(F.when(cells > 0, F.col(f"null_cells_{tag}") / cells * 100)
                                                       .otherwise(F.lit(0.0)), 2))
    return rep.withColumn("entities_removed", F.col("entities_before") - F.col("entities_after")) \
              .withColumn("removed_years", F.lit(years))


def removed_entities(before: DataFrame, after: DataFrame, entity: str = "entity_id") -> DataFrame:
    """The removed entity ids, one row each (never gathered into one value)."""
    return (before.select(entity).where(_c(entity).isNotNull()).distinct()
            .join(after.select(entity).distinct(), entity, "left_anti"))


def nullity_distance(df: DataFrame, cols: list[str] | None = None, decimals: int | None = 6) -> DataFrame:
    """Euclidean distance between the null patterns of every column pair."""
    cols = cols or df.columns
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.count_if(_c(a).isNull() != _c(b).isNull()).alias(f"d{i}") for i, (a, b) in enumerate(pairs)])
    body = ", ".join(f"'{a}', '{b}', SQRT(CAST(d{i} AS DOUBLE))" for i, (a, b) in enumerate(pairs))
    out = wide.selectExpr(f"stack({len(pairs)}, {body}) AS (col_a, col_b, distance)")
    return out.withColumn("distance", fround("distance", decimals)) if decimals is not None else out


def nullity_clusters(distances: DataFrame) -> list[tuple[str, str, float, int]]:
    """Average-linkage merge order over the (small, columns x columns) distance table.

    Returns (cluster_a, cluster_b, distance, size) per merge; clusters are named by their
    sorted member lists.  The table has one row per column pair, so it is tiny.
    """
    rows = distances.collect()
    d = {}
    names = set()
    for r in rows:
        d[frozenset((r["col_a"],))] = None
        names.update((r["col_a"], r["col_b"]))
    clusters = {frozenset((n,)) for n in names}
    base = {(r["col_a"], r["col_b"]): r["distance"] for r in rows}
    base.update({(b, a): v for (a, b), v in list(base.items())})

    def link(x, y):
        vals = [base[(i, j)] for i in x for j in y]
        return sum(vals) / len(vals)
    merges = []
    while len(clusters) > 1:
        cl = sorted(clusters, key=lambda s: sorted(s))
        best = None
        for i, x in enumerate(cl):
            for y in cl[i + 1:]:
                v = link(x, y)
                if best is None or v < best[0] - 1e-12:
                    best = (v, x, y)
        v, x, y = best
        clusters -= {x, y}
        clusters.add(x | y)
        merges.append((",".join(sorted(x)), ",".join(sorted(y)), v, len(x | y)))
    return merges


@dataclass
class ColumnCheck:
    ok: bool
    missing: list[str] = field(default_factory=list)
    extra: list[str] = field(default_factory=list)


def validate_columns(df: DataFrame, expected: list[str]) -> ColumnCheck:
    """False (with the sorted missing list) if any expected column is absent; extras only warn."""
    missing = sorted(set(expected) - set(df.columns))
    extra = sorted(set(df.columns) - set(expected))
    if missing:
        log.error("missing columns: %s", missing)
        return ColumnCheck(False, missing, extra)
    if extra:
        log.warning("extra columns: %s", extra)
    return ColumnCheck(True, [], extra)


def validate_processed(spark, path: str, target: str, fmt: str = "parquet") -> bool:
    """The stage exists, is readable and has the target column."""
    from ..sources.csv_io import scan_csv
    try:
        df = scan_csv(spark, path) if fmt == "csv" else spark.read.parquet(path)
    except Exception as exc:  # missing or unreadable
        log.error("cannot read %s: %s", path, exc)
        return False
    if target not in df.columns:
        log.error("target %s not in %s", target, path)
        return False
    return True


def integrity_report(df: DataFrame) -> DataFrame:
    """Duplicate rows and per-column null counts from one shuffle.

    Rows are grouped on all columns once; duplicates are sum(count - 1) and the null count of
    a column is the sum of group counts where that column is null.
    """
    cols = df.columns
    g = df.groupBy(*[_c(c) for c in cols]).count()
    wide = g.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("__dups"),
                 F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("__rows"),
                 *[F.coalesce(F.sum(F.when(_c(c).isNull(), F.col("count"))), F.lit(0)).cast("long").alias(c)
                   for c in cols])
    long = _unpivot_row(wide, cols, "missing_count", "BIGINT", carry=["__dups", "__rows"])
    return (long.where(F.col("missing_count") > 0)
            .select(F.col("__dups").alias("duplicate_rows"), "column", "missing_count",
                    fround(F.col("missing_count") / F.col("__rows") * 100, 2).alias("missing_pct")))


def assert_complete(df: DataFrame) -> None:
    """Raise if any null is left."""
    n = missing_cells(df).first()["null_cells"]
    if n:
        raise AssertionError(f"{n} null cells remain after imputation")
