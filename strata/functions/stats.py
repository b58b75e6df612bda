"""Scalable global order statistics (K1) and global prefix sums / positions (K2).

* ``column_quantiles`` / ``column_medians``: exact linear-interpolated quantiles by radix counting.  A double is
  read as a 64-bit integer of the same order; up to four passes count values by 16 bits each, from the top down,
  in the prefix that holds the wanted rank.  The number of jobs does not grow with columns, ranks or rows;
  no rows are sorted, and one row a rank (and in the last pass at most ``FEW`` counts) reaches the driver.
* ``prefix_sums`` / ``global_index``: running totals in a global order without a window that moves rows to
  one task.  Rows are range-partitioned once, sorted and numbered within their partition, and written; sums
  over the partitions before (one row each) are added when the table is read.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

#: Bits counted in a pass, passes over the 64 bits of a double, and values so few that they are looked at one by one.
RADIX, PASSES, FEW = 16, 4, 50_000
#: ``monotonically_increasing_id`` keeps the place within a partition in so many low bits.
PLACE_BITS = 33


def _qname(col: str, p: float) -> str:
    return f"{col}__q{p}"


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit integers in the order of the doubles; -0.0 equals 0.0, NaN is above all."""
    v = np.asarray(values, np.float64) + 0.0
    v = np.where(np.isnan(v), np.nan, v)
    bits = v.view(np.uint64)
    return np.where(bits >> np.uint64(63) == 1, ~bits, bits | np.uint64(1 << 63))


def bits_value(key: int) -> float:
    """The double of an ordered integer."""
    bits = key ^ (1 << 63) if key >> 63 else key ^ ((1 << 64) - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])


def _digit_counts(table: DataFrame, cols: list[str], targets: list[tuple[int, int]], shift: int, bits: int = RADIX) -> DataFrame:
    """(t, d, n): for each target (column, prefix), how many of its values have the digit ``d``, ``bits`` wide, above
    ``shift``.  The prefix is what stands above that digit."""
    def run(batches):
        for batch in batches:
            keys = {}
            for t, (i, prefix) in enumerate(targets):
                if i not in keys:
                    col = batch.column(cols[i])
                    keys[i] = ordered_bits(pc.drop_null(col).to_numpy(zero_copy_only=False)) >> np.uint64(shift)
                k = keys[i]
                if shift + bits < 64:
                    k = k[k >> np.uint64(bits) == np.uint64(prefix)]
                digits, n = np.unique(k & np.uint64((1 << bits) - 1), return_counts=True)
                if len(digits):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(n), t, np.int32)), pa.array(digits.astype(np.int64)), pa.array(n.astype(np.int64))],
                        names=["t", "d", "n"])

    wide = table.select(*sorted({cols[i] for i, _ in targets}))
    return wide.mapInArrow(run, "t int, d bigint, n bigint").groupBy("t", "d").agg(F.sum("n").alias("n"))


def order_statistics(table: DataFrame, cols: list[str], wanted: set[tuple[int, int]], few: int = FEW) -> dict[tuple[int, int], float]:
    """Values at 0-based ranks among the non-null values of double columns, exact: {(column, rank): value}.

    At most ``PASSES`` passes; the last one comes as soon as no more than ``few`` values share the wanted prefixes.
    """
    spark = table.sparkSession
    state = {w: (0, w[1]) for w in wanted}  # prefix so far, rank within it
    left = 64
    while left:
        targets = sorted({(i, prefix) for (i, _), (prefix, _) in state.items()})
        where = {t: j for j, t in enumerate(targets)}
        order = sorted(state)
        counts = _digit_counts(table, cols, targets, left - RADIX)
        values = ", ".join(f"({w}, {where[i, state[i, r][0]]}, {state[i, r][1]}L)" for w, (i, r) in enumerate(order))
        asked = spark.sql(f"SELECT * FROM VALUES {values} AS asked(w, t, r)")
        upto = Window.partitionBy("t").orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        found = (counts.withColumn("_upto", F.sum("n").over(upto)).join(F.broadcast(asked), "t")  # one row a rank
                 .where((F.col("r") < F.col("_upto")) & (F.col("r") >= F.col("_upto") - F.col("n")))
                 .select("w", "d", "n", (F.col("r") - F.col("_upto") + F.col("n")).alias("left")).collect())
        sizes = {}
        for row in found:
            i, r = order[row["w"]]
            prefix = state[i, r][0] << RADIX | row["d"]
            state[i, r], sizes[i, prefix] = (prefix, row["left"]), row["n"]
        left -= RADIX
        if 0 < left and sum(sizes.values()) <= few:
            targets = sorted(sizes)
            rest: dict[int, list] = {j: [] for j in range(len(targets))}
            # Less than 2**63, so that digits are plain longs; at most ``few`` rows.
            for row in _digit_counts(table, cols, targets, 0, left).orderBy("t", "d").collect():
                rest[row["t"]].append((row["d"], row["n"]))
            where = {t: j for j, t in enumerate(targets)}
            for (i, r), (prefix, place) in state.items():
                for d, n in rest[where[i, prefix]]:
                    if place < n:
                        state[i, r] = (prefix << left | d, 0)
                        break
                    place -= n
            left = 0
    return {w: bits_value(key) for w, (key, _) in state.items()}


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float], stored: bool = False) -> DataFrame:
    """One-row DataFrame with a column ``<col>__q<p>`` per (column, probability).

    Linear interpolation between order statistics (pandas / DuckDB ``quantile_cont``) of the non-null values;
    null for a column without values.  ``df`` is read five times: it is written once before, unless the
    caller says that it is ``stored``, a table or a checkpoint.
    """
    spark = df.sparkSession
    plain = [f"c{i}" for i in range(len(cols))]
    wide = df.select(*[F.col(f"`{c}`").cast("double").alias(x) for c, x in zip(cols, plain)])
    if not stored:
        path = scratch_path(spark, "quantiles")
        wide.write.parquet(path)
        wide = spark.read.schema(", ".join(f"{x} double" for x in plain)).parquet(path)
    names = [_qname(c, p) for c in cols for p in probs]
    schema = ", ".join(f"`{n}` double" for n in names)
    sizes = wide.agg(*[F.count(x).alias(x) for x in plain]).first() if plain else {}
    ranks = {}
    for i, x in enumerate(plain):
        for p in probs if sizes[x] else ():
            at = (sizes[x] - 1) * p
            low = min(int(math.floor(at)), sizes[x] - 1)
            ranks[i, p] = (low, min(low + 1, sizes[x] - 1), at - low)
    wanted = {(i, r) for (i, _), (low, high, _) in ranks.items() for r in (low, high)}
    found = order_statistics(wide, plain, wanted) if wanted else {}
    row = []
    for i in range(len(cols)):
        for p in probs:
            if (i, p) not in ranks:
                row.append(None)
                continue
            low, high, frac = ranks[i, p]
            a, b = found[i, low], found[i, high]
            row.append(a if a == b or frac == 0 else a + (b - a) * frac)
    return spark.createDataFrame([tuple(row)], schema)


def column_medians(df: DataFrame, cols: list[str], stored: bool = False) -> DataFrame:
    """One-row DataFrame of exact medians, one column per input column (same names)."""
    q = column_quantiles(df, cols, [0.5], stored)
    return q.select(*[F.col(f"`{_qname(c, 0.5)}`").alias(c) for c in cols])


def _running(ordered: DataFrame, value_cols: list[str], prefix: str, previous: str | None) -> DataFrame:
    """Running sums (and with ``previous`` the values of the row before) within each partition, in its order, as one
    pass of numpy over Arrow batches."""
    kinds = {v: T.LongType() if isinstance(ordered.schema[v].dataType, T.IntegralType) else T.DoubleType() for v in value_cols}
    names = [f"{prefix}{v}" for v in value_cols] + ([f"{previous}{v}" for v in value_cols] if previous else [])
    schema = T.StructType([*ordered.schema.fields, *[T.StructField(n, kinds[v]) for n, v in zip(names, value_cols * 2)]])

    def run(batches):
        total, last = {v: 0 for v in value_cols}, {v: None for v in value_cols}
        for batch in batches:
            if not batch.num_rows:
                continue
            sums, before = [], []
            for v in value_cols:
                kind = np.int64 if isinstance(kinds[v], T.LongType) else np.float64
                some = pc.fill_null(batch.column(v).cast(pa.from_numpy_dtype(kind)), 0)
                run_sum = np.cumsum(some.to_numpy(zero_copy_only=False), dtype=kind) + total[v]
                total[v] = run_sum[-1]
                sums.append(pa.array(run_sum))
                before.append(pa.concat_arrays([pa.array([last[v]], some.type), some.slice(0, len(some) - 1)]))
                last[v] = some[len(some) - 1].as_py()
            yield pa.RecordBatch.from_arrays([*batch.columns, *sums, *(before if previous else [])], names=schema.names)

    return ordered.mapInArrow(run, schema)


def prefix_sums(df: DataFrame, order_cols: list[str], value_cols: list[str] = (),
                descending: bool = False, partitions: int | None = None,
                index_col: str = "_gidx", prefix: str = "cum_", bucket_col: str | None = None,
                previous: str | None = None) -> DataFrame:
    """Add a 0-based global position ``index_col`` in the total order of ``order_cols`` and an
    inclusive running sum ``cum_<v>`` of each value column (whole numbers or doubles; nulls add nothing).

    One range shuffle; ``order_cols`` must give a total order (unique keys) for positions to be reproducible.
    ``bucket_col`` also names the range that a row lies in, a stretch of positions; ``previous`` prefixes columns
    with the values of the row before (nulls as 0; null at the first row).
    """
    spark = df.sparkSession
    value_cols = list(value_cols)
    ordered = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in order_cols]
    ranged = df.repartitionByRange(partitions, *ordered) if partitions else df.repartitionByRange(*ordered)
    placed = ranged.sortWithinPartitions(*ordered).withColumn("__place", F.monotonically_increasing_id())
    if value_cols:
        placed = _running(placed, value_cols, "__run_", "__prev_" if previous else None)
    path = scratch_path(spark, "ordered")
    placed.write.parquet(path)  # freezes the ranges; lineage cut on shared storage
    table = spark.read.schema(placed.schema).parquet(path)
    bucket = F.shiftright("__place", PLACE_BITS).cast("int")
    totals = table.groupBy(bucket.alias("__bucket")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(v).alias(f"_t_{v}") for v in value_cols],
        *[F.max_by(F.coalesce(v, F.lit(0)), "__place").alias(f"_l_{v}") for v in value_cols if previous])
    across = Window.orderBy("__bucket")  # over one row a range
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "__bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("__off_n"),
        *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"__off_{v}") for v in value_cols],
        *[F.lag(f"_l_{v}").over(across).alias(f"__edge_{v}") for v in value_cols if previous])
    out = table.withColumn("__bucket", bucket).join(F.broadcast(offsets), "__bucket")
    place = F.col("__place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return out.select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("__off_n") + place).alias(index_col),
        *[(F.col(f"__off_{v}") + F.col(f"__run_{v}")).alias(f"{prefix}{v}") for v in value_cols],
        *[F.coalesce(f"__prev_{v}", f"__edge_{v}").alias(f"{previous}{v}") for v in value_cols if previous],
        *([F.col("__bucket").alias(bucket_col)] if bucket_col else []))


def global_index(df: DataFrame, order_cols: list[str], descending: bool = False,
                 index_col: str = "_gidx", bucket_col: str | None = None) -> DataFrame:
    """0-based global row position in the order of ``order_cols`` (K2 without values)."""
    return prefix_sums(df, order_cols, [], descending=descending, index_col=index_col, bucket_col=bucket_col)
