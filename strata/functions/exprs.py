"""Native column expressions shared by the operators.

Everything here returns ``Column`` objects (JVM-side, inside whole-stage codegen);
nothing runs row-at-a-time in Python.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The default missing-value tokens of pandas' CSV reader, which the
# reference relies on when it loads its CSV stages.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Fixed value: Spark's string->double cast accepts a trailing d/D/f/F type suffix
# ("1d" -> 1.0); pandas' coercion rejects it.  Strings ending that way become null.
TYPE_SUFFIX_PATTERN = r"[0-9.][dDfF]\s*$"

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def normalize_floats(df: DataFrame) -> DataFrame:
    """NaN -> null on every floating column (pandas has one missing marker, Spark two)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def coerce_double(c: Column | str) -> Column:
    """Text -> double where pandas' ``to_numeric(errors='coerce')`` would succeed, else null."""
    c = F.col(c) if isinstance(c, str) else c
    s = c.cast("string")
    return F.when(s.rlike(TYPE_SUFFIX_PATTERN), F.lit(None).cast("double")).otherwise(s.try_cast("double"))


def numeric_columns(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> list[str]:
    """Columns of a numeric type (booleans excluded), in schema order, minus ``exclude``."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in set(exclude)]


def hash_uniform(key: Column | str | list, seed: int, salt: str | None = None) -> Column:
    """Reproducible draw in [0, 1): first 8 hex digits of md5('seed[:salt]:key') / 2^32.

    The same value is computed by ``hash_uniform_sql`` in any SQL engine with md5.
    """
    keys = key if isinstance(key, list) else [key]
    parts = [F.lit(str(seed))]
    if salt is not None:
        parts.append(F.lit(str(salt)))
    for k in keys:
        parts.append((F.col(k) if isinstance(k, str) else k).cast("string"))
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_uniform_sql(key_sql: str | list[str], seed: int, salt: str | None = None) -> str:
    keys = key_sql if isinstance(key_sql, list) else [key_sql]
    parts = [f"'{seed}'"] + ([f"'{salt}'"] if salt is not None else [])
    parts += [f"CAST({k} AS VARCHAR)" for k in keys]
    return (f"(CAST(('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 8)) AS BIGINT)"
            f" / 4294967296.0)")


def quantize(c: Column | str, lo: float = 0.0, hi: float = 1.0, n: int = 9) -> Column:
    """Equal-width class of ``c`` in [lo, hi] into n classes, clamped; null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    inside = F.least(F.lit(float(hi)), F.greatest(F.lit(float(lo)), c))  # before the cast, so +-inf is clamped too
    raw = F.floor(F.lit(float(n)) * (inside - F.lit(float(lo))) / F.lit(float(hi - lo)))
    # greatest/least skip nulls, so the null guard is explicit
    return F.when(c.isNotNull(), F.least(F.lit(n - 1), F.greatest(F.lit(0), raw.cast("int"))))


def safe_corr(a: Column | str, b: Column | str) -> Column:
    """Pearson correlation over rows where both are non-null (pandas' pairwise-complete rule).

    Null when fewer than two pairs or either side is constant on those rows; never raises
    under ANSI mode.
    """
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    both = a.isNotNull() & b.isNotNull()
    xa = F.when(both, a.cast("double"))
    xb = F.when(both, b.cast("double"))
    degenerate = (F.count(xa) < 2) | (F.min(xa) == F.max(xa)) | (F.min(xb) == F.max(xb))
    denom = F.stddev_pop(xa) * F.stddev_pop(xb)
    return F.when(degenerate, F.lit(None).cast("double")).otherwise(
        F.try_divide(F.covar_pop(xa, xb), F.nullif(denom, F.lit(0.0))))


def fround(c: Column | str, d: int) -> Column:
    """``c`` to d decimals, halves to even on the scaled binary value, as numpy and pandas round:
    ``rint(c * 10^d) / 10^d``.  ``plans.sqlgen.fround_sql`` is its SQL twin; Spark's ``round`` works on the shortest
    decimal form instead, and the two differ where that form ends in 5 at the cut."""
    c = F.col(c) if isinstance(c, str) else c
    m = F.lit(float(10 ** d))
    return F.rint(c.cast("double") * m) / m
