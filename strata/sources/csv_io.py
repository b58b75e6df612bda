"""Headed CSV scan and sink (A1, A2).

The scan reads every column as text, nulls out the missing-value tokens, then casts to
the declared schema by column name (or to double where every value coerces when
``infer=True``).  A missing path raises ``FileNotFoundError``.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import NA_TOKENS, coerce_double


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             na_tokens: list[str] | None = None, infer: bool = False) -> DataFrame:
    tokens = NA_TOKENS if na_tokens is None else na_tokens
    try:
        raw = (spark.read.option("header", True).option("inferSchema", False)
               .option("mode", "FAILFAST").option("quote", '"').option("escape", '"').option("multiLine", True)
               .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
               .option("lineSep", "\n").csv(path))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(path) from exc
        raise
    cleaned = raw.select(*[
        F.when(F.col(f"`{c}`").isin(tokens), F.lit(None).cast("string")).otherwise(F.col(f"`{c}`")).alias(c)
        for c in raw.columns])
    if schema is not None:
        st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        missing = [f.name for f in st.fields if f.name not in cleaned.columns]
        if missing:
            raise ValueError(f"CSV {path} lacks columns {missing}")
        return cleaned.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in st.fields])
    if infer:
        # one distributed pass: a column is numeric when every non-null value coerces
        checks = cleaned.agg(*[
            F.count_if(F.col(f"`{c}`").isNotNull() & coerce_double(F.col(f"`{c}`")).isNull()).alias(c)
            for c in cleaned.columns]).first()
        return cleaned.select(*[
            (coerce_double(F.col(f"`{c}`")) if checks[c] == 0 else F.col(f"`{c}`")).alias(c)
            for c in cleaned.columns])
    return cleaned


def sink_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write with a header, no index column; parent folders are created; overwrite by default.  Quotes inside a
    quoted field are doubled, and line feeds, commas and outer spaces survive a round trip."""
    (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path
