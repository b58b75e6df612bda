"""Parquet table scans with the NaN -> null rule applied at the scan."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.exprs import normalize_floats
from ..session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read ``<sf_dir>/<name>.parquet``; project early so the scan's ReadSchema is pruned."""
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns:
        df = df.select(*columns)
    return normalize_floats(df)
