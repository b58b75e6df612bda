"""Named datasets between steps (A3): Parquet folders under one root."""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

STAGE_NAMES = ("raw", "with_target", "processed", "final", "features")


@dataclass
class Stages:
    root: str
    names: tuple[str, ...] = field(default=STAGE_NAMES)

    def path(self, name: str) -> str:
        if name not in self.names:
            raise KeyError(f"unknown stage {name!r}; known: {self.names}")
        return f"{self.root.rstrip('/')}/{name}"

    def write(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> str:
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(name))
        return self.path(name)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.path(name))
