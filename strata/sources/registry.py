"""Versioned model store (A5): models saved as the next version of a name, an index table
(name, version, path) appended per save, and "latest" resolved with ``max_by``."""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INDEX_SCHEMA = "name string, version int, path string, saved_at timestamp"


def _index_path(root: str) -> str:
    return f"{root.rstrip('/')}/_index"


def read_index(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(INDEX_SCHEMA).parquet(_index_path(root))
    except AnalysisException:
        return spark.createDataFrame([], INDEX_SCHEMA)


def latest_model(index: DataFrame) -> DataFrame:
    """One row per model name: the newest version and its path."""
    return index.groupBy("name").agg(F.max("version").alias("version"),
                                     F.max_by("path", "version").alias("path"))


def save_model_version(spark: SparkSession, model, root: str, name: str) -> tuple[int, str]:
    idx = read_index(spark, root)
    current = idx.where(F.col("name") == name).agg(F.max("version")).first()[0]
    version = (current or 0) + 1
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    # a version that is stored but not in the index (a lost index, a failed append) is never overwritten
    while True:
        path = f"{root.rstrip('/')}/{name}/v{version}"
        p = fs_path(path)
        if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            break
        version += 1
    model.write().save(path)
    row = spark.createDataFrame([(name, version, path)], "name string, version int, path string")
    row.withColumn("saved_at", F.current_timestamp()).write.mode("append").parquet(_index_path(root))
    return version, path


def load_latest_model(spark: SparkSession, root: str, name: str):
    from pyspark.ml import PipelineModel
    hit = latest_model(read_index(spark, root)).where(F.col("name") == name).first()
    if hit is None:
        raise KeyError(f"no stored model named {name!r}")
    return PipelineModel.load(hit["path"])
