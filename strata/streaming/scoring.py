"""Online scoring re-aimed as Structured Streaming.

Arriving record files are read as a stream.  Each micro-batch keeps the first record of every key by (event
time, tie-break), scores it and appends it to the store with a left anti join on the key, so each key is
stored once: the first record of the first micro-batch that holds the key wins, whatever its event time.
Nothing waits for or is cut off by a watermark, so late records are stored too.  The store is partitioned by
a bucket of the key's hash, and a micro-batch reads the keys of its own buckets only.
``trigger(availableNow=True)`` processes what is there and stops; with the checkpoint and the anti join a
restarted or retried micro-batch stores nothing twice.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _stored_keys(spark: SparkSession, sink_path: str, key: str) -> DataFrame | None:
    if not _path_exists(spark, sink_path):
        return None
    try:
        return spark.read.parquet(sink_path).select(key, "_bucket")
    except AnalysisException:  # folder without data files yet
        return None


def of_buckets(stored: DataFrame, buckets: list[int]) -> DataFrame:
    """The part of the store in some buckets: their folders only are listed and read."""
    return stored.where(F.col("_bucket").isin(sorted(buckets)))


def stream_score(spark: SparkSession, source_dir: str, schema: T.StructType | str,
                 score: Callable[[DataFrame], DataFrame], sink_path: str, checkpoint_path: str,
                 key: str = "user_id", event_time: str = "ts", tie: str | None = None,
                 path_glob: str | None = None, max_files_per_trigger: int | None = None,
                 buckets: int = 64) -> DataFrame:
    """Run the stream until the available input is consumed; return the stored table.

    ``tie`` orders records of one key with one event time (default: all columns in turn).  Rows with a null
    key are one key.
    """
    reader = spark.readStream.schema(schema)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    timed = reader.parquet(source_dir).withColumn(event_time, F.col(event_time).cast("timestamp"))

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        others = [c for c in batch.columns if c != key]
        order = F.struct(event_time, *([tie] if tie else []), *[c for c in others if c not in (event_time, tie)])
        first = batch.groupBy(key).agg(F.min_by(F.struct(*others), order).alias("_r")).select(key, "_r.*")
        scored = score(first.select(*batch.columns)).withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        stored = _stored_keys(batch.sparkSession, sink_path, key)
        if stored is not None:
            # at most ``buckets`` numbers, as a literal filter: an anti join by itself prunes no folders
            mine = [r[0] for r in batch.select(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).distinct().collect()]
            stored = of_buckets(stored, mine)
            known = stored.select(F.col(key).alias("_key"), F.col("_bucket").alias("_known_bucket"))
            scored = scored.join(known, (F.col("_bucket") == F.col("_known_bucket")) & F.col(key).eqNullSafe(F.col("_key")),
                                 "left_anti")
        # one file a bucket and micro-batch
        scored.withColumn("_epoch", F.lit(epoch_id)).repartition(buckets, "_bucket").write.mode("append").partitionBy("_bucket").parquet(sink_path)

    q = (timed.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink_path).drop("_bucket")
