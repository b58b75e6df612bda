"""Prediction-record store operations (A6 append, A7 page)."""
from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import global_index
from ..session import stored

PREDICTION_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("client_id", T.StringType(), False),
    T.StructField("income", T.DoubleType(), True),
    T.StructField("expenses", T.DoubleType(), True),
    T.StructField("debt", T.DoubleType(), True),
    T.StructField("assets", T.DoubleType(), True),
    T.StructField("prediction", T.DoubleType(), True),
    T.StructField("risk_level", T.StringType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])


def append_predictions(existing: DataFrame, new: DataFrame, key: str = "client_id", id_col: str = "id",
                       clock: Column | None = None) -> DataFrame:
    """Existing records plus the new ones whose key is not stored yet.

    The key stays unique: duplicates inside ``new`` collapse to one record, keys already
    stored are skipped (left anti join).  Surrogate ids continue after the largest stored id
    in key order (distributed positions, no single-task window).  ``clock`` fills the
    timestamp (default: the query's current timestamp).
    """
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long").alias("_max_id"))
    fresh = _fresh(existing, new, key, id_col)
    appended = _numbered(fresh.crossJoin(F.broadcast(top)), F.col("_max_id"), key, id_col, clock)
    base = existing
    if "timestamp" not in base.columns:
        base = base.withColumn("timestamp", F.lit(None).cast("timestamp"))
    return base.select(*[f.name for f in PREDICTION_SCHEMA.fields]).unionByName(appended)


def _fresh(existing: DataFrame, new: DataFrame, key: str, id_col: str) -> DataFrame:
    """One record for each key of ``new`` that ``existing`` hasn't."""
    others = [c for c in new.columns if c not in (id_col, "timestamp", key)]
    one = new.groupBy(key).agg(F.min(F.struct(*others)).alias("_r")).select(key, "_r.*")
    return one.join(existing.select(key), key, "left_anti")


def _numbered(fresh: DataFrame, after: Column, key: str, id_col: str, clock: Column | None) -> DataFrame:
    """Records in the store's schema, with ids after ``after`` in the order of keys."""
    out = (global_index(fresh, [key]).withColumn(id_col, (after + F.col("_gidx") + 1).cast("long"))
           .withColumn("timestamp", (clock if clock is not None else F.current_timestamp()).cast("timestamp")))
    for c in ("prediction", "risk_level"):
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("double" if c == "prediction" else "string"))
    return out.select(*[f.name for f in PREDICTION_SCHEMA.fields])


#: Tries of a lease and seconds between them.
LEASE_TRIES, LEASE_WAIT = 200, 0.05


def lease_ids(spark, path: str, n: int, least: int = 0) -> int:
    """Reserve ``n`` ids beside the store at ``path``: returns the largest id before the range.

    Leases are numbered files in the shared folder ``<path>.leases``; each says who took it and where its range
    ends.  The next number belongs to the writer that creates its file: creation refuses an existing file, and as
    some file systems check that before they create, the file is read again after a pause and must still
    name its writer.  A range that is leased and not written stays unused; ids are unique, not gapless.
    """
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.leases")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    me = uuid.uuid4().hex

    def read(number: int) -> list[str]:
        stream = fs.open(jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}"))
        try:
            return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split()
        finally:
            stream.close()

    for _ in range(LEASE_TRIES):
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        last = max((int(x) for x in names if x.isdigit()), default=-1)
        said = read(last) if last >= 0 else ["", "0"]
        if len(said) == 2:  # else its writer is still at it
            top = max(least, int(said[1]))
            mine = jvm.org.apache.hadoop.fs.Path(folder, f"{last + 1:012d}")
            try:
                stream = fs.create(mine, False)
                stream.write(bytearray(f"{me} {top + n}", "ascii"))
                stream.close()
            except Py4JJavaError as e:
                if "exist" not in str(e.java_exception).lower():
                    raise
            else:
                time.sleep(LEASE_WAIT)
                if read(last + 1)[:1] == [me]:
                    return top
        time.sleep(LEASE_WAIT)
    raise TimeoutError(f"no lease of ids in {folder.toString()} after {LEASE_TRIES} tries")


def _add_files(spark, df: DataFrame, path: str) -> None:
    """Write ``df`` beside the store and move its files, whose names are unique, into it.  Two appends to one folder
    would share its folder of unfinished files, which the first to end deletes."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    own, store = path_of(f"{path.rstrip('/')}.incoming-{uuid.uuid4().hex}"), path_of(path)
    df.write.parquet(own.toString())
    fs = store.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(store)
    for status in fs.listStatus(own):
        name = status.getPath().getName()
        if name.startswith("part-") and not fs.rename(status.getPath(), path_of(store, name)):
            raise OSError(f"could not move {name} into {path}")
    fs.delete(own, True)


def sink_predictions(spark, path: str, new: DataFrame, key: str = "client_id", clock: Column | None = None) -> DataFrame:
    """A6 as a sink: append to the Parquet store at ``path`` the records whose key isn't stored, and nothing else.

    Stored files are read for their keys and the largest id and never rewritten.  The new ids are leased first
    (``lease_ids``), so writers at the same time get distinct ids (a key that both bring is stored by both).
    Returns the stored table.
    """
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        before = spark.read.schema(PREDICTION_SCHEMA).parquet(path)
    else:
        before = spark.createDataFrame([], PREDICTION_SCHEMA)
    top = before.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m"))
    fresh = stored(_fresh(before, new, key, "id"), "fresh-records")
    n, least = fresh.count(), top.first()["m"]
    if n:
        start = lease_ids(spark, path, n, least)
        _add_files(spark, _numbered(fresh, F.lit(start), key, "id", clock), path)
    return spark.read.schema(PREDICTION_SCHEMA).parquet(path)


def page(df: DataFrame, skip: int = 0, limit: int = 100, order_by: str = "id") -> DataFrame:
    """Paged read in id order (top-k of skip+limit rows, then offset)."""
    return df.orderBy(F.col(order_by).asc_nulls_last()).offset(skip).limit(limit)
