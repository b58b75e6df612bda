"""Shared pieces of the training-data operators: tables in the shared folder, code shipping, names by sorting."""
from __future__ import annotations

import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_path, table_path

#: ASCII white space, as the contracts name it.
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage and outlives its executors."""
    return written_path(df, name)[0]


#: Scratch tables of this process, in order.
made: list[str] = []


#: Spark removes the shuffle files of a query when it ends; the table that it wrote is all that later jobs read.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Rows of an Arrow batch that goes to Python.
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written_path(df: DataFrame, name: str, batch_rows: int | None = None) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    made.append(path)
    conf = {_TIDY: "true"} | ({_ROWS: str(batch_rows)} if batch_rows else {})
    was = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path), path


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    if path in made:
        made.remove(path)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary or string array, and where each value begins (one more at the end).  No copy."""
    if column.null_count:
        raise ValueError("nulls have no bytes")
    if pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give executors this package, once an application; Spark's file server carries it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="strata-code-"), "strata_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def row_id() -> F.Column:
    """Identity of an input row.  Computed in one scan only and carried from there, since a second scan may
    split its files otherwise."""
    return F.monotonically_increasing_id()


def null_safe(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys equal each other; the right side's keys go."""
    right = b.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in b.columns])
    cond = None
    for k in keys:
        c = a[k].eqNullSafe(right[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return a.join(right, cond, how).drop(*[f"_r_{k}" for k in keys])


_MAP = 1 << 15


def marked(df: DataFrame, keys: list[F.Column], wanted: DataFrame, wanted_keys: list[F.Column], name: str = "_maybe",
           bits: int = 26) -> DataFrame:
    """``df`` with ``name``: false where the keys are certainly not among those of ``wanted``.

    A bitmap of 2**``bits`` hash values, at most 8 MB whatever the number of keys, goes to all tasks, so rows
    that don't concern a following join needn't be shuffled for it.  The join itself stays exact.
    """
    spot = lambda k: F.pmod(F.xxhash64(*k), F.lit(1 << bits))
    maps = (wanted.select(spot(wanted_keys).alias("_h")).groupBy(F.floor(F.col("_h") / _MAP).alias("_bucket"))
            .agg(F.bitmap_construct_agg((F.col("_h") % _MAP)).alias("_bits")))
    at = F.col("_h") % _MAP
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (df.withColumn("_h", spot(keys)).withColumn("_bucket", F.floor(F.col("_h") / _MAP))
            .join(F.broadcast(maps), "_bucket", "left")
            .withColumn(name, F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False)))
            .drop("_h", "_bucket", "_bits"))


def sorted_names(df: DataFrame, keys: list[str], tie: str, out: str, table: str) -> DataFrame:
    """Integer names of key tuples, equal exactly when the keys are equal.

    Rows are range-partitioned by (hash of the key, ``tie``) and sorted by (hash, key), so equal keys are
    neighbours; each task numbers the runs.  As ``tie`` takes part in the ranges, a key with any share of the
    rows spreads over as many tasks as it needs.  A run that goes on in the next partition gets one name
    afterwards: every task also reports the keys of its first and last hash, two rows a task as a rule.
    """
    payload = [c for c in df.columns if c not in keys]
    ranged = (df.withColumn("_h", F.xxhash64(*keys))
                .repartitionByRange(F.col("_h"), F.col(tie))
                .sortWithinPartitions("_h", *keys))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in ranged.drop("_h").schema.fields]
                          + [T.StructField(out, T.LongType()), T.StructField("_edge", T.BooleanType())])

    def number(batches):
        base = TaskContext.get().partitionId() << 36
        name, last, group_h = -1, None, None
        first_h, firsts, group, types = None, {}, {}, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            t = pa.Table.from_batches([batch])
            cols = {c: t.column(c).combine_chunks() for c in t.column_names}
            types = {c: cols[c].type for c in cols}
            new = pa.array([True])
            if n > 1:
                diff = None
                for c in keys:
                    x = cols[c]
                    a, b = x.slice(1), x.slice(0, n - 1)
                    d = pc.fill_null(pc.not_equal(a, b), pa.scalar(True))
                    d = pc.and_not(d, pc.and_(pc.is_null(a), pc.is_null(b)))
                    diff = d if diff is None else pc.or_(diff, d)
                new = pa.concat_arrays([pa.array([True]), diff])
            flags = new.to_numpy(zero_copy_only=False).copy()
            head = tuple(cols[c][0].as_py() for c in keys)
            if last is not None and head == last:
                flags[0] = False
            ranks = flags.cumsum() + name
            name = int(ranks[-1])
            # Keys of the task's first hash value and of the latest one, which are reported.
            starts, hs = flags.nonzero()[0], cols["_h"]
            if first_h is None:
                first_h = hs[0].as_py()
            for i in map(int, starts):
                if hs[i].as_py() != first_h:
                    break
                firsts[tuple(cols[c][i].as_py() for c in keys)] = int(ranks[i])
            if group_h != (tail_h := hs[n - 1].as_py()):
                group_h, group = tail_h, {}
            for i in map(int, starts[::-1]):
                if hs[i].as_py() != tail_h:
                    break
                group[tuple(cols[c][i].as_py() for c in keys)] = int(ranks[i])
            last = tuple(cols[c][n - 1].as_py() for c in keys)
            data = [pa.nulls(n, cols[c].type) if c in keys else cols[c] for c in t.column_names if c != "_h"]
            names = [c for c in t.column_names if c != "_h"]
            yield pa.RecordBatch.from_arrays(data + [pa.array(ranks + base), pa.array([False] * n)],
                                             names=names + [out, "_edge"])
        if last is not None:
            edges = list({**firsts, **group}.items())
            names = [c for c in types if c != "_h"]
            data = [pa.array([k[keys.index(c)] for k, _ in edges], types[c]) if c in keys
                    else pa.nulls(len(edges), types[c]) for c in names]
            yield pa.RecordBatch.from_arrays(
                data + [pa.array([base + v for _, v in edges], pa.int64()), pa.array([True] * len(edges))],
                names=names + [out, "_edge"])

    named = written(ranged.mapInArrow(number, schema=T.StructType(schema.fields)), table)
    edge = named.where("_edge").select(*keys, out)
    least = edge.groupBy(*keys).agg(F.min(out).alias("_least"))
    moved = (null_safe(edge, least, keys).where(F.col(out) != F.col("_least"))
             .select(F.col(out).alias("_was"), "_least").distinct())
    # At most two rows a task (more only for equal 64-bit hashes): small enough to send everywhere.
    fixed = (named.where(~F.col("_edge"))
             .join(F.broadcast(moved), F.col(out) == F.col("_was"), "left")
             .withColumn(out, F.coalesce("_least", out)))
    return fixed.select(*payload, out)
