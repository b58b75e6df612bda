"""Mixing sources to target weights by balanced (cube) sampling."""
from __future__ import annotations

import random
import zlib
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from strata.functions.stats import global_index
from strata.llm.common import WORD, load, null_safe, row_id, ship, written

GROUP_ROWS = 2_000
SEED = 17
#: Units kept for the landing of a source, each at least the largest unit / SPARE_PART long.
SPARE, SPARE_PART = 64, 50
_EPS = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """``source``, ``n_docs``, ``source_size``, ``target``: sources by code point, nulls last, weigh ``weights`` in turn.

    Targets share the sum of all sizes by weight; a target above ``most`` times its source's size stops there
    and the excess goes to the others by weight, until none is above.  The table has one row per source; each
    round is one aggregate of it.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    ranked = global_index(per.withColumn("_null", F.col("source").isNull()), ["_null", "source"], index_col="_rank")
    at = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    per = written(ranked.select("source", "source_size", "n_docs", at.alias("weight"),
                                (F.col("source_size") * F.lit(most)).alias("cap")), "sources")
    total = float(per.agg(F.sum("source_size")).first()[0] or 0)
    level, n_capped = 0.0, -1
    while True:
        capped = F.col("cap") <= F.col("weight") * level if n_capped >= 0 else F.lit(False)
        row = per.agg(F.sum(F.when(capped, F.col("cap")).otherwise(0.0)).alias("fixed"),
                      F.sum(F.when(~capped, F.col("weight")).otherwise(0.0)).alias("free"),
                      F.count_if(capped).alias("n")).first()
        if not row["free"] or row["n"] == n_capped:
            break
        n_capped, level = row["n"], (total - row["fixed"]) / row["free"]
    return per.withColumn("target", F.least("cap", F.col("weight") * level)).drop("cap")


class Flight:
    """Flight phase for the two balances sum(p) and sum(p * size): three undecided units leave one decided.

    The moves lie in the null-space of the rows (1, 1, 1) and (s1, s2, s3), so both totals stay as they are.
    """

    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.held: list[list] = []  # [p, size, row]

    def add(self, p: float, size: float, row):
        """Take a unit; yields (row, 0 or 1) for units that got decided."""
        if p <= _EPS or p >= 1 - _EPS:
            yield row, int(p >= 0.5)
            return
        self.held.append([p, size, row])
        while len(self.held) > 2:
            yield from self._move()

    def _move(self):
        (p1, s1, _), (p2, s2, _), (p3, s3, _) = self.held
        u = (s3 - s2, s1 - s3, s2 - s1)
        if u == (0, 0, 0):
            u = (1.0, -1.0, 0.0)
        up = min(((1 - p) / x if x > 0 else -p / x) for p, x in zip((p1, p2, p3), u) if x)
        down = min((p / x if x > 0 else (p - 1) / x) for p, x in zip((p1, p2, p3), u) if x)
        step = up if self.rng.random() * (up + down) < down else -down
        rest = []
        for unit, x in zip(self.held, u):
            unit[0] += step * x
            if unit[0] <= _EPS or unit[0] >= 1 - _EPS:
                yield unit[2], int(unit[0] >= 0.5)
            else:
                rest.append(unit)
        self.held = rest

    def land(self, spare: list):
        """The landing problem: the held and the ``spare`` units, longest first, are drawn one after the other with their
        probabilities scaled to the words that are still due, so what a long unit misses the shorter ones make good."""
        units, self.held = sorted([*self.held, *spare], key=lambda u: -u[1]), []
        rest = due = sum(p * size for p, size, _ in units)
        for p, size, row in units:
            got = int(self.rng.random() < (p * due / rest if rest > _EPS else p))
            due, rest = max(0.0, due - got * size), rest - p * size
            yield row, got


def _seed(seed: int, source: str | None, group: int) -> int:
    return zlib.crc32(f"{seed}/{group}/{source is None}/{source}".encode("utf-8", "surrogatepass"))


def _fly(df: DataFrame, seed: int, last: bool) -> DataFrame:
    """Flights by (source, group), streaming, large units first: what lands undecided at the end is small.

    Decided rows have their copies raised and a null ``_p``; undecided ones (``SPARE`` + 2 a flight at most, none
    if ``last``) keep the ``_p`` that they got to.
    """
    ordered = (df.repartition("source", "_g")
               .sortWithinPartitions("source", "_g", F.desc("size"), F.xxhash64("doc_id", F.lit(seed)), "doc_id", "_row"))
    names, schema = df.columns, to_arrow_schema(df.schema)
    source_at, g_at, p_at, n_at, size_at = (names.index(c) for c in ("source", "_g", "_p", "copies", "size"))

    def run(batches):
        key, flight, out, spare, least = None, None, [], deque(), 0.0

        def decided(pairs):
            for row, got in pairs:
                row[p_at] = None
                row[n_at] += got
                out.append(row)

        def finish():
            if flight and last:
                decided(flight.land(list(spare)))
            elif flight:
                for p, _, row in [*flight.held, *spare]:
                    row[p_at] = p
                    out.append(row)
            spare.clear()

        def batch_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

        for batch in batches:
            for row in map(list, zip(*(batch.column(c).to_pylist() for c in names))):
                if flight is None or (row[source_at], row[g_at]) != key:
                    finish()
                    key = (row[source_at], row[g_at])
                    flight, least = Flight(_seed(seed, *key)), row[size_at] / SPARE_PART
                unit = (row[p_at], float(row[size_at]), row)
                if _EPS < unit[0] < 1 - _EPS and unit[1] > max(0.0, least):
                    spare.append(unit)
                    if len(spare) <= SPARE:
                        continue
                    unit = spare.popleft()
                decided(flight.add(*unit))
            yield batch_of(out)
            out.clear()
        finish()
        yield batch_of(out)

    return ordered.mapInArrow(run, df.schema)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        row_col: str | None = None, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, seed: int = SEED,
        group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per document: ``_row``, ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    A document of a source is due target / source_size times: the whole part is given, the fraction is its
    inclusion probability.  The cube method turns probabilities into choices that keep both the number of
    documents and the number of words of the source: flights run over hash groups of about ``group_rows``
    documents of a source and leave a few undecided each, which fly again in fewer groups until one group per
    source is left, where the last ones land.  Any source may hold most
    rows, as its groups are separate tasks.

    Results depend on ids, sizes and sources alone, so reruns agree.  Null texts have size 0; documents of
    size 0 take part and take 0 words; null is a source, last in order; repeated rows are units of their own;
    an empty table gives an empty result; extra columns are not read.
    """
    if group_rows < 4 * (SPARE + 2):
        raise ValueError("group_rows must be several times the units that a flight leaves")
    ship(docs.sparkSession)
    base = written(docs.select(
        (F.col(row_col) if row_col else row_id()).alias("_row"), F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("size")), "sizes")
    sources = written(source_targets(base, weights, most), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    groups = F.ceil(F.col("n_docs") / F.lit(group_rows))
    units = (null_safe(base, sources.select("source", rate.alias("_rate"), groups.alias("_groups")), ["source"])
             .withColumn("copies", F.floor("_rate").cast("int"))
             .withColumn("_p", F.col("_rate") - F.floor("_rate")).drop("_rate")
             .withColumn("_g", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col("_groups"))))
    most_groups = sources.agg(F.max(groups)).first()[0] or 1
    done = []
    while True:
        last = most_groups <= 1
        flown = written(_fly(units, seed + len(done), last), "flight")
        done.append(flown.where("_p IS NULL"))
        if last:
            break
        seed_next = F.xxhash64("doc_id", F.lit(seed + len(done)))
        units = (flown.where("_p IS NOT NULL")
                 .withColumn("_groups", F.ceil(F.col("_groups") * (SPARE + 2) / F.lit(group_rows)))
                 .withColumn("_g", F.pmod(seed_next, F.col("_groups"))))
        most_groups = -(-most_groups * (SPARE + 2) // group_rows)
    got = done[0]
    for d in done[1:]:
        got = got.unionByName(d)
    return null_safe(got.select("_row", "doc_id", "source", "size", "copies"),
                     sources.select("source", "source_size", "target"), ["source"]).withColumn(
        "taken", F.col("size") * F.col("copies"))


def op6_mix(spark, sf_dir):
    return mix(load(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op6_mix": (op6_mix, None)}
