"""Exact Jaccard self-join of n-gram sets, size-aware: subsets of small sets, inverted lists for large ones."""
from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import drop_path, flat, load, marked, row_id, ship, written_path
from strata.llm.components import components
from strata.llm.repeats import pieces
from strata.llm.words import mix, range_hashes, prefix_hashes, words

#: What a place in an inverted list costs beside a subset: it is read, probed and often verified.
LIST_COST = 4
_LARGEST_SMALL = 48
#: Words of 64 bits in a set's sketch.
SKETCH = 8
#: Parts, by key, in which the lists are shuffled one after the other, so that the shuffle files of one part alone are
#: on disk beside the sets.
PARTS = 3
#: Bytes of texts whose sets a task makes at once; a longer text goes alone.
PIECE = 1 << 20
#: Texts that go to Python at once; Spark's 10,000 take tens of MB, on both sides and for each task.
TEXTS = 500
#: A set of more elements than this has a wide sketch besides, of at least two bits an element.
_NARROW = 32 * SKETCH


class Plan:
    """Sizes and keys of a join with similarity >= ``num`` / ``den``.

    Sets whose sizes n <= m can be similar have m <= n * den / num.  Sizes fall into bands such that the partner
    is in the same or the next band.  In band i similar sets differ in at most d elements, so of d + 1 + e
    bundles, to which a hash deals the elements, at least 1 + e agree; as at most e of them are empty in a set
    (others also list their empty bundles), they share a list of a bundle with content.
    """

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.lows, self.bundles, self.spare = [1], [], []

    def _grow(self):
        low = self.lows[-1]
        self.lows.append(low * self.den // self.num + 1)
        n = self.lows[-1] - 1
        m = n * self.den // self.num
        d = (n + m) * (self.den - self.num) // (self.den + self.num)
        e = 0
        while True:
            k = d + 1 + e
            lam, tail, term = k * math.exp(-low / k), 1.0, math.exp(-k * math.exp(-low / k))
            for j in range(e + 1):
                tail -= term
                term *= lam / (j + 1)
            if tail < 1e-4 or e > 60:
                break
            e += 1
        self.bundles.append(k)
        self.spare.append(e)

    def band(self, n: int) -> int:
        while self.lows[-1] <= n:
            self._grow()
        return int(np.searchsorted(self.lows, n, side="right")) - 1

    def most(self, n: int) -> int:
        return n * self.den // self.num

    def least(self, m: int) -> int:
        """Common elements that a set of ``m``, the larger of two, must have with the other."""
        return -(-m * self.num // self.den)

    def subsets(self, n: int) -> int:
        return sum(math.comb(n, self.least(m)) for m in range(n, self.most(n) + 1))

    def lists(self, n: int) -> int:
        i = self.band(n)
        return self.bundles[i] + (self.bundles[i - 1] if i else 0)

    def boundary(self, sizes: dict[int, int]) -> int:
        """The size up to which enumerating costs least in all, by the numbers of sets of each size."""
        best, at, cost = 0.0, 0, 0.0
        for n in range(1, _LARGEST_SMALL + 1):
            cost += max(1, sizes.get(n, 0)) * (self.subsets(n) - LIST_COST * self.lists(n))
            if cost <= best:
                best, at = cost, n
        return at

    def keys(self, s: np.ndarray, small: int) -> np.ndarray:
        """List names of a set (sorted hashes) of more than 0 elements."""
        n, out = len(s), []
        if n <= self.most(small):
            element = mix(s, 77)
            for m in range(n, self.most(n) + 1) if n <= small else (n,):
                size = self.least(m)
                if size > n:
                    continue
                drops = list(itertools.combinations(range(n), n - size))
                total = element.sum(dtype=np.uint64)
                gone = element[np.array(drops, np.int64).reshape(len(drops), n - size)].sum(axis=1, dtype=np.uint64)
                out.append(mix(total - gone, 1_000_003 * m + 1))
        if n > small:
            i = self.band(n)
            for level in (i, i - 1) if i else (i,):
                k = self.bundles[level]
                to = (mix(s, 1000 + level) % np.uint64(k)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                dealt = to[order]
                begin = np.flatnonzero(np.r_[True, dealt[1:] != dealt[:-1]])
                sums = np.add.reduceat(mix(s[order], 78), begin)
                names, filled = dealt[begin], len(begin)
                out.append(mix(sums + mix(names.astype(np.uint64), 31 * level + 5), 2 * level + 2))
                if k - filled > self.spare[level]:
                    bare = np.setdiff1d(np.arange(k), names).astype(np.uint64)
                    out.append(mix(mix(bare, 31 * level + 5), 2 * level + 2))
        return np.unique(np.concatenate(out))


def _sets(batch_column, n_words: int):
    """Sorted distinct shingle hashes of each text."""
    data, at = flat(batch_column)
    hashes, _, _, first = words(data, at, lower=True)
    prefix = prefix_hashes(hashes)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= n_words:
            begin = np.arange(a, b - n_words + 1)
            yield np.unique(range_hashes(prefix, begin, begin + n_words))
        else:
            yield range_hashes(prefix, np.array([a]), np.array([b])) if b > a else np.zeros(0, np.uint64)


def set_pieces(batches, n_words: int):
    """Batches cut to ``PIECE`` bytes of texts, each with the sets of its texts: hashes, places and prefix sums of a
    whole batch's words would take many times its room."""
    for batch in pieces(batches, PIECE):
        yield batch, list(_sets(batch.column("_t"), n_words))


def sketch(s: np.ndarray, size: int = SKETCH) -> list[int]:
    """One bit for each of ``size`` * 64 hash values: how often, odd or even, an element of the set has it.  Two sets
    differ in at least as many elements as bits."""
    at = mix(s, 55) % np.uint64(64 * size)
    odd = np.bincount(at.astype(np.int64), minlength=64 * size).astype(np.uint64) & np.uint64(1)
    words = (odd.reshape(size, 64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return words.view(np.int64).tolist()


def wide_sketch(s: np.ndarray) -> list[int]:
    """A sketch whose words are the power of two times ``SKETCH`` that gives two bits an element; none for a set that
    the narrow one serves.  Halves of a sketch, one xor the other, are the sketch of half as many words."""
    size = SKETCH
    while 32 * size < len(s):
        size *= 2
    return sketch(s, size) if len(s) > _NARROW else []


def _apart(a: str, b: str) -> F.Column:
    """Bits in which two wide sketches differ, the longer one folded to the words of the shorter one; 0 if one is empty."""
    least = F.least(F.size(a), F.size(b))

    def folded(c):
        part = lambda i: F.slice(c, i * least + 1, least)
        # sequence(1, 0) counts down, so a sketch that needs no folding must not come there.
        more = F.aggregate(F.sequence(F.lit(1), F.floor(F.size(c) / least).cast("int") - 1), part(F.lit(0)),
                           lambda acc, i: F.zip_with(acc, part(i), lambda x, y: x.bitwiseXOR(y)))
        return F.when(F.size(c) == least, F.col(c)).otherwise(more)

    differ = F.zip_with(folded(a), folded(b), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.when(least > 0, F.aggregate(differ, F.lit(0), lambda acc, x: acc + x)).otherwise(0)


def _identity(s: np.ndarray) -> tuple[int, int]:
    return (int(mix(s, 901).sum(dtype=np.uint64).astype(np.int64)), int(mix(s, 902).sum(dtype=np.uint64).astype(np.int64)))


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None,
                 n_words: int = 5, percent: int = 80, links: bool = False) -> DataFrame | tuple[DataFrame, DataFrame]:
    """One row per document: ``_row``, ``doc_id``, ``n_shingles``, ``class_row``, ``root_row``, ``component_id``.

    A document's set holds its distinct shingles of ``n_words`` words (ASCII letters lower-cased; fewer words are
    one shingle), by 64-bit hashes.  Documents with 100 * common >= ``percent`` * united elements are linked;
    ``component_id`` is the smallest id reachable by links.  Equal sets form a class, of which one member takes
    part in the join (``class_row``), so copies are never paired.

    Small sets name all their subsets of the size that a partner must share; large sets name bundles of
    elements, and the sets of each inverted list meet; the boundary is the size at which the total cost by
    measured numbers of sets is least.  Sets meet only if their parity sketches don't prove them too different.
    In a list, a few pivots (those with the longest lists, so the centres of crowds) meet the others, links are
    merged into components, and rounds with more pivots go on only while a list holds untested members of
    different components: so a crowd of near copies is linked by about as many pairs as it has members, and no
    link between components is lost.  Candidates are verified on whole sets, of more than 256 elements only if their
    wide sketches, which grow with the sets, don't prove them too different.

    With ``links``, documents also get ``n_links``, the number of other documents that they are linked with, and a
    second table (``a``, ``b``; a < b) holds every link between classes: all pairs that share a list and pass the
    sketch are verified then, so the work grows with the pairs of a crowd.

    Null and empty texts have no shingles and are linked with nothing; repeated rows are copies; an empty table
    gives an empty result; extra columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = dict(docs.dtypes)[id_col]
    plan = Plan(percent, 100)
    scratch = {}  # tables that the result doesn't read; they go before it is returned

    def written(df: DataFrame, name: str, kept: bool = False, rows: int | None = None) -> DataFrame:
        table, path = written_path(df, name, rows)
        if not kept:
            scratch[path] = name
        return table

    def dropped(*names: str) -> None:
        for path in [p for p, n in scratch.items() if not names or n in names]:
            drop_path(spark, path)
            del scratch[path]

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    source = docs.select((F.col(row_col) if row_col else row_id()).alias("_row"), F.col(id_col).alias("doc_id"),
                         text.alias("_t"))
    # Sizes of small sets: number of words less n_words, plus one, is enough for a cost.
    n_of = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) - (n_words - 1)
    few = docs.where(F.length(text_col) < 20 * _LARGEST_SMALL).select(n_of.alias("n")).where(
        F.col("n").between(1, _LARGEST_SMALL)).groupBy("n").count().collect()  # at most 48 rows
    small = plan.boundary({r["n"]: r["count"] for r in few})

    def name(batches):
        for batch, rows in set_pieces(batches, n_words):
            n, h1, h2, keys, sketches = [], [], [], [], []
            for s in rows:
                a, b = _identity(s)
                n.append(len(s))
                h1.append(a)
                h2.append(b)
                sketches.append(sketch(s))
                keys.append(plan.keys(s, small).view(np.int64) if len(s) else np.zeros(0, np.int64))
            at = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            flat_keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(h1, pa.int64()),
                 pa.array(h2, pa.int64()), pa.array(sketches, pa.list_(pa.int64())),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(flat_keys))],
                names=["_row", "doc_id", "n", "h1", "h2", "sk", "keys"])

    named = written(
        source.mapInArrow(name, f"_row bigint, doc_id {kind}, n bigint, h1 bigint, h2 bigint, sk array<bigint>, "
                          "keys array<bigint>"), "sets", rows=TEXTS)
    facts = written(named.select("_row", "doc_id", "n", "h1", "h2"), "facts", kept=True)
    classes = written(named.where("n > 0").groupBy("n", "h1", "h2").agg(
        F.min("_row").alias("class_row"), F.min_by("doc_id", "_row").alias("class_doc"),
        F.min("doc_id").alias("least_id"), F.first("n").alias("size"), F.min_by("sk", "_row").alias("sk"),
        F.count(F.lit(1)).alias("copies")), "classes", kept=True)
    # Copies, all but one of a class, take no part; most documents are surely none and need no join to know it.
    copies = written(facts.where("n > 0").join(classes.where("copies > 1").select("n", "h1", "h2", "class_row"), ["n", "h1", "h2"])
                     .where("_row <> class_row").select("_row", "doc_id"), "copies")
    told = marked(named.select("_row", "keys"), [F.col("_row")], copies, [F.col("_row")])
    heads = told.where(~F.col("_maybe")).unionByName(told.where("_maybe").join(copies.select("_row"), "_row", "left_anti")
                                                     .select(*told.columns))

    def lists(batches):
        """Entries of lists with two members or more, with their place in the list; input sorted by (key, row)."""
        key, place, held = None, 0, None
        for batch in batches:
            k, r = (batch.column(c).to_numpy() for c in ("key", "row"))
            if not len(k):
                continue
            if key is not None and held is not None:
                k, r = np.r_[key, k], np.r_[held, r]
                start = 0
            else:
                start = place if key is not None and k[0] == key else 0
            new = np.r_[start == 0, k[1:] != k[:-1]]
            begin = np.flatnonzero(new)
            size_at = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
            places = np.arange(len(k)) - size_at
            if start:
                first = begin[0] if len(begin) else len(k)
                places[:first] = np.arange(first) + start
            alone = new & np.r_[new[1:], False]
            # The last entry is kept back while it is the only one of its list so far.
            key, held = int(k[-1]), None
            if new[-1]:
                held, alone[-1] = int(r[-1]), True
                place = 0
            else:
                place = int(places[-1]) + 1
            keep = ~alone
            yield pa.RecordBatch.from_arrays([pa.array(k[keep]), pa.array(r[keep]), pa.array(places[keep])],
                                             names=["key", "row", "place"])

    members = None
    for part in range(PARTS):
        keys = F.filter("keys", lambda k: F.pmod(k, F.lit(PARTS)) == part)  # noqa: B023
        entries = (heads.select(F.explode(keys).alias("key"), F.col("_row").alias("row"))
                   .repartition("key").sortWithinPartitions("key", "row"))
        some = written(entries.mapInArrow(lists, "key bigint, row bigint, place bigint").select("key", "row"), "lists")
        members = some if members is None else members.unionByName(some)
    dropped("sets", "copies")
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("row").alias("a"), F.max("row").alias("b"))
    sizes = written(sizes, "list_sizes")
    about = classes.select(F.col("class_row").alias("row"), "size", "sk")
    a, b = (about.select(*[F.col(c).alias(f"{c}_{x}") for c in about.columns]) for x in "ab")
    # Two sets of sizes m and n with enough in common differ in at most this many elements.
    spread = F.floor((F.col("size_a") + F.col("size_b")) * (100 - percent) / (100 + percent))
    differ = sum((F.bit_count(F.col("sk_a")[i].bitwiseXOR(F.col("sk_b")[i])) for i in range(SKETCH)), F.lit(0))
    near = (differ <= spread) & (F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * percent)
    couples = sizes.where("members = 2").groupBy(F.col("a").alias("row_a"), F.col("b").alias("row_b")).agg(
        F.count(F.lit(1)).alias("lists"))
    couples = written(couples.join(a, "row_a").join(b, "row_b").where(near).select(
        F.col("row_a").alias("a"), F.col("row_b").alias("b"), "lists"), "couples")
    # Longer lists, the members with most company first.
    crowds = members.join(sizes.where("members > 2").select("key", "members"), "key")
    company = crowds.groupBy("row").agg(F.sum("members").alias("company"))
    order = Window.partitionBy("key").orderBy(F.desc("company"), "row")
    crowds = written(crowds.join(company, "row").join(about, "row").select(
        "key", "row", "size", "sk", (F.row_number().over(order) - 1).alias("place")), "crowds")

    # Sets of the documents that can be paired, read again from their texts.
    paired = couples.select(F.col("a").alias("row")).unionByName(couples.select(F.col("b").alias("row"))).unionByName(
        crowds.select("row")).distinct()
    wanted = written(paired.join(classes, F.col("row") == F.col("class_row")).select(
        "class_row", "class_doc", "n", "h1", "h2"), "wanted")

    def sets(batches):
        for batch, rows in set_pieces(batches, n_words):
            ids = [_identity(s) for s in rows]
            at = np.concatenate([[0], np.cumsum([len(s) for s in rows])]).astype(np.int32)
            every = np.concatenate(rows).view(np.int64) if rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(s) for s in rows], pa.int64()), pa.array([i[0] for i in ids], pa.int64()),
                 pa.array([i[1] for i in ids], pa.int64()), pa.array([wide_sketch(s) for s in rows], pa.list_(pa.int64())),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(every))], names=["n", "h1", "h2", "wide", "s"])

    # Sets are shuffled once, by their class, and texts never: the bitmap lets few others through, which meet no class.
    texts = marked(source.select("doc_id", "_t"), [F.col("doc_id")], wanted, [F.col("class_doc")]).where("_maybe").select("_t")
    found = texts.mapInArrow(sets, "n bigint, h1 bigint, h2 bigint, wide array<bigint>, s array<bigint>")
    content = written(found.join(wanted, ["n", "h1", "h2"]).dropDuplicates(["n", "h1", "h2"]).select(
        "class_row", F.col("n").alias("size"), "wide", "s"), "contents", rows=TEXTS)

    def rooted(df: DataFrame, row: str, root: str) -> DataFrame:
        if roots is None:
            return df.withColumn(root, F.col(row))
        of = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        return df.join(of, F.col(row) == F.col("_node"), "left").withColumn(root, F.coalesce("_root", row)).drop("_node", "_root")

    def verified(pairs: DataFrame, kept: bool = False) -> DataFrame:
        # Wide sketches, a sixteenth of the sets or less, leave few pairs that aren't similar; whole sets then decide.
        ids = pairs.select(F.col("a").alias("class_row")).unionByName(pairs.select(F.col("b").alias("class_row"))).distinct()
        some = marked(content.select("class_row", "size", "wide"), [F.col("class_row")], ids, [F.col("class_row")]).where("_maybe")
        x, y = (some.select(*[F.col(c).alias(f"{c}_{e}") for c in ("class_row", "size", "wide")]) for e in "ab")
        sketched = pairs.select("a", "b").join(x, F.col("a") == F.col("class_row_a")).join(y, F.col("b") == F.col("class_row_b"))
        close = written(sketched.where(_apart("wide_a", "wide_b") <= spread).select("a", "b"), "close")
        ends = close.select(F.col("a").alias("class_row")).unionByName(close.select(F.col("b").alias("class_row"))).distinct()
        whole = marked(content.select("class_row", "s"), [F.col("class_row")], ends, [F.col("class_row")]).where("_maybe")
        one = close.join(whole.select(F.col("class_row").alias("a"), F.col("s").alias("sa")), "a")
        two = one.join(whole.select(F.col("class_row").alias("b"), F.col("s").alias("sb")), "b")
        common = F.size(F.array_intersect("sa", "sb"))
        good = two.where(common * 100 >= (F.size("sa") + F.size("sb") - common) * percent).select("a", "b")
        return written(good, "edges", kept=kept)

    def linked(out: DataFrame) -> DataFrame | tuple[DataFrame, DataFrame]:
        if not links:
            dropped()
            return out
        one, two = (crowds.select("key", *[F.col(c).alias(f"{c}_{x}") for c in ("row", "size", "sk")]) for x in "ab")
        every = one.join(two, "key").where((F.col("row_a") < F.col("row_b")) & near).select(
            F.col("row_a").alias("a"), F.col("row_b").alias("b"))
        pairs = verified(written(every.unionByName(couples.select("a", "b")).distinct(), "pairs"), kept=True)
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        others = both.join(classes.select(F.col("class_row").alias("b"), "copies"), "b").groupBy("a").agg(
            F.sum("copies").alias("others"))
        counts = classes.join(others, F.col("class_row") == F.col("a"), "left").select(
            F.col("class_row").alias("_c"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
        dropped()
        return out.join(counts, F.col("class_row") == F.col("_c"), "left").drop("_c").withColumn(
            "n_links", F.coalesce("n_links", F.lit(0))), pairs

    edges = roots = tested = None
    done, pivots, left = 0, 1, 0
    while left is not None and left >= done:
        live = rooted(crowds.where(F.col("place") >= done), "row", "root")
        ends = live.groupBy("key").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi"),
                                       F.max("place").alias("_last")).where("_lo < _hi")
        side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("row", "size", "sk", "place", "root")]
        open_ = live.join(ends.select("key"), "key", "left_semi")
        lead = open_.where(F.col("place") < done + pivots).select(F.col("key").alias("_key"), *side("a"))
        met = lead.join(open_.select("key", *side("b")), (F.col("_key") == F.col("key")) & (F.col("place_b") > F.col("place_a"))
                        & (F.col("root_a") != F.col("root_b")) & near)
        pairs = met.groupBy(F.least("row_a", "row_b").alias("a"), F.greatest("row_a", "row_b").alias("b")).agg(
            F.count(F.lit(1)).alias("lists"))
        if not done:
            apart = rooted(rooted(couples, "a", "_ra"), "b", "_rb").where("_ra <> _rb").select("a", "b", "lists")
            pairs = pairs.unionByName(apart).groupBy("a", "b").agg(F.sum("lists").alias("lists"))
        if tested is None:
            # At first each set meets only the one with which it shares most lists; that links nearly all.
            both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "lists"))
            best = both.groupBy("a").agg(F.max_by("b", F.struct("lists", -F.col("b"))).alias("b"))
            pairs = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        else:
            pairs = pairs.select("a", "b").join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        if not pairs.isEmpty():
            good = verified(pairs)
            edges = good if edges is None else edges.unionByName(good)
            if not good.isEmpty():
                roots = written(components(edges), "roots")
        if tested is None:
            tested = pairs
            continue
        tested = tested.unionByName(pairs)
        left = ends.agg(F.max("_last")).first()[0]
        done, pivots = done + pivots, pivots * 8

    own = facts.join(classes.select("n", "h1", "h2", "class_row", "least_id"), ["n", "h1", "h2"], "left")
    if roots is None:
        return linked(own.select("_row", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_row", "_row").alias("class_row"),
                                 F.coalesce("class_row", "_row").alias("root_row"),
                                 F.coalesce("least_id", "doc_id").alias("component_id")))
    joined = classes.join(roots, F.col("class_row") == F.col("node"))
    least = joined.groupBy("root").agg(F.min("least_id").alias("_least"))
    of_class = joined.join(least, "root").select(F.col("class_row").alias("_c"), "root", "_least")
    return linked(own.join(written(of_class, "class_roots", kept=True), F.col("class_row") == F.col("_c"), "left").select(
        "_row", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_row", "_row").alias("class_row"),
        F.coalesce("root", "class_row", "_row").alias("root_row"),
        F.coalesce("_least", "least_id", "doc_id").alias("component_id")))


def op7_jaccard_join(spark, sf_dir):
    return similar_sets(load(spark, sf_dir, "documents"), n_words=3, percent=90).select(
        "doc_id", "n_shingles", "component_id", "class_row")


QUERIES = {"op7_jaccard_join": (op7_jaccard_join, None)}
