"""Divergence of sources within a language: hash-consed segment trees of term counts, priced by node pairs."""
from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.stats import global_index
from strata.llm.common import load, ship, written

#: Documents of a language that a kept term occurs in, ranks of the part ``term``, and the scale of the rates.
LEAST_DOCS, MOST_TERMS, SCALE = 3, 200, 1_000_000_000
#: Term ids of one subtree, groups of one tile, and counted terms that a task holds before it gives them out.
BLOCK, TILE, HELD = 4096, 32, 300_000
#: Text is split up to so many bytes at a time.
CHUNK = 1 << 20
#: A term is a run of bytes of letters A-Z, a-z and of all characters beyond ASCII; A-Z are lower-cased.
_TERM_BYTES = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def split_words(raw: bytes):
    """Lists of the runs between spaces, for stretches of about ``CHUNK`` bytes."""
    at = 0
    while len(raw) - at > CHUNK:
        end = raw.find(b" ", at + CHUNK)
        if end < 0:
            break
        yield raw[at:end].split()
        at = end
    yield raw[at:].split()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` occurrences, ``df`` documents; each group also has a row of a null term.

    Tasks count before they give rows out, and Spark sums by (lang, source, term), so a hot source or term arrives
    as a few partial counts; rows are dealt by (lang, term), which also serves sums by that key.  Nulls count as ''.
    """
    ship(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(x)
                         for c, x in ((lang_col, "lang"), (source_col, "source"), (text_col, "_t"))])

    def run(batches):
        held: dict[tuple, tuple[Counter, Counter]] = {}
        seen: set[tuple] = set()
        size = 0

        def out():
            for (lang, source), (n, df) in held.items():
                k = len(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * k, pa.string()), pa.array([source] * k, pa.string()),
                     pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()),
                     pa.array([df[t] for t in n], pa.int64())], names=["lang", "source", "term", "n", "df"])
            held.clear()

        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            texts = batch.column("_t")
            for i, group in enumerate(zip(langs, sources)):
                seen.add(group)
                n, df = held.setdefault(group, (Counter(), Counter()))
                before, terms = len(n), set()
                for words in split_words(texts[i].as_py().encode().translate(_TERM_BYTES)):
                    n.update(words)
                    terms.update(words)
                df.update(terms)
                size += len(n) - before
                if size >= HELD:
                    yield from out()
                    size = 0
        yield from out()
        if seen:
            langs, sources = zip(*seen)
            k = len(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.nulls(k, pa.string()),
                 pa.array([0] * k, pa.int64()), pa.array([0] * k, pa.int64())],
                names=["lang", "source", "term", "n", "df"])

    return (rows.mapInArrow(run, "lang string, source string, term string, n bigint, df bigint")
            .repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")))


# ---------------------------------------------------------------- trees

def rate(counts: np.ndarray, total, n_terms: int, scale: int = SCALE) -> np.ndarray:
    """1 + floor(scale * (count + 1) / (total + n_terms)), exact: whole numbers of any size where 64 bits are too few.
    ``total`` is a number or one per count."""
    if counts.max(initial=0) < (1 << 62) // scale:
        return 1 + scale * (counts + 1) // (total + n_terms)
    totals = np.broadcast_to(total, counts.shape)
    return np.array([1 + scale * (int(c) + 1) // (int(t) + n_terms) for c, t in zip(counts, totals)], np.int64)


class Forest:
    """Segment trees over the columns of ``counts``, one tree a row, all hash-consed together.

    A node is named by what it holds: a leaf by its count, an inner node by the names of its two children.  So
    equal stretches of counts, in one tree or in several, are one node.  -1 marks columns without a term.
    """

    def __init__(self, counts: np.ndarray):
        rows, width = counts.shape
        full = 1 << max(0, (width - 1).bit_length())
        padded = np.full((rows, full), -1, np.int64)
        padded[:, :width] = counts
        self.width = width
        self.leaves, names = np.unique(padded, return_inverse=True)
        names, k = names.reshape(rows, full), len(self.leaves)
        #: Of each level, from the leaves up: left and right child of every node.
        self.children: list[tuple[np.ndarray, np.ndarray]] = []
        while names.shape[1] > 1:
            nodes, up = np.unique(names[:, 0::2] * k + names[:, 1::2], return_inverse=True)
            self.children.append((nodes // k, nodes % k))
            names, k = up.reshape(rows, names.shape[1] // 2), len(nodes)
        self.roots = names[:, 0]


class Traversal:
    """Simultaneous walk down two trees for many pairs of trees at once; equal node pairs are visited once.

    ``setting`` says which totals a pair is priced under: node pairs are equal if both nodes and the setting are.
    On the way down the pairs of each level are made distinct; leaves are priced once for each distinct pair, and
    on the way up a pair's value is put together from those of its children's pairs.
    """

    def __init__(self, forest: Forest, setting: np.ndarray, left: np.ndarray, right: np.ndarray):
        self.forest, self.links = forest, []
        s, x, y, self.top = self._distinct(setting, forest.roots[left], forest.roots[right])
        for lo, hi in reversed(forest.children):
            s, x, y, link = self._distinct(np.tile(s, 2), np.concatenate([lo[x], hi[x]]), np.concatenate([lo[y], hi[y]]))
            self.links.append(link.reshape(2, -1))
        self.setting, self.x, self.y = s, forest.leaves[x], forest.leaves[y]

    @staticmethod
    def _distinct(s, x, y):
        k = int(max(x.max(initial=0), y.max(initial=0))) + 1
        keys, link = np.unique((s * k + x) * k + y, return_inverse=True)
        return keys // (k * k), keys // k % k, keys % k, link

    def sums(self, prices: np.ndarray) -> np.ndarray:
        """Sum of the leaf pairs' ``prices`` for each pair of trees."""
        for link in reversed(self.links):
            prices = prices[link[0]] + prices[link[1]]
        return prices[self.top]

    def best(self, prices: np.ndarray, most: int):
        """(pair of trees, column, price) of the ``most`` highest prices of each pair and all that equal the last;
        negative prices take no part.  Only node pairs whose best leaf can be among them are walked down."""
        levels = [prices]
        for link in reversed(self.links):
            levels.append(np.maximum(levels[-1][link[0]], levels[-1][link[1]]))
        owner, node = np.arange(len(self.top)), self.top
        at = np.zeros(len(owner), np.int64)
        for depth in range(len(levels) - 1, -1, -1):
            value = levels[depth][node]
            order = np.lexsort((-value, owner))
            ordered = owner[order]
            last = np.arange(len(order)) - np.searchsorted(ordered, ordered) == most - 1
            least = np.zeros(len(self.top), np.int64)
            least[ordered[last]] = value[order][last]
            stay = value >= np.maximum(least, 0)[owner]
            owner, node, at, value = owner[stay], node[stay], at[stay], value[stay]
            if depth:
                link = self.links[len(levels) - 1 - depth]
                owner, at = np.tile(owner, 2), np.concatenate([2 * at, 2 * at + 1])
                node = np.concatenate([link[0][node], link[1][node]])
        return owner, at, value


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def block_values(counts: np.ndarray, totals: np.ndarray, first: list[int], second: list[int], n_terms: int,
                 lang_row: int | None, most: int = MOST_TERMS):
    """Values of one block of terms: ((a, b, value of a against b), ...) and ((a, column, value), ...).

    ``counts`` has a row for each tree; pairs are those of ``first`` x ``second`` (each unordered pair once where
    both are the same), and ``lang_row`` is the language's own tree, against which the rows of ``first`` are listed.
    """
    forest = Forest(counts)
    same = first is second
    a, b = np.array([(x, y) for i, x in enumerate(first) for y in (second[i + 1:] if same else second)],
                    np.int64).reshape(-1, 2).T
    terms = (np.zeros(0, np.int64),) * 3
    pairs = (np.zeros(0, np.int64),) * 4
    if len(a):
        both, setting = np.unique(np.stack([totals[a], totals[b]]), axis=1, return_inverse=True)
        walk = Traversal(forest, setting.reshape(-1), a, b)
        real = walk.x >= 0
        p, q = rate(np.maximum(walk.x, 0), both[0][walk.setting], n_terms), rate(np.maximum(walk.y, 0), both[1][walk.setting], n_terms)
        pairs = (a, b, walk.sums(np.where(real, price(p, q), 0)), walk.sums(np.where(real, price(q, p), 0)))
    if lang_row is not None:
        a = np.array(first, np.int64)
        both, setting = np.unique(totals[a], return_inverse=True)
        walk = Traversal(forest, setting.reshape(-1), a, np.full(len(a), lang_row))
        p = rate(np.maximum(walk.x, 0), both[walk.setting], n_terms)
        q = rate(np.maximum(walk.y, 0), int(totals[lang_row]), n_terms)
        owner, at, value = walk.best(np.where((walk.x > 0) & (p > q), price(p, q), -1), most)
        terms = (a[owner], at, value)
    return pairs, terms


# ---------------------------------------------------------------- operator

def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      least_docs: int = LEAST_DOCS, most: int = MOST_TERMS, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: how the sources of a language differ in their terms.

    Part ``pair`` prices a source against each other one of the language, part ``term`` lists the terms that a
    source has more often than its language.  Terms of a language get ids by falling count.  The count tree of a
    group is cut into subtrees of ``block`` ids; one task takes a subtree of up to two tiles of groups, builds them
    hash-consed, so that equal stretches of counts (rare terms above all) are one node, and walks pairs of trees
    down together, pricing equal node pairs once.  Sums over blocks give the pairs; the best terms are found by
    walking down only where the best leaf can reach the list.

    A task holds 2 * ``tile`` + 1 rows of ``block`` counts whatever the size of the corpus.  All arithmetic is in
    whole numbers.  Null text, language and source count as ''; a group without terms has counts of 0; languages
    without kept terms have pairs of value 0 and no terms; repeated rows count each; an empty table gives an empty
    result; extra columns are not read.
    """
    spark = docs.sparkSession
    counts = written(term_counts(docs, text_col, lang_col, source_col), "term-counts")
    kept = (counts.where("term IS NOT NULL").groupBy("lang", "term")
            .agg(F.sum("n").alias("total"), F.sum("df").alias("df")).where(F.col("df") >= least_docs))
    ranked = global_index(kept.select("lang", "term", "total", (-F.col("total")).alias("_less")),
                          ["lang", "_less", "term"], index_col="_at")
    ranked = written(ranked.select("lang", "term", "total", "_at"), "ranked-terms")
    lang_sums = ranked.groupBy("lang").agg(F.min("_at").alias("_base"), F.count(F.lit(1)).alias("_v"),
                                           F.sum("total").alias("_n"))
    terms = written(ranked.join(lang_sums.select("lang", "_base"), "lang").select(
        "lang", "term", "total", (F.col("_at") - F.col("_base")).alias("id")), "terms")
    used = written(counts.where("term IS NOT NULL").select("lang", "source", "term", "n")
                   .join(terms.select("lang", "term", "id"), ["lang", "term"]).select("lang", "source", "id", "n"), "kept-counts")
    by_source = Window.partitionBy("lang").orderBy("source")
    groups = written(counts.where("term IS NULL").select("lang", "source").join(
        used.groupBy("lang", "source").agg(F.sum("n").alias("_n")), ["lang", "source"], "left").select(
        "lang", "source", F.coalesce("_n", F.lit(0)).alias("_n"), (F.row_number().over(by_source) - 1).alias("_g")), "groups")
    # One row a tile of groups, and one a block and pair of tiles, which tells the task what the trees are.
    tiles = groups.groupBy("lang", F.floor(F.col("_g") / tile).cast("int").alias("_tile")).agg(
        F.array_sort(F.collect_list(F.struct("_g", "_n"))).alias("_members"))
    langs = groups.groupBy("lang").agg((F.floor(F.max("_g") / tile) + 1).cast("int").alias("_tiles")).join(
        lang_sums.select("lang", "_v", F.col("_n").alias("_ln")), "lang", "left").fillna(0, ["_v", "_ln"])
    langs = written(langs, "langs")
    blocks = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("_v") / block) - 1, F.lit(0)).cast("int")))
    heads = (langs.select("lang", "_v", "_ln", blocks.alias("_block"))
             .join(tiles.select("lang", F.col("_tile").alias("_ta"), F.col("_members").alias("_first")), "lang")
             .join(tiles.select("lang", F.col("_tile").alias("_tb"), F.col("_members").alias("_second")), "lang")
             .where("_ta <= _tb"))
    nothing = "CAST(NULL AS array<struct<_g: int, _n: bigint>>)"
    place = [F.floor(F.col("id") / block).cast("int").alias("_block"), (F.col("id") % block).cast("int").alias("_pos")]
    # The counts of a block in one row a tree: at most ``block`` of them.
    packed = [F.collect_list("_pos").alias("_at"), F.collect_list("n").alias("_counts")]
    other = F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1))
    mine = (used.select("lang", "source", *place, "n").groupBy("lang", "source", "_block").agg(*packed)
            .join(groups.select("lang", "source", "_g"), ["lang", "source"]).join(langs.select("lang", "_tiles"), "lang")
            .select("lang", "_g", "_block", "_at", "_counts", F.floor(F.col("_g") / tile).cast("int").alias("_t"), other.alias("_o"))
            .select("lang", "_block", F.least("_t", "_o").alias("_ta"), F.greatest("_t", "_o").alias("_tb"), "_g", "_at", "_counts"))
    whole = (terms.select("lang", *place, F.col("total").alias("n")).groupBy("lang", "_block").agg(*packed)
             .join(langs.select("lang", "_tiles"), "lang").select("lang", "_block", "_at", "_counts", other.alias("_ta"))
             .select("lang", "_block", "_ta", F.col("_ta").alias("_tb"), F.lit(-1).alias("_g"), "_at", "_counts"))
    facts = [F.lit(None).cast("bigint").alias(c) for c in ("_v", "_ln")] + [
        F.expr(nothing).alias(c) for c in ("_first", "_second")]
    rows = mine.unionByName(whole).select("*", *facts).unionByName(heads.select(
        "lang", "_block", "_ta", "_tb", F.lit(None).cast("int").alias("_g"), F.lit(None).cast("array<int>").alias("_at"),
        F.lit(None).cast("array<bigint>").alias("_counts"), "_v", "_ln", "_first", "_second"))

    def price_block(key, table):
        lang, at, ta, tb = (k.as_py() for k in key)
        head = table.filter(pc.is_valid(table.column("_v")))
        n_terms, lang_total = head.column("_v")[0].as_py(), head.column("_ln")[0].as_py()
        members = [head.column(c)[0].as_py() for c in ("_first", "_second")[:1 if ta == tb else 2]]
        ids = [m["_g"] for part in members for m in part] + [-1]
        totals = np.array([m["_n"] for part in members for m in part] + [lang_total], np.int64)
        width = min(block, n_terms - at * block)
        counts = np.zeros((len(ids), max(width, 1)), np.int64)
        row = {g: i for i, g in enumerate(ids)}
        data = table.filter(pc.is_valid(table.column("_g")))
        for g, places, some in zip(data.column("_g").to_pylist(), data.column("_at"), data.column("_counts")):
            counts[row[g], places.values.to_numpy()] = some.values.to_numpy()
        if width < 1:
            counts[:] = -1
        first = list(range(len(members[0])))
        second = first if ta == tb else list(range(len(first), len(ids) - 1))
        (a, b, ab, ba), (t, pos, value) = block_values(
            counts, totals, first, second, max(n_terms, 1), len(ids) - 1 if ta == tb else None, most)
        ids = np.array(ids, np.int32)
        k = 2 * len(a) + len(t)
        return pa.table({
            "lang": pa.array([lang] * k, pa.string()),
            "_a": pa.array(np.concatenate([ids[a], ids[b], ids[t]]), pa.int32()),
            "_b": pa.array(np.concatenate([ids[b], ids[a], np.full(len(t), -1, np.int32)]), pa.int32()),
            "id": pa.array(np.concatenate([np.full(2 * len(a), -1), at * block + pos]).astype(np.int64), pa.int64()),
            "value": pa.array(np.concatenate([ab, ba, value]).astype(np.int64), pa.int64())})

    priced = written(rows.groupBy("lang", "_block", "_ta", "_tb").applyInArrow(
        price_block, "lang string, _a int, _b int, id bigint, value bigint"), "priced")
    names = groups.select("lang", "_g", "source")
    pairs = (priced.where("id < 0").groupBy("lang", "_a", "_b").agg(F.sum("value").alias("value"))
             .join(names.withColumnRenamed("_g", "_a"), ["lang", "_a"])
             .join(names.select("lang", F.col("_g").alias("_b"), F.col("source").alias("item")), ["lang", "_b"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    best = (priced.where("id >= 0").join(terms.select("lang", "id", F.col("term").alias("item")), ["lang", "id"])
            .join(names.withColumnRenamed("_g", "_a"), ["lang", "_a"])
            .select("lang", "source", F.lit("term").alias("part"), "item", "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    place_of = lambda df: df.withColumn("rank", F.row_number().over(order))
    return place_of(pairs).unionByName(place_of(best).where(F.col("rank") <= most))


def op11_source_divergence(spark, sf_dir):
    return source_divergence(load(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS t, coalesce(lang, '') AS lang,
                  coalesce(source, '') AS source FROM documents),
     w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(t, '{_UPPER}', '{_LOWER}'),
                  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
     c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS df FROM w GROUP BY ALL),
     k AS (SELECT lang, term, sum(n) AS total FROM c GROUP BY ALL HAVING sum(df) >= {LEAST_DOCS}),
     l AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
     g AS (SELECT DISTINCT lang, source FROM d),
     gn AS (SELECT lang, source, sum(n) AS n FROM c SEMI JOIN k USING (lang, term) GROUP BY ALL),
     p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                  CAST(1 + CAST({SCALE} AS HUGEINT) * (coalesce(c.n, 0) + 1) // (coalesce(gn.n, 0) + l.v) AS HUGEINT) AS p,
                  CAST(1 + CAST({SCALE} AS HUGEINT) * (k.total + 1) // (l.n + l.v) AS HUGEINT) AS pl
           FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c USING (lang, source, term)
           LEFT JOIN gn USING (lang, source)),
     pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
              FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
     x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
           FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
           LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
           UNION ALL
           SELECT lang, source, 'term', term, (p - pl) * (p - pl) // pl FROM p WHERE n > 0 AND p > pl),
     y AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM x)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM y WHERE part = 'pair' OR rank <= {MOST_TERMS}
"""

QUERIES = {"op11_source_divergence": (op11_source_divergence, OP11_SQL)}
