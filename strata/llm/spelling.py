"""Spelling variants: words one edit apart, found through one-edit neighbourhoods over a reduced alphabet."""
from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import load, row_id, ship, written
from strata.llm.divergence import HELD, split_words

LEAST_LENGTH, LEAST_COUNT, TIMES = 5, 3, 2
#: Sizes of the reduced alphabet to choose from, and neighbours of one batch of rows.
SYMBOLS, BATCH = (4, 8, 16, 32), 1 << 19
#: Cost of checking a candidate against that of making a neighbour; bits of the bitmap for each word, and at most (16 MB).
CANDIDATE, SPARSE, MOST_BITS = 8.0, 64, 27
#: Runs with a check sum that this divides lose one letter.
TYPO = 97
#: Words are runs of A-Z, a-z and U+00C0 to U+00FF, one byte each in Latin-1; A-Z are lower-cased.
_WORD_BYTES = bytes(c if c >= 0xC0 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo: int = TYPO,
                least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word``, ``n``: lower-cased runs of letters of whole texts, after the planted typing errors.

    A run whose CRC-32 of ``<doc_id>:<run>`` is a multiple of ``typo`` loses the letter at that value modulo its
    length.  Tasks count before they give rows out; Spark sums by word.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_d"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_t"))

    def run(batches):
        held: Counter = Counter()

        def out():
            yield pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()),
                                              pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()

        for batch in batches:
            texts = batch.column("_t")
            for i, doc in enumerate(batch.column("_d").to_pylist()):
                start = zlib.crc32(f"{doc}:".encode())
                for words in split_words(texts[i].as_py().encode("latin-1", "replace").translate(_WORD_BYTES)):
                    for w, n in Counter(words).items():
                        if len(w) < least_length:
                            continue
                        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
                        if not h % typo:
                            h %= len(w)
                            w = w[:h] + w[h + 1:]
                            if len(w) < least_length:
                                continue
                        held[w] += n
                if len(held) >= HELD:
                    yield from out()
        yield from out()

    return (rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


# ---------------------------------------------------------------- reduced words and their neighbourhoods

# Two polynomial hashes modulo primes below 2**31, whose products fit in 64 bits; verification makes collisions harmless.
_P = np.array([2147483647, 2147483629], np.uint64)
_B = np.array([1103515245, 362437069], np.uint64)


def _powers(length: int, i: int) -> np.ndarray:
    out = np.ones(length + 2, np.uint64)
    for j in range(1, length + 2):
        out[j] = out[j - 1] * _B[i] % _P[i]
    return out


def neighbourhoods(words: np.ndarray, symbols: int):
    """Hashes of reduced words and of all strings one edit from them.

    ``words``: letters of words of one length, one row each; a letter's symbol is its code point modulo
    ``symbols``.  Yields (row numbers, hashes): first the words themselves, then neighbours, each string once:
    a deletion takes the first letter of a run of equal symbols, an insertion never repeats the symbol on its left.
    """
    rows, length = words.shape
    s = (words % symbols + 1).astype(np.uint64)
    power = [_powers(length, i) for i in (0, 1)]
    head = np.zeros((2, rows, length + 1), np.uint64)
    tail = np.zeros((2, rows, length + 1), np.uint64)
    for i in (0, 1):
        for j in range(length):
            head[i, :, j + 1] = (head[i, :, j] * _B[i] + s[:, j]) % _P[i]
            k = length - 1 - j
            tail[i, :, k] = (tail[i, :, k + 1] + s[:, k] * power[i][j]) % _P[i]

    def name(parts):
        return ((parts[0] << np.uint64(31)) | parts[1]).astype(np.int64)

    every = np.arange(rows)
    yield every, name([head[0, :, -1], head[1, :, -1]])
    step = max(1, BATCH // max(1, rows))
    for a in range(0, length + 1, step):
        at = np.arange(a, min(a + step, length + 1))
        inner = at[at < length]
        if len(inner):
            new = np.ones((rows, len(inner)), bool)
            later = inner > 0
            new[:, later] = s[:, inner[later] - 1] != s[:, inner[later]]
            r, c = np.nonzero(new)
            j = inner[c]
            yield r, name([(head[i, r, j] * power[i][length - 1 - j] + tail[i, r, j + 1]) % _P[i] for i in (0, 1)])
        for x in np.arange(1, symbols + 1, dtype=np.uint64):
            if len(inner):
                r, c = np.nonzero(s[:, inner] != x)
                j = inner[c]
                yield r, name([((head[i, r, j] * _B[i] + x) % _P[i] * power[i][length - 1 - j] + tail[i, r, j + 1]) % _P[i]
                               for i in (0, 1)])
            left = np.where(at > 0, s[:, np.maximum(at - 1, 0)], np.uint64(0))
            r, c = np.nonzero(left != x)
            j = at[c]
            yield r, name([((head[i, r, j] * _B[i] + x) % _P[i] * power[i][length - j] + tail[i, r, j]) % _P[i]
                           for i in (0, 1)])


def _by_length(batch: pa.RecordBatch):
    """(places in the batch, letters) of words of one length, some at a time."""
    by_length: dict[int, list[int]] = {}
    words = [w.encode("utf-32-le") for w in batch.column("word").to_pylist()]
    for i, w in enumerate(words):
        by_length.setdefault(len(w) // 4, []).append(i)
    for length, which in by_length.items():
        group = max(1, BATCH // (8 * (length + 1)))
        for a in range(0, len(which), group):
            some = np.array(which[a:a + group])
            letters = np.frombuffer(b"".join(words[i] for i in some), "<u4")
            yield some, letters.reshape(len(some), length).astype(np.int64)


def _reduced(vocabulary: DataFrame, symbols: int) -> DataFrame:
    """``vocabulary`` with ``key``: the hash of each word's reduced form."""
    names = vocabulary.columns

    def run(batches):
        for batch in batches:
            keys = np.zeros(batch.num_rows, np.int64)
            for some, letters in _by_length(batch):
                keys[some] = next(neighbourhoods(letters, symbols))[1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys)], names=[*names, "key"])

    fields = ", ".join(f"{n} {t}" for n, t in vocabulary.dtypes)
    return vocabulary.mapInArrow(run, f"{fields}, key bigint")


def _bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """A bit for each value that keys take modulo 2**``bits``: of one size however many keys there are."""
    part = 1 << 15
    spot = F.pmod(F.col("key"), F.lit(1 << bits))
    rows = (keys.select(spot.alias("_h")).groupBy(F.floor(F.col("_h") / part).alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.col("_h") % part).alias("_bits")))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows.toLocalIterator():
        some = np.frombuffer(r["_bits"], np.uint8)
        out[r["_bucket"] * (part // 8):][:len(some)] = some[:len(out)]
    return out


def _neighbours(words: DataFrame, symbols: int, bits: int) -> DataFrame:
    """``_w``, ``key``: the reduced forms that are one edit from a word's (or equal) and may be in the vocabulary.

    Each neighbour is looked up in a bitmap of the vocabulary's keys as it is made, so that few that meet no word
    leave the task; the join that follows is exact.
    """
    spark = words.sparkSession
    present = spark.sparkContext.broadcast(_bitmap(words, bits))

    def run(batches):
        found, mask = present.value, (1 << bits) - 1
        for batch in batches:
            ids = batch.column("_w").to_numpy()
            for some, letters in _by_length(batch):
                for rows, keys in neighbourhoods(letters, symbols):
                    spot = keys & mask
                    ok = (found[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 > 0
                    yield pa.RecordBatch.from_arrays([pa.array(ids[some[rows[ok]]], pa.int64()),
                                                      pa.array(keys[ok], pa.int64())], names=["_w", "key"])

    return words.select("_w", "word").mapInArrow(run, "_w bigint, key bigint")


def choose_symbols(by_length: DataFrame, choices: tuple[int, ...] = SYMBOLS) -> int:
    """The alphabet size with the least expected work: neighbours made, and, ``CANDIDATE`` times as dear each, words
    that share a reduced form with one.

    ``by_length`` counts words (``n``) by ``length``.  The choice changes the cost, never the result.
    """
    n, length = F.col("n").cast("double"), F.col("length").cast("double")
    cost = by_length.agg(*[F.sum(n * length * (2.0 * s) * (1.0 + CANDIDATE * n / F.pow(F.lit(float(s)), length))).alias(f"c{s}")
                           for s in choices]).first()
    return min(choices, key=lambda s: (cost[f"c{s}"] or 0.0, s))


def near_words(vocabulary: DataFrame, symbols: int | None = None) -> DataFrame:
    """``_w``, ``word``, ``n``, ``near``, ``near_n``: all pairs of words of ``vocabulary`` one edit apart, in both directions.

    Neighbourhoods of reduced words meet the reduced vocabulary by equi-join; every candidate is checked on the
    words themselves.
    """
    by_length = written(vocabulary.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")), "lengths")
    symbols = symbols or choose_symbols(by_length)
    size = by_length.agg(F.sum("n")).first()[0] or 0
    bits = min(MOST_BITS, max(16, (SPARSE * size).bit_length()))
    words = written(_reduced(vocabulary, symbols), "reduced")
    keys = written(_neighbours(words, symbols, bits), "neighbours")
    own = words.select("key", F.col("_w").alias("_v"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    met = keys.join(own, "key").where(F.col("_w") != F.col("_v")).select("_w", "near", "near_n")
    return (met.join(words.select("_w", "word", "n"), "_w")
            .where(F.abs(F.length("word") - F.length("near")) <= 1)
            .where(F.levenshtein("word", "near", 1) == 1).select("_w", "word", "n", "near", "near_n"))


def roots(links: DataFrame) -> DataFrame:
    """``word``, ``root`` for links (``word``, ``form``) without circles: each round doubles the distance followed."""
    now = written(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = now.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"),
                                                        F.col("_next").isNotNull().alias("_moved"))
        now = written(moved, "roots")
        if not now.where("_moved").limit(1).count():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo: int = TYPO,
                      least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES,
                      symbols: int | None = None) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``: the usual spelling of each word of the corpus.

    A word's form is its near word (one letter inserted, deleted or replaced) with most occurrences, the first in
    code-point order of several, if it occurs ``times`` as often as the word; ``root`` follows forms to the last.
    Letters are hashed to a few symbols; the full one-edit neighbourhood of each reduced word is joined with the
    reduced vocabulary, and candidates are verified on the words.  ``symbols`` is chosen by cost if None.  The driver
    sees counts and a bitmap of at most 16 MB.

    Texts count whole; null texts hold no words; a null id is '' in the check sum; repeated rows count each; words
    of any length take part (their neighbourhoods are hashes and leave the task in batches); an empty table gives
    an empty result; extra columns are not read.
    """
    vocabulary = written(word_counts(docs, id_col, text_col, typo, least_length, least_count)
                         .withColumn("_w", row_id()), "vocabulary")
    near = near_words(vocabulary, symbols)
    best = written(near.groupBy("_w").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("a"), F.col("near").alias("b"))).alias("_best")), "near")
    enough = -F.col("_best.a") >= F.col("n") * times
    found = written(vocabulary.join(best, "_w", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("_best.b")).alias("form"), F.when(enough, -F.col("_best.a")).alias("form_n")), "forms")
    ends = roots(found.where("form IS NOT NULL").select("word", "form"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(spark, sf_dir):
    return spelling_variants(load(spark, sf_dir, "documents"))


QUERIES = {"op13_spelling": (op13_spelling, None)}
