"""Source divergence, packing and spelling variants against plain versions."""
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
from brute import spelling
from llm_cases import none, odd, odd_rows  # noqa: F401

from strata.llm import divergence, packing
from strata.llm.spelling import neighbourhoods, near_words, roots, spelling_variants, word_counts

DOCS = [(r[0], r[1]) for r in odd_rows()]


# ---------------------------------------------------------------- divergence

def diverging(rows, least=3, most=200, scale=10 ** 9):
    """rows of (text, lang, source) -> set of result rows, term by term."""
    counts, df, groups = Counter(), Counter(), set()
    for t, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
                 for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
        counts.update((lang, source, w) for w in terms)
        df.update((lang, w) for w in set(terms))
    kept = defaultdict(list)
    for (lang, w), n in df.items():
        if n >= least:
            kept[lang].append(w)
    p = {}
    for lang, source in groups:
        n = sum(counts[lang, source, w] for w in kept[lang])
        for w in kept[lang]:
            p[lang, source, w] = 1 + scale * (counts[lang, source, w] + 1) // (n + len(kept[lang]))
    for lang in kept:
        mine = [s for a, s in groups if a == lang]
        total = {w: sum(counts[lang, s, w] for s in mine) for w in kept[lang]}
        for w in kept[lang]:
            p[lang, None, w] = 1 + scale * (total[w] + 1) // (sum(total.values()) + len(kept[lang]))
    f = lambda a, b: (a - b) * (a - b) // b
    out = set()
    for lang, s in groups:
        pairs = [(o, sum(f(p[lang, s, w], p[lang, o, w]) for w in kept[lang]))
                 for a, o in groups if a == lang and o != s]
        terms = [(w, f(p[lang, s, w], p[lang, None, w])) for w in kept[lang]
                 if counts[lang, s, w] and p[lang, s, w] > p[lang, None, w]]
        for part, found, limit in (("pair", pairs, None), ("term", terms, most)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out |= {(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(found[:limit])}
    return out


def test_divergence(spark, odd, none):
    rows = [(r[1], r[2], r[3]) for r in odd_rows()] + [("A Aa aA é 12", "xx", "lone"), (None, "xx", None), ("", "yy", "s")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    want = diverging(rows)
    for block, tile, most in ((4, 2, 200), (64, 32, 3), (4096, 1, 200)):
        got = [tuple(r) for r in divergence.source_divergence(docs, block=block, tile=tile, most=most).collect()]
        assert len(got) == len(set(got)) and set(got) == diverging(rows, most=most)
    got = {tuple(r) for r in divergence.source_divergence(odd).collect()}
    assert got == diverging([(r[1], r[2], r[3]) for r in odd_rows()])
    assert divergence.source_divergence(none).count() == 0
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert set(con.execute(divergence.OP11_SQL).fetchall()) == want


def test_trees_share_nodes_and_pairs():
    rng = np.random.default_rng(3)
    counts = rng.poisson(0.05, (6, 500)).astype(np.int64)
    counts[3] = counts[1]
    forest = divergence.Forest(counts)
    assert forest.roots[3] == forest.roots[1] and len(set(forest.roots)) == 5
    assert sum(len(a) for a, _ in forest.children) < 6 * 512 / 3
    totals = counts.sum(1)
    (a, b, ab, ba), (t, at, value) = divergence.block_values(
        np.vstack([counts, counts.sum(0)]), np.append(totals, totals.sum()), list(range(6)), list(range(6)), 500, 6, 5)
    f = lambda p, q: (p - q) * (p - q) // q
    p = 1 + 10 ** 9 * (np.vstack([counts, counts.sum(0)]) + 1) // (np.append(totals, totals.sum())[:, None] + 500)
    assert len(a) == 36  # two different lists: every pair
    for i, j, v, w in zip(a, b, ab, ba):
        assert v == f(p[i], p[j]).sum() and w == f(p[j], p[i]).sum()
    for i in range(6):
        own = np.where((counts[i] > 0) & (p[i] > p[6]), f(p[i], p[6]), -1)
        least = np.sort(own)[-5]
        assert sorted(at[t == i]) == np.flatnonzero(own >= max(least, 0)).tolist()
        assert (value[t == i] == own[at[t == i]]).all()


def test_rates_beyond_64_bits():
    counts = np.array([0, 10 ** 12, 4 * 10 ** 15])
    got = divergence.rate(counts, 5 * 10 ** 15, 7)
    assert got.tolist() == [1 + 10 ** 9 * (int(c) + 1) // (5 * 10 ** 15 + 7) for c in counts]


def test_a_hot_source(spark):
    docs = spark.range(0, 3000, 1, 12).selectExpr(
        "concat('same words ', 'w', id % 50) AS text", "'en' AS lang", "IF(id % 3 = 0, concat('s', id % 9), 'hot') AS source")
    rows = [tuple(r) for r in docs.collect()]
    assert {tuple(r) for r in divergence.source_divergence(docs, block=2).collect()} == diverging(rows)


# ---------------------------------------------------------------- packing

def check_pieces(pieces, docs, window, n_ids):
    """Every id once, sequences without holes or padding.  ``docs``: ids by row, in the operator's rows."""
    by, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        by[p._row].append(p)
        sequences[p.sequence_id].append(p)
    got = sorted((tuple(x for p in sorted(ps, key=lambda p: p.start) for x in np.frombuffer(p.ids, "<u4").tolist())
                  for ps in by.values()))
    assert got == sorted(map(tuple, docs))
    for ps in by.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            assert p.start == at and p.length == len(p.ids) // 4 > 0
            at += p.length
        assert at == ps[0].doc_tokens
    assert sorted(sequences) == list(range(len(sequences)))
    for ps in sequences.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == window or (at < window and at & (at - 1) == 0)


def test_pack(odd, none):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(packing.default_tokenizer())
    docs = [library.encode(t or "", add_special_tokens=False).ids + [0] for _, t in DOCS]
    for window in (1024, 64):
        pieces = packing.pack(odd, packing.default_tokenizer(), window=window).collect()
        assert sorted((p.doc_id is None, p.doc_id or 0) for p in pieces if p.start == 0) == sorted(
            (d is None, d or 0) for d, _ in DOCS)
        check_pieces(pieces, docs, window, 0)
    assert packing.pack(none, packing.default_tokenizer()).count() == 0


def test_ids_are_the_library_s():
    encoder = packing.Encoder(open(packing.default_tokenizer(), encoding="utf-8").read())
    rng = random.Random(8)
    letters = "ab Z9.,'\n\té’日😀  " + "".join(chr(rng.randrange(0x80, 0x3000)) for _ in range(60))
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(400)]
    texts += ["<|endoftext|>", "x <|endoftext|>y", "word " * 40_000, "a" * 200_000, " " * 200_000, "it's we'll " * 20_000]
    for t in texts:
        assert np.concatenate(list(encoder.ids(t))).tolist() == encoder.library.encode(t, add_special_tokens=False).ids


def test_repeats_solve_the_least_squares():
    """At the solution no combination gains by more repeats, and those in use neither by fewer (up to the tolerance)."""
    rng = np.random.default_rng(5)
    counts = np.bincount(rng.integers(1, 128, 30_000), minlength=129).astype(np.int64)
    lens, times = packing.combinations(np.flatnonzero(counts), 128)
    assert ((lens * times).sum(1) == 128).all() and len({(*sorted(zip(a, t)),) for a, t in zip(lens.tolist(), times.tolist())}) == len(lens)
    x = packing.solve_repeats(lens, times, counts)
    left = counts - np.array([(times * (lens == a) * x[:, None]).sum() for a in range(129)])
    gain = (times * left[lens]).sum(1) / np.sqrt((times * times).sum(1))
    assert (x >= 0).all() and (x > 0).sum() <= 128 and gain.max() < 1 and np.abs(gain[x > 0]).max() < 1
    repeats = packing.whole_repeats(lens, times, x, counts)
    used = np.array([(times * (lens == a) * repeats[:, None]).sum() for a in range(129)])
    assert (used <= counts).all() and counts.sum() - used.sum() < 0.02 * counts.sum()


def test_places_are_distinct_whatever_the_histogram():
    rng = np.random.default_rng(6)
    for counts in (np.bincount([700] * 500, minlength=1025), np.bincount([3] * 5000, minlength=1025),
                   np.bincount(rng.integers(1, 1025, 3000), minlength=1025), np.zeros(1025, np.int64),
                   np.bincount([1024] * 7 + [1], minlength=1025)):
        plan = packing.Plan(counts.astype(np.int64), 1024)
        length = np.repeat(np.arange(1025), counts)
        rank = np.concatenate([np.arange(c) for c in counts])
        taken = defaultdict(list)
        for a, s, o in zip(length, *plan.place(length, rank)):
            for _, n, sequence, offset in ([(0, int(a), int(s), int(o))] if s >= 0 else plan.cut(int(o), int(a))):
                taken[sequence].append((offset, n))
        assert sorted(taken) == list(range(len(taken)))
        for parts in taken.values():
            at = 0
            for offset, n in sorted(parts):
                assert offset == at
                at += n
            assert at == 1024 or at & (at - 1) == 0


# ---------------------------------------------------------------- spelling

def test_spelling(spark, odd, none):
    rng = random.Random(9)
    words = ["house", "horse", "houses", "mouse", "Maße", "maßen", "naïve", "naive", "École", "÷×÷×÷", "abcde" * 2000]
    words += [w[:i] + rng.choice("abeé") + w[i + 1:] for w in ("house", "naïve", "letters") for i in range(5)] + ["letters"]
    rows = [(i, " ".join(rng.choices(words, weights=[2 ** (j % 6) for j in range(len(words))], k=60))) for i in range(40)]
    rows += [(None, "house house-horse"), (7, None), (8, ""), (8, "HOUSE"), (8, "HOUSE")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = spelling(rows)
    assert any(v[0] and v[1] != v[0] for v in want.values())
    for symbols in (None, 1, 2, 16):
        got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_variants(docs, symbols=symbols).collect()}
        assert got == want
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_variants(odd).collect()}
    assert got == spelling(DOCS)
    assert spelling_variants(none).count() == 0


def test_neighbourhoods_hold_each_string_once():
    rng = np.random.default_rng(4)
    for length in (1, 2, 5, 9):
        words = rng.integers(97, 105, (7, length))
        found = defaultdict(list)
        for i, (rows, keys) in enumerate(neighbourhoods(words, 3)):
            for r, k in zip(rows.tolist(), keys.tolist()):
                found[r].append(k)
        for r, w in enumerate((words % 3).tolist()):
            near = {tuple(w)}
            for i in range(length + 1):
                near |= {tuple(w[:i] + [x] + w[i:]) for x in range(3)}
                if i < length:
                    near |= {tuple(w[:i] + [x] + w[i + 1:]) for x in range(3)} | {tuple(w[:i] + w[i + 1:])}
            assert len(found[r]) == len(set(found[r])) == len(near)


def test_counts_of_long_texts(spark):
    text = "Wörter " * 400_000 + "x" * 3_000_000
    got = {r.word: r.n for r in word_counts(spark.createDataFrame([(3, text)], "doc_id bigint, text string"), least_count=1).collect()}
    h = zlib.crc32("3:wörter".encode())
    assert h % 97 and got == {"wörter": 400_000, "x" * 3_000_000: 1}


def test_roots_of_long_chains(spark):
    links = spark.range(40).selectExpr("concat('w', id) AS word", "concat('w', id + 1) AS form")
    assert {(r.word, r.root) for r in roots(links).collect()} == {(f"w{i}", "w40") for i in range(40)}
    assert near_words(spark.createDataFrame([], "_w bigint, word string, n bigint"), 8).count() == 0
