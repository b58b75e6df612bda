"""Exact dedup, Jaccard join, repeated windows and repeated strings against plain versions."""
import numpy as np

from brute import exact, similar, strings, windows
from llm_cases import none, odd, odd_rows  # noqa: F401

from strata.llm.exact_dedup import exact_dedup
from strata.llm.jaccard_join import Plan, _apart, similar_sets, wide_sketch
from strata.llm.repeats import pieces
from strata.llm.substring_dedup import level_counts, levels, substring_dedup
from strata.llm.suffix_dedup import suffix_dedup

PAIRS = [(r[0], r[1]) for r in odd_rows()]
key = lambda t: tuple((x is None, x) for x in t)


def test_exact_dedup(odd, none):
    cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    for block in (64, 4096):
        got = [tuple(r) for r in exact_dedup(odd, block_bytes=block).select(*cols).collect()]
        want = exact(PAIRS)
        strip = lambda rows: sorted([(r[0], r[1], r[2], r[4]) for r in rows], key=key)
        assert strip(got) == strip(want)
        assert sum(r[3] for r in got) == sum(r[3] for r in want) == len({r[4] for r in want})
        assert {(r[0], r[4]) for r in got if r[3]} == {(r[0], r[4]) for r in want if r[3]}
    assert exact_dedup(none).count() == 0


def test_names_of_hot_blocks_agree_across_tasks(spark):
    """A block that most rows share is spread over tasks and still gets one name."""
    docs = spark.range(0, 4000, 1, 16).selectExpr(
        "id AS doc_id", "CASE WHEN id % 3 < 2 THEN repeat('hot block ', 30) ELSE concat('doc ', id) END AS text")
    got = exact_dedup(docs, block_bytes=32)
    assert got.where("group_size > 1").select("keep_id").distinct().count() == 1
    assert got.where("kept").count() == got.select("text_sha256").distinct().count()


def test_similar_sets(odd, none):
    rows = [(i, d, t) for i, (d, t) in enumerate(PAIRS)]
    for n_words, percent in ((3, 90), (5, 80)):
        got = sorted([tuple(r) for r in similar_sets(odd, n_words=n_words, percent=percent).select(
            "doc_id", "n_shingles", "component_id").collect()], key=key)
        want = similar(rows, n_words, percent)
        assert got == sorted([(d, *want[i]) for i, d, _ in rows], key=key)
    assert similar_sets(none).count() == 0


def test_small_sets_and_large_sets_meet(spark):
    """Pairs on both sides of the boundary between subsets and lists."""
    docs = []
    for n in range(4, 60, 3):
        words = [f"w{n}_{i}" for i in range(n)]
        docs += [(10 * n, " ".join(words)), (10 * n + 1, " ".join(words + ["tail"])), (10 * n + 2, " ".join(words[:-2] + ["x", "y"]))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_sets(df, n_words=1, percent=90).collect()}
    assert got == similar([(d, d, t) for d, t in docs], 1, 90)


def test_wide_sketches_bound_the_difference(spark):
    """Wide sketches of different lengths never show more bits than elements, and tell unlike sets apart."""
    rng = np.random.default_rng(5)
    rows, differ = [], []
    for n, common in ((300, 280), (257, 200), (512, 512), (500, 450), (2000, 1990), (1024, 0), (100, 90), (1200, 300)):
        every = rng.integers(0, 2**63, 4 * n, dtype=np.uint64)
        for m in (n, n + n // 8):
            a, b = every[:n], np.r_[every[:common], every[2 * n:2 * n + m - common]]
            rows.append((wide_sketch(a), wide_sketch(b)))
            differ.append(n + m - 2 * common)
    frame = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "i int, a array<bigint>, b array<bigint>")
    got = dict(frame.select("i", _apart("a", "b").alias("d")).collect())
    assert all(got[i] <= d for i, d in enumerate(differ))
    assert all(got[i] >= d / 4 for i, d in enumerate(differ) if rows[i][0] and rows[i][1])
    assert any(len(a) != len(b) and a for a, b in rows) and any(not a for a, _ in rows)


def test_long_sets_that_share_passages(spark):
    """Long documents that share passages, some of them near copies: links as by brute force at both thresholds."""
    rng = np.random.default_rng(11)
    shared = [f"s{i}" for i in range(400)]
    docs = []
    for i in range(24):
        own = [f"d{i}_{j}" for j in range(int(rng.integers(200, 900)))]
        docs.append((10 * i, " ".join(shared + own)))
        for k, cut in enumerate((2, 12, 60)):
            docs.append((10 * i + k + 1, " ".join(shared + own[:-cut] + [f"t{i}_{k}_{j}" for j in range(cut // 2)])))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    for n_words, percent in ((1, 80), (3, 90)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_sets(df, n_words=n_words, percent=percent).collect()}
        assert got == similar([(d, d, t) for d, t in docs], n_words, percent)


def test_scratch_tables_go(spark):
    """Only the tables that the result reads are left, and the setting for shuffle files is as it was."""
    from strata.llm.common import _TIDY, made
    docs = spark.createDataFrame([(i, f"a b c d e f g h i{i // 2}") for i in range(40)], "doc_id bigint, text string")
    before, was = len(made), spark.conf.get(_TIDY, None)
    out = similar_sets(docs, n_words=2, percent=80)
    left = {path.split("/strata-")[-1].rsplit("-", 1)[0] for path in made[before:]}
    assert not left & {"sets", "copies", "lists", "contents", "couples", "crowds", "wanted", "pairs", "close", "edges"}
    assert out.count() == 40 and spark.conf.get(_TIDY, None) == was


def test_links_of_crowds(spark):
    """All links between classes and their numbers by document, also within a component that is linked already."""
    texts = [" ".join(f"w{j}" if j != i else f"x{i}" for j in range(60)) for i in range(8)]
    texts += [texts[0], texts[0], "", None, "only one", " ".join(f"y{j}" for j in range(60)), " ".join(f"y{j}" for j in range(59))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out, pairs = similar_sets(docs, n_words=1, percent=90, links=True)
    rows = {r.doc_id: r for r in out.collect()}
    sets = [set((t or "").split()) for t in texts]
    near = lambda a, b: bool(a) and 100 * len(a & b) >= 90 * len(a | b)
    assert {i: rows[i].n_links for i in rows} == {
        i: sum(near(a, b) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)}
    of = {r.class_row: sets[i] for i, r in rows.items()}
    assert sorted(map(tuple, pairs.collect())) == sorted((a, b) for a in of for b in of if a < b and near(of[a], of[b]))


def test_plan_costs():
    plan = Plan(90, 100)
    assert plan.least(10) == 9 and plan.most(9) == 10 and plan.subsets(9) == 2
    few = plan.boundary({5: 10_000})
    assert 5 <= few < 48
    for n in (30, 500, 7000):
        i = plan.band(n)
        plan.band(plan.lows[-1])
        assert plan.lows[i] <= n < plan.lows[i + 1] and plan.most(n) < plan.lows[i + 2]


def test_substring_dedup(odd, none):
    assert levels(50, 12) == [13, 25] and levels(50, 1)[:3] == [1, 2, 4] and levels(50, 26) == [25] and levels(1, 1) == [1]
    for window, start in ((50, 12), (50, 50), (9, 2), (9, 5), (50, 3)):
        got = substring_dedup(odd, window=window, start=start)
        have = [tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()]
        assert sorted(have, key=key) == sorted(windows(PAIRS, window), key=key)
    assert substring_dedup(none).count() == 0


def test_pieces_hold_all_rows():
    import pyarrow as pa
    texts = [b"a" * n for n in (0, 0, 3, 50, 1, 1, 1, 0, 7, 10, 10, 0)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["_t"])
    for some in (batch, batch.slice(2), batch.slice(3, 5)):
        got = [p.column("_t").to_pylist() for p in pieces([some, some.slice(0, 0)], 10)]
        assert sum(got, []) == some.column("_t").to_pylist()
        assert all(len(g) == 1 or sum(map(len, g)) <= 10 for g in got) and all(got)


def test_levels_leave_fewer_candidates(spark):
    """Every level reads what the one before left; all windows that are removed get to the last."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = level_counts(docs).collect()
    every = docs.selectExpr("size(filter(split(text, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w != '')) AS n").collect()
    assert [r.length for r in rows] == [13, 25]
    assert rows[0].windows == sum(max(0, r.n - 49) for r in every)
    assert rows[0].windows > rows[0].survivors >= rows[1].windows >= rows[1].survivors > 0


def test_ids_of_other_types(spark):
    """Text ids in their own order ('10' before '9'), and decimals with fractions; null ids last."""
    texts = [(t, i) for i, (_, t) in enumerate(PAIRS)]
    name = lambda i: None if i % 11 == 3 else str(i)
    text_rows = [(name(i), t) for t, i in texts]
    place = {d: n for n, d in enumerate(sorted({d for d, _ in text_rows if d is not None}))}
    want = windows([(place.get(d), t) for d, t in text_rows], 50)
    df = spark.createDataFrame(text_rows, "doc_id string, text string")
    cols = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    got = [tuple(r) for r in substring_dedup(df).select(*cols).collect()]
    assert sorted([(place.get(r[0]), *r[1:]) for r in got], key=key) == sorted(want, key=key)
    part = df.selectExpr("CAST(doc_id AS decimal(10,2)) / 4 AS doc_id", "text")
    assert sum(r.n_removed for r in substring_dedup(part).collect()) == sum(
        r[2] for r in windows([(None if d is None else int(d), t) for d, t in text_rows], 50))
    cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    have = [tuple(r) for r in suffix_dedup(df).select(*cols).collect()]
    assert sorted([(place.get(r[0]), *r[1:]) for r in have], key=key) == sorted(
        strings([(place.get(d), t) for d, t in text_rows], 400), key=key)


def test_one_passage_in_many_documents(spark):
    """A passage that all documents share, each with its own words around: gone from all but the first."""
    passage = " ".join(f"p{i}" for i in range(70))
    docs = spark.range(0, 900, 1, 12).selectExpr(
        "id AS doc_id", f"concat_ws(' ', concat('a', id), concat('b', id), '{passage}', concat('c', id)) AS text")
    got = {r.doc_id: r.n_removed for r in substring_dedup(docs).collect()}
    assert got == {i: 70 if i else 0 for i in range(900)}


def test_suffix_dedup(odd, none):
    want = {n: sorted(strings(PAIRS, n), key=key) for n in (400, 40)}
    cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for length, core, shard in ((400, 160, 24), (400, 160, 1), (40, 16, 24), (40, 16, 2)):
        got = suffix_dedup(odd, length=length, core=core, shard_strings=shard)
        assert sorted([tuple(r) for r in got.select(*cols).collect()], key=key) == want[length]
    assert suffix_dedup(none).count() == 0


def test_words_of_two_letters_in_the_order_of_thue_and_morse(spark):
    """Sums of powers modulo 2**64 don't tell such a word from its complement; the operators do."""
    import numpy as np
    from strata.llm.common import flat
    from strata.llm.words import words
    import pyarrow as pa
    bits = np.array([0])
    for _ in range(12):
        bits = np.concatenate([bits, 1 - bits])
    pairs = []
    for n in (64, 256, 257, 1024, 2048, 4096):
        a = "".join("ab"[b] for b in bits[:n])
        pairs += [a, a.translate(str.maketrans("ab", "ba"))]
    assert len(set(words(*flat(pa.array(pairs)), lower=False)[0].tolist())) == len(pairs)
    docs = spark.createDataFrame(list(enumerate(pairs)), "doc_id bigint, text string")
    assert all(r.component_id == r.doc_id for r in similar_sets(docs, n_words=3, percent=90).collect())
    long_ = pairs[-2:]
    rows = [(0, " ".join([long_[0]] * 50)), (1, " ".join([long_[1]] * 50)), (2, " ".join([long_[1]] * 50))]
    got = {r.doc_id: r.n_removed for r in substring_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {0: 0, 1: 0, 2: 50}
