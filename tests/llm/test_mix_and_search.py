"""Mixing, nearest neighbours, components, pipeline and registration."""
import random

import numpy as np
from llm_cases import CLASHES, none, odd, odd_rows  # noqa: F401
from pyspark.sql import functions as F

from strata.llm import hilbert_ann, mixing
from strata.llm.components import components


def fill(sizes, weights=(1, 2, 3), most=3.0):
    """Targets by the rule: share by weight, stop at ``most`` times the size, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, done = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in done]
        left = total - sum(done.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return done | share
        done |= {s: most * sizes[s] for s in over}


def test_targets(spark):
    sizes = {"a": 10, "b": 1000, "é": 5, "Z": 400, None: 70, "zz": 1}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = fill(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-9 * max(1, want[s]) for s in want)


def test_mix_balances_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    one = mixing.mix(docs, group_rows=300)
    two = mixing.mix(docs.repartition(5), group_rows=300)
    rows = one.collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in two.collect())
    assert all(0 <= r.copies <= 3 and r.taken == r.size * r.copies for r in rows)
    by = {}
    for r in rows:
        s = by.setdefault(r.source, [r.target, 0, 0, 0.0])
        s[1] += r.taken
        s[2] = max(s[2], r.size)
    assert all(abs(taken - target) <= 0.03 * target for target, taken, _, _ in by.values())  # 50 documents a source


def test_flight_keeps_both_totals():
    rng = random.Random(2)
    units = [(rng.random(), rng.randint(1, 500)) for _ in range(4000)]
    flight, chosen = mixing.Flight(5), []
    for i, (p, s) in enumerate(units):
        chosen += list(flight.add(p, s, i))
    undecided = {u[2]: u[0] for u in flight.held}
    got = dict(chosen) | undecided
    assert len(undecided) <= 2 and len(got) == len(units)
    assert abs(sum(got.values()) - sum(p for p, _ in units)) < 1e-6
    assert abs(sum(got[i] * units[i][1] for i in got) - sum(p * s for p, s in units)) < 1e-3


def test_mix_odd_tables(odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(odd_rows()) and all(r.taken <= 3 * r.size for r in rows)
    assert mixing.mix(none).count() == 0


def test_hilbert_keys_walk_the_grid():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        path = cells[np.argsort(hilbert_ann.hilbert_keys(cells, bits))]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_nearest_recall_and_ties(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = docs.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    got = hilbert_ann.nearest(docs).toPandas()
    hit = 0
    for q, g in got.groupby("query_id"):
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -s))[:20]]
        g = g.sort_values("rank")
        assert g["rank"].tolist() == list(range(1, 21)) and q not in set(g.vec_id)
        assert np.allclose(g.score, [s[ids == v][0] for v in g.vec_id], atol=1e-12)
        hit += len(set(best) & set(g.vec_id))
    assert got.query_id.nunique() == (ids % 20 == 0).sum() and hit / len(got) >= 0.9


def test_nearest_copies_and_bad_vectors(spark):
    rng = random.Random(1)
    vec = lambda: [rng.gauss(0, 1) * rng.choice([1, 5]) for _ in range(8)]
    hot = vec()
    rows = [(i, hot) for i in range(0, 90, 3)] + [(i, vec()) for i in range(1, 90, 3)]
    rows += [(100, None), (120, [0.0] * 8), (140, [1.0, None] + [0.0] * 6), (160, [float("nan")] * 8), (180, [float("inf")] * 8),
             (200, [1.0]), (None, vec()), (0, hot)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, rep int")
    got = hilbert_ann.nearest(df, k=5, reach=1.0).toPandas()
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows[:-8]}
    assert set(got.query_id) == {i for i in good if i % 20 == 0}
    for q, g in got.groupby("query_id"):
        want = sorted((-float(good[i] @ good[q]), i) for i in good if i != q)[:5]
        g = g.sort_values("rank")
        assert g.vec_id.tolist() == [i for _, i in want] and np.allclose(g.score, [-s for s, _ in want])
    assert hilbert_ann.nearest(df.limit(0)).count() == 0 and hilbert_ann.nearest(df.where("vec_id = 200")).count() == 0


def test_nearest_ties_at_the_edge_of_a_block(spark):
    """Vectors of -1, 0 and 1 tie by the hundred; one curve whose windows hold all rows gives the smallest ids."""
    x = np.random.default_rng(8).integers(-1, 2, (1500, 12)).astype(float)
    x = x[(x != 0).any(axis=1)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    got = {}
    for r in hilbert_ann.nearest(df, k=7, curves=1, reach=1.0, block=64).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    ids = np.arange(len(x))
    assert got == {q: np.lexsort((ids, -s[q]))[:7].tolist() for q in range(0, len(x), 20)}


def test_nearest_scores_double_vectors_as_they_are(spark):
    x = np.random.default_rng(9).standard_normal((200, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    rows = hilbert_ann.nearest(df, k=5, reach=1.0).collect()
    assert len(rows) == 50 and all(abs(r.score - x[r.query_id] @ x[r.vec_id]) < 1e-14 for r in rows)


def test_nearest_recall_by_partitions(spark):
    """Windows are whole however many partitions cut the curves."""
    x = np.random.default_rng(5).standard_normal((1000, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    recall = {}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in (1, 40):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = hilbert_ann.nearest(df, k=10, curves=2, reach=0.2).collect()
            s = x.astype(float) @ x.astype(float).T
            np.fill_diagonal(s, -np.inf)
            best = {q: set(np.argsort(-s[q])[:10].tolist()) for q in range(0, 1000, 20)}
            recall[n] = sum(r.vec_id in best[r.query_id] for r in got) / 500
            assert len(got) == 500
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert recall[1] > 0.6 and recall[40] > recall[1] - 0.05, recall


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(100, 160)] + [(1000, 1000 + i) for i in range(1, 50)]
    edges += [(rng.randint(0, 90), rng.randint(0, 90)) for _ in range(50)] + [(5, 5)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: root(x) for x in up if any(x in e and e[0] != e[1] for e in edges)}


def test_pipeline_stages(spark, odd, tmp_path):
    """Each stage keeps the columns, keeps clean documents and does what its operator decides."""
    import corpus_pipeline as p
    assert [n for n, _ in p.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mix", "encode"]
    docs, seen = odd, []
    for name, stage in p.STAGES:
        out = stage(spark, docs, "")
        if name != "encode":
            assert out.columns == odd.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen.append(docs)
    language, exact, near, mixed, encoded = seen
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect() if r.doc_id is not None)
    assert not {5, 6, 7} & set(ids(language)) and len(ids(language)) == len([r for r in odd_rows() if r[0] not in (5, 6, 7, None)])
    assert 3 in ids(exact) and not {1, 2} & set(ids(exact)) and ids(exact).count(15) == 1  # 3 has the most code points
    assert 3 in ids(near) and not set(range(40, 52)) & set(ids(near)) and {10, 12, 13, 14, 16, 18} <= set(ids(near))
    assert set(ids(mixed)) <= set(ids(near)) and encoded.count() == mixed.count()
    empty = odd.limit(0)
    for _, stage in p.STAGES:
        assert stage(spark, empty, "").count() == 0


def test_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    for n, name in enumerate(["exact_dedup", "hilbert_ann", "chat_format", "language_id", "substring_dedup", "mix", "jaccard_join",
                              "sentencepiece", "suffix_dedup", "secrets"], 1):
        assert f"op{n}_{name}" in names
    assert "pipeline" in names and "op1_exact_dedup" in entry.oracle_sql() and len(CLASHES) > 10 and F
