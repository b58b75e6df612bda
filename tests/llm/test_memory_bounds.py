"""Working memory of tasks: bounded whatever the size of a batch."""
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import sentencepiece
from llm_cases import odd  # noqa: F401

from strata.llm import jaccard_join, sentencepiece_bpe as sp, suffix_dedup
from strata.llm.suffix_array import long_repeats


def peak_mb(run) -> float:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def text_batch(n: int, size: int) -> pa.RecordBatch:
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(3000)]
    texts = [" ".join(rng.choices(vocabulary, k=size // 6)).encode() for _ in range(n)]
    return pa.RecordBatch.from_arrays([pa.array([*texts, b"", b"one"], pa.binary())], names=["_t"])


def test_sets_of_a_large_batch_take_bounded_memory():
    batch = text_batch(4000, 2000)
    whole = list(jaccard_join._sets(batch.column("_t").slice(0, 30), 3))
    first = next(jaccard_join.set_pieces([batch], 3))[1]
    assert all(np.array_equal(a, b) for a, b in zip(whole, first))
    assert sum(len(rows) for _, rows in jaccard_join.set_pieces([batch], 3)) == batch.num_rows
    assert [len(rows[-1]) for _, rows in jaccard_join.set_pieces([batch.slice(4000)], 3)] == [1]

    def run():
        for _ in jaccard_join.set_pieces([batch], 3):
            pass

    assert peak_mb(run) < 60
    # Without pieces the same batch takes several times that.
    assert peak_mb(lambda: list(jaccard_join._sets(batch.column("_t"), 3))) > 60


def test_shards_sorted_together_take_bounded_memory():
    rng = random.Random(5)
    groups = []
    for _ in range(1500):
        core = bytes(rng.choices(b"abcdefgh ", k=rng.randint(390, 640)))
        groups.append([core + bytes(rng.choices(b"xyz", k=rng.randint(0, 60))) for _ in range(rng.randint(2, 4))])
    sized = [(sum(map(len, g)), i, [], g) for i, g in enumerate(groups)]
    found = {}

    def run():
        for some in suffix_dedup._batches(sized, suffix_dedup.TOGETHER):
            for (_, i, _, _), hits in zip(some, long_repeats([g[3] for g in some], 400)):
                found[i] = hits

    assert peak_mb(run) < 120
    assert len(found) == len(groups)
    for i in rng.sample(range(len(groups)), 40):
        every = [s[k:k + 400] for s in groups[i] for k in range(len(s) - 399)]
        want = [[every.count(s[k:k + 400]) > 1 for k in range(len(s) - 399)] for s in groups[i]]
        assert [list(h) for h in found[i]] == want


def test_encoder_keeps_units_in_use_and_its_caches_are_bounded(monkeypatch):
    monkeypatch.setattr(sp, "CACHE", 60)
    monkeypatch.setattr(sp, "PAIRS", 200)
    library = sentencepiece.SentencePieceProcessor(model_file=sp.default_model())
    with open(sp.default_model(), "rb") as f:
        table = sp.PrefixTable(sp.Pieces(f.read()))
    made = []
    make = table.known.make
    table.known.make = lambda unit: made.append(unit) or make(unit)
    rng = random.Random(8)
    for _ in range(200):
        text = "kept words stay here " + " ".join("".join(rng.choices("abcdeéß,.", k=rng.randint(3, 12))) for _ in range(30))
        parts = list(table.encode(text))
        ids = [int(i) for p in parts for i in p[0].split()]
        assert ids == library.encode(text, add_eos=True)
        assert "".join(p[2] for p in parts) == library.decode(ids)
        assert len(table.known) <= 60 and len(table.known.before) <= 60 and table.pairs <= 201
    assert made.count("▁words") == 1


def test_lists_are_shuffled_in_parts_with_the_same_links(odd, monkeypatch):
    names, write = [], jaccard_join.written_path
    monkeypatch.setattr(jaccard_join, "written_path", lambda df, name: names.append(name) or write(df, name))
    key = lambda: sorted(map(str, jaccard_join.similar_sets(odd).select("_row", "root_row").collect()))
    got = key()
    assert names.count("lists") == jaccard_join.PARTS > 1
    monkeypatch.setattr(jaccard_join, "PARTS", 1)
    assert key() == got


def test_near_duplicates_shuffle_sets_once_and_texts_never(spark, monkeypatch):
    """Sets on their way to their classes meet one exchange, whatever the number of documents that can be paired."""
    rng = random.Random(5)
    base = [" ".join(rng.choices([f"w{i}" for i in range(500)], k=120)) for _ in range(12)]
    rows = [(i, base[i % 12] + f" end{i // 24}") for i in range(48)] + [(None, base[0]), (None, base[0]), (3, base[5])]
    plans, real, was = {}, jaccard_join.written_path, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")

    def seen(df, name, *more):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name, *more)

    monkeypatch.setattr(jaccard_join, "written_path", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = jaccard_join.similar_sets(spark.createDataFrame(rows, "doc_id long, text string"), n_words=5, percent=80)
        got = sorted((r["n_shingles"], r["root_row"]) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert len(got) == 51 and len({root for _, root in got}) == 12
    dealt = [x for x in plans["contents"].splitlines() if "Exchange hashpartitioning" in x]
    assert sum("n#" in x and "h1#" in x for x in dealt) == 2  # sets, and their classes' names
    assert not any("doc_id" in x or "class_row" in x for x in dealt)
