import random
from collections import Counter

import numpy as np

from strata.llm.suffix_array import long_repeats, suffix_arrays
from strata.llm.words import prefix_hashes, range_hashes, words


def test_suffix_arrays_sort_suffixes():
    rng = random.Random(3)
    for _ in range(40):
        texts = [[rng.randint(1, rng.choice([1, 2, 4, 20])) for _ in range(rng.randint(0, 60))] + [0] for _ in range(rng.randint(1, 7))]
        size = np.array([len(t) for t in texts])
        matrix = np.zeros((size.max(), len(texts)), np.int64)
        for i, t in enumerate(texts):
            matrix[:len(t), i] = t
        got = suffix_arrays(matrix, size)
        for i, t in enumerate(texts):
            assert got[:len(t), i].tolist() == sorted(range(len(t)), key=lambda k: t[k:])


def test_long_repeats():
    rng = random.Random(5)
    for _ in range(80):
        n = rng.choice([3, 5, 8])
        groups = [[bytes(rng.choice(b"abc"[:rng.randint(1, 3)]) for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 4))]
                  for _ in range(rng.randint(1, 5))]
        for g, found in zip(groups, long_repeats(groups, n)):
            count = Counter(s[i:i + n] for s in g for i in range(len(s) - n + 1))
            for s, hit in zip(g, found):
                assert hit.tolist() == [count[s[i:i + n]] > 1 for i in range(len(s) - n + 1)]


def test_words_and_ranges():
    texts = ["Ab  ab\tAB", "", " ", "é x", "x"]
    raw = [t.encode() for t in texts]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    data = np.frombuffer(b"".join(raw), np.uint8)
    hashes, begin, end, first = words(data, at, lower=True)
    assert [bytes(data[a:b]) for a, b in zip(begin, end)] == [w for r in raw for w in r.split()]
    assert first.tolist() == [0, 3, 3, 3, 5, 6]
    assert hashes[0] == hashes[1] == hashes[2] and hashes[4] == hashes[5] and hashes[3] != hashes[4]
    p = prefix_hashes(hashes)
    one = range_hashes(p, np.array([0, 1, 4]), np.array([2, 3, 6]))
    assert one[0] == one[1] != one[2]
