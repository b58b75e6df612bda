"""Odd input rows and the fixtures made of them (not a conftest, whose name the folder above has)."""
import random

import pytest

#: Names that operators use inside, as extra columns of the input.
CLASHES = ["_row", "name", "kept", "size", "n", "key", "a", "anchor", "content", "lang_pred", "copies", "_t", "id", "th", "_b"]


def odd_rows():
    """(doc_id, text, lang, source): nulls, empties, long and short texts, ties, copies, repeated rows."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefgéß") for _ in range(rng.randint(1, 7))) for _ in range(150)]
    words = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, long_, passage = words(160), words(9000), words(70)
    near = base.split()
    near[80] = "changed"
    rows = [(1, base, "en", "s0"), (2, base.replace(" ", "\n"), "en", "s0"), (3, base + " ", None, None),
            (4, " ".join(near), "fr", "s1"), (5, "", "en", "s1"), (6, None, None, None), (7, " \t\n", "fr", "s2"),
            (8, long_, "en", "s2"), (9, long_[:30000] + " x " + long_[30000:], "en", "s0"), (10, "one", "en", "s0"),
            (11, "one", "fr", "s3"), (12, "one two", "fr", "s3"), (None, base, "en", "s0"), (None, None, None, None),
            (13, words(60) + " " + passage + " " + words(40), "en", "s0"), (14, passage + " " + words(90), "fr", "s4"),
            (15, passage + " " + passage, "en", "s4"), (15, passage + " " + passage, "en", "s4"),
            (16, words(24), "en", "s0"), (17, "a " * 500, "en", "s0"), (18, "😀 " * 300 + "日本語" * 200, "fr", "s5")]
    near20 = words(21).split()
    for i in range(6):
        w = list(near20)
        w[3 * i + 1] = f"w{i}"
        rows.append((20 + i, " ".join(w if i else near20), "en", "s0"))
    for i in range(12):
        w = list(near)
        w[10 * i + 5] = f"v{i}"
        rows.append((40 + i, " ".join(w), "en", "s6"))
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    extra = ", ".join(f"`{c}` string" for c in CLASHES)
    rows = [(*r, *(["clash"] * len(CLASHES))) for r in odd_rows()]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, {extra}").cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
