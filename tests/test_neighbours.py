"""Nearest neighbours by adaptive cells and by hashing, and balancing with keys of any type."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import neighbours
from strata.operators.balance import smote
from strata.operators.neighbours import build_cells, knn_for_seeds, lsh_for_seeds
from strata.session import stored


def brute(points, seeds, k):
    """{(seed, rank): coordinates} by (distance, key)."""
    x = np.array([p[1:] for p in points])
    out = {}
    for key in seeds:
        i = next(j for j, p in enumerate(points) if p[0] == key)
        d2 = np.zeros(len(x))
        for j in range(x.shape[1]):
            d2 += (x[:, j] - x[i, j]) ** 2
        order = sorted((j for j in range(len(x)) if j != i), key=lambda j: (d2[j], points[j][0]))
        out |= {(key, r + 1): points[j][1:] for r, j in enumerate(order[:k])}
    return out


def dense(n, rng):
    """A third far apart, the rest in a cluster of distinct points a millionth as wide, some copies and ties."""
    rows = []
    for i in range(n):
        if i % 3 == 0:
            rows.append((f"k{i}", rng.uniform(-1e3, 1e3), rng.uniform(-1e3, 1e3), float(i % 4)))
        elif i % 50 == 1:
            rows.append((f"k{i}", 0.5, 0.5, 1.0))
        else:
            rows.append((f"k{i}", rng.gauss(0, 1e-3), rng.gauss(0, 1e-3), float(rng.randint(0, 2))))
    return rows


def test_exact_in_a_dense_cluster(spark):
    rng = random.Random(7)
    points = dense(1500, rng)
    df = spark.createDataFrame(points, "k string, a double, b double, c double").repartition(5)
    cols = ["a", "b", "c"]
    seeds = df.where(F.crc32("k") % 6 == 0).withColumn("_pos", F.crc32("k"))
    names = {r["_pos"]: r["k"] for r in seeds.collect()}
    want = brute(points, list(names.values()), 4)
    got = {(names[r["_pos"]], r["_rnk"]): (r["n_a"], r["n_b"], r["n_c"])
           for r in knn_for_seeds(df, seeds, cols, "k", 4, cell_rows=20).collect()}
    assert got == want
    tree = build_cells(stored(df, "dense"), cols, 20, sample_rows=60)
    leaves = tree.counts[tree.feature < 0]
    assert leaves.sum() == 1500 and leaves.max() <= 2 * 20 + 30  # thirty copies of one point can't be split


def test_a_cell_with_many_visitors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "VISITORS", 7)
    rng = random.Random(1)
    points = [(i, rng.random(), rng.random()) for i in range(200)]
    df = spark.createDataFrame(points, "k long, a double, b double")
    got = {(r["_pos"], r["_rnk"]): (r["n_a"], r["n_b"])
           for r in knn_for_seeds(df, df.withColumn("_pos", F.col("k")), ["a", "b"], "k", 3, cell_rows=50).collect()}
    assert got == brute(points, range(200), 3)


def test_fewer_points_than_neighbours(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 1.0)], "k long, a double")
    got = [tuple(r) for r in knn_for_seeds(df, df.withColumn("_pos", F.col("k")), ["a"], "k", 5).collect()]
    assert sorted(got) == [(1, 1, 1.0), (2, 1, 0.0)]


def test_hashing_finds_nine_of_ten(spark):
    rng = random.Random(5)
    points = [(i, *(rng.gauss(10 * (i % 4), 1) for _ in range(6))) for i in range(1200)]
    cols = [f"x{j}" for j in range(6)]
    df = spark.createDataFrame(points, "k long, " + ", ".join(f"{c} double" for c in cols))
    seeds = df.where("k % 5 = 0").withColumn("_pos", F.col("k"))
    want = brute(points, range(0, 1200, 5), 5)
    got = {(r["_pos"], r["_rnk"]): tuple(r[f"n_{c}"] for c in cols) for r in lsh_for_seeds(df, seeds, cols, "k", 5).collect()}
    assert got.keys() == want.keys()
    by_seed = [len({got[s, r] for r in range(1, 6)} & {want[s, r] for r in range(1, 6)}) for s in range(0, 1200, 5)]
    assert sum(by_seed) >= 0.9 * len(want)


@pytest.mark.parametrize("key", ["CAST(id AS string)", "-id", "CAST(id AS decimal(20, 2))", "CAST(id AS timestamp)"])
def test_smote_keys_of_any_type(spark, key):
    df = spark.range(60).selectExpr(f"{key} AS k", "IF(id % 3 = 0, 'rare', 'often') AS y", "id * 1.0D AS a", "(id * 37 % 11) * 1.0D AS b")
    out = smote(df, "y", ["a", "b"], "k", k=3).collect()
    assert len(out) == 80 and sum(r["y"] == "rare" for r in out) == 40
    assert sorted(r["sample_id"] for r in out if not r["synthetic"]) == sorted(r["k"] for r in df.collect())
    assert sorted(r["synthetic_id"] for r in out if r["synthetic"]) == list(range(1, 21))
    assert all((r["sample_id"] is None) == r["synthetic"] for r in out)


def test_smote_refuses_null_labels_and_takes_hashing(spark):
    df = spark.range(60).selectExpr("id AS k", "IF(id % 3 = 0, 1, 0) AS y", "id * 1.0D AS a")
    assert smote(df, "y", ["a"], "k", k=3, search="lsh").count() == 80
    assert smote(df.limit(0), "y", ["a"], "k").count() == 0
    with pytest.raises(ValueError, match="without a label"):
        smote(df.withColumn("y", F.when(F.col("k") > 3, F.col("y"))), "y", ["a"], "k")
    with pytest.raises(ValueError, match="search"):
        smote(df, "y", ["a"], "k", search="all")
