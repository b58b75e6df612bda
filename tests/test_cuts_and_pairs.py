"""Exact cuts of classes, ROC points, correlations by blocks and forecasts with whole pipelines, on odd data."""
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.functions.exprs import hash_uniform
from strata.functions.stats import prefix_sums
from strata.operators import metrics, profile, split


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("parts", [1, 3, 4096])
def test_split_cuts_each_class_exactly(spark, monkeypatch, parts):
    monkeypatch.setattr(split, "DRAW_PARTS", parts)
    df = spark.range(1200).selectExpr("concat('k', id) AS k", "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 7 < 5 THEN 'a' ELSE 'b' END AS y")
    for share in (0.0, 0.2, 0.37, 1.0):
        got = {r["k"]: r["split"] for r in split.stratified_split(df, "y", "k", share, seed=5).collect()}
        rows = df.withColumn("u", hash_uniform("k", 5)).collect()
        for label in (None, "a", "b"):
            mine = sorted((r["u"], r["k"]) for r in rows if r["y"] == label)
            n = int(math.floor(share * len(mine) + 0.5))
            assert [got[k] for _, k in mine] == ["test"] * n + ["train"] * (len(mine) - n)


def test_split_orders_only_rows_near_the_cut(spark):
    df = spark.range(20_000).selectExpr("id AS k", "id % 2 AS y")
    out = split.stratified_split(df, "y", "k")
    # what is left to do for a row: a join with one row a class
    text = plan(out)
    assert "Window" not in text.split("Join")[0] and "rangepartitioning" not in text
    assert out.groupBy("split").count().where("split = 'test'").first()["count"] == 4000


def test_previous_values_cross_ranges(spark):
    df = spark.range(500).selectExpr("id * 37 % 500 AS k", "id % 5 AS v", "id * 0.5D AS w")
    rows = sorted(prefix_sums(df, ["k"], ["v", "w"], partitions=7, previous="p_").collect(), key=lambda r: r["_gidx"])
    assert [r["k"] for r in rows] == list(range(500))
    assert [r["p_v"] for r in rows] == [None] + [r["v"] for r in rows[:-1]]
    assert [r["p_w"] for r in rows] == [None] + [r["w"] for r in rows[:-1]]
    assert rows[-1]["cum_v"] == sum(r["v"] for r in rows)


def test_roc_curve_drops_collinear_points_only(spark):
    rng = np.random.default_rng(2)
    data = [(float(s), int(y)) for s, y in zip(rng.integers(0, 60, 400) / 7, rng.integers(0, 2, 400))]
    df = spark.createDataFrame(data, "score double, y int")
    thresholds = sorted({s for s, _ in data}, reverse=True)
    tp = np.cumsum([sum(y for s, y in data if s == t) for t in thresholds])
    fp = np.cumsum([sum(1 - y for s, y in data if s == t) for t in thresholds])
    keep = [i for i in range(len(tp)) if i in (0, len(tp) - 1) or tp[i + 1] - 2 * tp[i] + tp[i - 1] or fp[i + 1] - 2 * fp[i] + fp[i - 1]]
    want = [(0, None, 0.0, 0.0)] + [(i + 1, thresholds[i], fp[i] / fp[-1], tp[i] / tp[-1]) for i in keep]
    assert sorted(tuple(r) for r in metrics.roc_curve(df).collect()) == want
    assert len(metrics.roc_curve(df, drop_intermediate=False).collect()) == len(thresholds) + 1
    assert plan(metrics.roc_curve(df)).count("SortMergeJoin") == 0


def test_roc_of_one_score_and_of_no_rows(spark):
    one = spark.createDataFrame([(0.5, 1), (0.5, 0), (None, 1)], "score double, y int")
    assert sorted(tuple(r) for r in metrics.roc_curve(one).collect()) == [(0, None, 0.0, 0.0), (1, 0.5, 1.0, 1.0)]
    assert [r["idx"] for r in metrics.roc_curve(one.limit(0)).collect()] == [0]


def test_correlations_of_many_columns(spark):
    """200 columns with gaps, a constant column, one constant where another has values, a copy, an empty and a distant one."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 200))
    x[:, 1] = 4.0
    x[:, 2] = 2 * x[:, 0]
    x[:, 3] = np.nan
    x[:, 4] += 1e9
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:150, 5], x[150:, 6], x[150:, 5] = np.nan, np.nan, 7.5
    x[150:160, 6] = rng.normal(size=10)
    names = [f"x{i}" for i in range(200)]
    pdf = pd.DataFrame(x, columns=names)
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"{n} double" for n in names))
    out = profile.correlation_matrix(df, names, decimals=None)
    assert "Generate" not in plan(out)
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in out.collect()}
    assert len(got) == 200 * 200
    want = pdf.corr(min_periods=2)
    for a in range(0, 200):
        for b in range(0, 200, 1 if a < 8 else 41):
            both = pdf[[names[a], names[b]]].dropna()
            flat = len(both) < 2 or (both.nunique() < 2).any()
            v = got[names[a], names[b]]
            assert (v is None) == flat, (a, b, v)
            if not flat:
                assert abs(v - want.iloc[a, b]) < 1e-6


def test_infinite_values_stay_in_their_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 1.0, float("inf")), (3.0, 5.0, None), (4.0, 4.0, 1.0)], "a double, b double, c double")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert abs(got["a", "b"] - np.corrcoef([1, 2, 3, 4], [2, 1, 5, 4])[0, 1]) < 1e-6
    assert math.isnan(got["a", "c"])


def test_forecast_with_a_whole_pipeline(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import MinMaxScaler, VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from strata.operators.forecast import LinearModel, SparkModelAdapter, forecast_recursive, stress_scenarios
    df = spark.range(60).selectExpr("id % 6 AS entity_id", "cast(2000 + id div 6 AS int) AS period", "id * 1.5D + id % 4 AS v",
                                    "(id - 6) * 1.5D + (id - 6) % 4 AS v_lag1", "id % 5 * 1.0D AS u", "'taken' AS prediction", "1 AS features")
    plain = VectorAssembler(inputCols=["v_lag1", "u"], outputCol="vec")
    train = df.drop("prediction", "features")
    one = Pipeline(stages=[plain, LinearRegression(featuresCol="vec", labelCol="v")]).fit(train)
    lr = one.stages[-1]
    linear = LinearModel(lr.intercept, dict(zip(["v_lag1", "u"], lr.coefficients.toArray())))
    rows = lambda d: sorted(tuple(r) for r in d.collect())
    want = rows(forecast_recursive(df, linear, 4, "v", {"v": 1}))
    close = lambda a, b: len(a) == len(b) and all(x[:3] == y[:3] and abs(x[3] - y[3]) < 1e-6 for x, y in zip(a, b))
    assert close(rows(forecast_recursive(df, SparkModelAdapter(one), 4, "v", {"v": 1})), want)
    assert close(rows(forecast_recursive(df, SparkModelAdapter(lr, ["v_lag1", "u"]), 4, "v", {"v": 1})), want)
    scaled = Pipeline(stages=[plain, MinMaxScaler(inputCol="vec", outputCol="features"),
                              LinearRegression(featuresCol="features", labelCol="v")])
    nested = Pipeline(stages=[scaled]).fit(train)
    assert SparkModelAdapter(nested).features == ["v_lag1", "u"]
    assert close(rows(forecast_recursive(df, SparkModelAdapter(nested), 4, "v", {"v": 1})), want)
    shocks = {"base": None, "hit": 9.0}
    run = lambda m: sorted((r[0], r[1], r[2], round(r[4], 6)) for r in stress_scenarios(
        df, m, shocks, 3, "v", "u", {}, "v_lag1").collect())
    assert run(SparkModelAdapter(nested)) == run(linear)
    with pytest.raises(ValueError, match="names of its features"):
        SparkModelAdapter(lr)
