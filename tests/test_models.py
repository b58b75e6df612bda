"""Models, search spaces and the training composition: values, not only rows."""
import math

import pytest
from pyspark.sql import functions as F

from strata.operators import models as m
from strata.operators.balance import knn_for_seeds
from strata.operators.split import grid_params, random_params, stratified_folds

# The search spaces of the reference: draws of (low, high) integers, (low, width) floats, and a grid.
LEAFWISE = {"n_estimators": ("randint", 100, 500), "learning_rate": ("uniform", 0.01, 0.1), "num_leaves": ("randint", 20, 50),
            "max_depth": ("randint", 10, 30), "reg_alpha": ("uniform", 0.1, 1.0), "reg_lambda": ("uniform", 0.1, 1.0)}
DEPTHWISE = {"n_estimators": ("randint", 100, 500), "learning_rate": ("uniform", 0.01, 0.1), "max_depth": ("randint", 3, 10),
             "gamma": ("uniform", 0, 0.5), "subsample": ("uniform", 0.7, 0.3), "colsample_bytree": ("uniform", 0.7, 0.3)}
ADDITIVE = {"outer_bags": ("randint", 8, 16), "inner_bags": ("randint", 0, 8), "learning_rate": ("uniform", 0.01, 0.1)}
FOREST = {"model__n_estimators": [100, 200], "model__max_depth": [10, 20, None], "model__min_samples_leaf": [1, 2, 4]}


@pytest.fixture(scope="module")
def rows(spark):
    x = (F.col("id") * 37 % 101).cast("double")
    return spark.range(240).select("id", x.alias("a"), (F.col("id") % 7).cast("double").alias("b"),
                                   (x + F.col("id") % 5 > 70).cast("int").alias("y")).cache()


def test_every_draw_has_a_mapping(spark):
    for kind, space in (("boosted", LEAFWISE), ("boosted", DEPTHWISE), ("additive", ADDITIVE)):
        for draw in random_params(space, 20):
            known, unmapped = m.spark_params(kind, draw)
            assert set(unmapped) <= set(m.UNMAPPED) and known.get("maxDepth", 1) <= m.MAX_DEPTH
    known, _ = m.spark_params("boosted", {"max_depth": 25, "num_leaves": 31})
    assert known == {"maxDepth": 5}
    for draw in grid_params(FOREST):
        known, unmapped = m.spark_params("forest", draw)
        assert not unmapped and known["numTrees"] in (100, 200) and known["maxDepth"] in (10, 20, 30)


def test_draws_of_each_space_train(rows):
    small = {"n_estimators": 3}
    for build, draw in ((m.train_boosted, random_params(LEAFWISE, 1)[0] | small | {"max_depth": 3}),
                        (m.train_boosted, random_params(DEPTHWISE, 1)[0] | small | {"max_depth": 3}),
                        (m.train_additive, random_params(ADDITIVE, 1)[0] | small)):
        model = build(rows, "y", ["a", "b"], draw)
        scored = m.score_batch(rows, model)
        assert scored.count() == 240 and scored.where("prediction = y").count() > 200
    forest = m.train_forest_regressor(rows, "a", ["y", "b"], grid_params(FOREST)[4] | {"model__n_estimators": 3, "model__max_depth": None})
    assert forest.stages[-1].getMaxDepth() == 30 and forest.stages[-1].getNumTrees == 3
    boosted = m.train_boosted_regressor(rows, "a", ["a"], {"n_estimators": 5})
    assert m.score_batch(rows, boosted).agg(F.avg(F.abs(F.col("prediction") - F.col("a")))).first()[0] < 10


def test_linear_and_importances(spark, rows):
    line = rows.withColumn("t", 3 * F.col("a") - 2 * F.col("b") + 5)
    fit = m.train_linear(line, "t", ["a", "b"]).stages[-1]
    assert abs(fit.coefficients[0] - 3) < 1e-6 and abs(fit.coefficients[1] + 2) < 1e-6 and abs(fit.intercept - 5) < 1e-5
    model = m.train_boosted(rows, "y", ["a", "b"], {"n_estimators": 4})
    imp = {r.feature: r.importance for r in m.feature_importance(model, ["a", "b"], spark).collect()}
    assert abs(sum(imp.values()) - 1) < 1e-9 and imp["a"] > imp["b"]
    drop = {r.feature: r.importance for r in m.permutation_importance(rows, model, ["a", "b"], "y", "id").collect()}
    assert drop["a"] > 0.2 > abs(drop["b"])
    mlp = m.train_mlp(rows, "y", ["a", "b"], hidden=(4, 3), max_iter=5)
    assert list(mlp.stages[-1].getLayers()) == [2, 4, 3, 2]


def test_stump_attributions_add_up_to_the_margin(rows):
    model = m.train_additive(rows, "y", ["a", "b"], {"n_estimators": 6})
    attr = m.stump_attributions(rows, model, ["a", "b"], ["id"]).groupBy("id").agg(F.sum("contribution").alias("c"))
    from pyspark.ml.functions import vector_to_array
    margin = model.transform(rows).select("id", vector_to_array("rawPrediction")[1].alias("m"))
    both = attr.join(margin, "id").select((F.col("m") / 2 - F.col("c")).alias("d")).agg(F.min("d"), F.max("d")).first()
    scale = abs(both[1] - both[0])
    other = attr.join(margin, "id").select((F.col("m") - F.col("c")).alias("d")).agg(F.min("d"), F.max("d")).first()
    assert min(scale, abs(other[1] - other[0])) < 1e-9  # equal up to the mean


def test_tune_prefers_the_better_map(rows):
    folded = stratified_folds(rows, "y", "id", 3)
    model, scores = m.tune(folded, "y", ["a", "b"], "xgb", [{"n_estimators": 1, "max_depth": 1}, {"n_estimators": 5, "num_leaves": 16}], "fold")
    assert len(scores) == 2 and scores[1] >= scores[0] > 0.8 and model.transform(rows).count() == 240


def test_neighbours_in_many_dimensions(spark):
    """Exact against brute force although only a few columns are gridded."""
    import random
    rng = random.Random(8)
    for d in (6, 13):
        pts = [(i, *[rng.gauss(0, 1 + j) if i % 3 else 0.01 * rng.random() for j in range(d)]) for i in range(150)]
        cols = [f"x{j}" for j in range(d)]
        df = spark.createDataFrame(pts, "k long, " + ", ".join(f"{c} double" for c in cols))
        seeds = df.where("k % 29 = 0").withColumn("_pos", F.col("k"))
        got = {(r["_pos"], r["_rnk"]): tuple(r[f"n_{c}"] for c in cols) for r in knn_for_seeds(df, seeds, cols, "k", 3).collect()}
        for s in pts[::29]:
            ranked = sorted((p for p in pts if p[0] != s[0]), key=lambda p: (math.dist(p[1:], s[1:]), p[0]))
            assert all(got[s[0], r + 1] == ranked[r][1:] for r in range(3))


def test_training_records_its_run(spark, rows, tmp_shared):
    from strata.operators.workflow import train_pipeline
    res = train_pipeline(rows, "y", ["a", "b"], "id", param_maps=[{"n_estimators": 2, "max_depth": 2}], folds=3,
                         registry_root=tmp_shared)
    run = {r.key: r.value for r in res.metrics.where("kind = 'run'").collect()}
    assert run["param_max_depth"] == 2 and run["rows_after_0"] == run["rows_after_1"] >= run["rows_before_1"]
    assert abs(run["best_cv_auc"] - res.cv_scores[0]) < 1e-12 and run["best_cv_auc"] > 0.8 and run["positive_weight"] > 0
    assert res.version == 1


def test_halving_drops_the_worst_first(spark):
    from strata.operators.models import BOOSTED_SPACE, tune_halving
    from strata.operators.split import random_params
    df = spark.range(300).selectExpr("id % 3 AS fold", "IF(id * 37 % 100 > 50, 1, 0) AS y", "id * 37 % 100 * 1.0D AS x", "id % 7 * 1.0D AS z")
    # a map that may not split at all scores 0.5 and goes first
    maps = [{"max_depth": 2, "n_estimators": 5}, {"max_depth": 2, "n_estimators": 3, "gamma": 1e9}, {"max_depth": 1, "n_estimators": 1}]
    best, history = tune_halving(df, "y", ["x", "z"], maps, "fold", trees=1, times=2, rungs=3)
    assert [(r, i, n) for r, i, n, _ in history][:3] == [(0, 0, 1), (0, 1, 1), (0, 2, 1)]
    assert len(history) == 3 + 2 and {i for r, i, _, _ in history if r == 1} == {0, 2}
    assert {(i, n) for r, i, n, _ in history if r == 1} == {(0, 2), (2, 1)}  # never more trees than the map's own
    assert best in (maps[0], maps[2]) and dict((i, s) for r, i, _, s in history if r == 0)[1] == 0.5
    draws = random_params(BOOSTED_SPACE, 50, 1)
    assert all(100 <= d["n_estimators"] < 500 and 3 <= d["max_depth"] < 10 and 0.01 <= d["learning_rate"] <= 0.11 for d in draws)


def test_expanding_search_scores_later_blocks(spark):
    """The mean over folds of R squared on the next block, fold by fold, and the best map refitted on all rows."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from strata.operators.models import train_forest_regressor, tune_expanding
    from strata.operators.split import expanding_folds
    df = spark.range(400).selectExpr("cast(2000 + id % 8 AS int) AS period", "id % 50 * 2.0D AS x", "(id % 50) * (id % 50) * 1.0D AS y")
    folds = expanding_folds(df, "period", 3)
    maps = [{"n_estimators": 3, "max_depth": 1}, {"n_estimators": 3, "max_depth": 5}]
    model, scores = tune_expanding(df, "y", ["x"], maps, folds)
    ev = RegressionEvaluator(labelCol="y", predictionCol="prediction", metricName="r2")
    for i, pm in enumerate(maps):
        each = []
        for f in range(3):
            past = df.where(F.col("period") < 2002 + 2 * f)
            block = df.where(F.col("period").between(2002 + 2 * f, 2003 + 2 * f))
            each.append(ev.evaluate(train_forest_regressor(past, "y", ["x"], pm, seed=42).transform(block)))
        assert abs(scores[i][1] - sum(each) / 3) < 0.05
    assert scores[1][1] > scores[0][1] and model.stages[-1].getMaxDepth() == 5


def test_top_importances(spark):
    from strata.operators.topk import top_importances
    df = spark.createDataFrame([("b", 0.2), ("a", 0.2), ("c", 0.5), ("d", 0.0), ("e", 0.1)], "feature string, importance double")
    assert [tuple(r) for r in top_importances(df, 3).collect()] == [("c", 0.5), ("a", 0.2), ("b", 0.2)]
    assert len(top_importances(df, 50).collect()) == 5
