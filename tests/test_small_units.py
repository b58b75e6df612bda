"""T-only rows of the inventory: schema helpers, search spaces, seeds, reports, clusters."""
import json
import os

import pytest
from pyspark.sql import functions as F

from strata.functions.exprs import numeric_columns
from strata.operators import profile
from strata.operators.split import grid_params, random_params, set_seeds


def test_numeric_columns_excludes_period_and_booleans(spark):
    df = spark.createDataFrame([(1, 2.0, True, "x", 2020)], "a long, b double, c boolean, d string, year int")
    assert numeric_columns(df, exclude=["year"]) == ["a", "b"]


def test_random_params_reproducible_and_in_range():
    space = {"n_estimators": ("randint", 100, 500), "learning_rate": ("uniform", 0.01, 0.1),
             "booster": ["gbtree", "dart"]}
    a, b = random_params(space, 20, 42), random_params(space, 20, 42)
    assert a == b and len(a) == 20
    assert all(100 <= d["n_estimators"] < 500 and 0.01 <= d["learning_rate"] < 0.11 for d in a)
    assert random_params(space, 5, 1) != random_params(space, 5, 2)


def test_grid_params_is_cartesian():
    g = grid_params({"n_estimators": [100, 200], "max_depth": [10, 20, None], "min_samples_leaf": [1, 2, 4]})
    assert len(g) == 18 and g[0] == {"n_estimators": 100, "max_depth": 10, "min_samples_leaf": 1}


def test_set_seeds_repeats_driver_draws():
    import random
    set_seeds(3)
    a = random.random()
    set_seeds(3)
    assert random.random() == a


def test_assert_complete(spark):
    ok = spark.createDataFrame([(1, 2.0)], "a int, b double")
    profile.assert_complete(ok)
    with pytest.raises(AssertionError):
        profile.assert_complete(spark.createDataFrame([(1, None)], "a int, b double"))


def test_nullity_clusters_merge_order(spark):
    df = spark.createDataFrame([(None, None, 1.0, 1.0), (1.0, 1.0, None, 2.0), (None, None, 1.0, None)],
                               "a double, b double, c double, d double")
    merges = profile.nullity_clusters(profile.nullity_distance(df))
    assert merges[0][:2] == ("a", "b") and merges[0][2] == 0.0 and merges[-1][3] == 4


def test_null_target_count_absent_column_warns(spark):
    assert profile.null_target_count(spark.range(2), "target") is None


def test_metrics_json_report(spark, tmp_shared):
    from strata.operators.metrics import metrics_long, regression_metrics, sink_metrics_json
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.5)], "y double, prediction double")
    m = regression_metrics(df)
    long = metrics_long(m, "run1", "linear")
    assert sorted(r["key"] for r in long.collect()) == ["mae", "r2", "rmse"]
    sink_metrics_json(m, tmp_shared)
    files = [f for f in os.listdir(tmp_shared.replace("file:", "")) if f.endswith(".json")]
    rec = json.loads(open(os.path.join(tmp_shared.replace("file:", ""), files[0])).readline())
    assert set(rec) == {"r2", "mae", "rmse"}


def test_one_hot_vector_form(spark):
    from strata.operators.features import one_hot_vector
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "t string")
    _, out = one_hot_vector(df, "t")
    assert [r["t_vec"].toArray().tolist() for r in out.collect()] == [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [1.0, 0.0, 0.0]]


def test_cleaning_report_counts_null_entity_once(spark):
    df = spark.createDataFrame([(None, 1, 1.0), (None, 2, 1.0), ("a", 1, None)], "entity_id string, period int, x double")
    rep = profile.cleaning_report(df, df.where("entity_id IS NULL"), "entity_id", []).first()
    assert rep["entities_before"] == 2 and rep["entities_after"] == 1 and rep["removed_years"] == "none"


def test_clean_panel_none_passthrough():
    from strata.operators.clean import clean_panel
    assert clean_panel(None, "x", "e") is None


def test_score_records_unknown_model(spark):
    from strata.operators.models import score_records
    with pytest.raises(KeyError):
        score_records(spark.range(1), {}, "xgb", ["a"])


def test_recommended_conf_scales_with_input():
    from strata.session import recommended_conf
    big = recommended_conf(100 * 1024 ** 4, 8000)
    small = recommended_conf(10 * 1024 ** 2, 8)
    assert int(big["spark.sql.shuffle.partitions"]) == 819200
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 256 * 1024 ** 2


def test_period_bound_is_enforced(spark, monkeypatch):
    from strata.sources import fixtures as fx
    monkeypatch.setattr(fx, "MAX_PERIODS", 2)
    with pytest.raises(Exception, match="distinct periods"):
        fx.panel(spark, "/root/testdata/sf0.001").count()


def test_rounding_is_identical_in_spark_and_sql(spark):
    import duckdb
    from strata.functions.exprs import fround
    from strata.plans.sqlgen import fround_sql, rewrite_round_sql
    vals = [470186.02325, 0.145, 123.455, -2.675, 1.005, 2.5, -0.5, 1e17, float("inf"), None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for d in (2, 4, 6):
        ours = [r[0] for r in df.select(fround("x", d)).collect()]
        con = duckdb.connect()
        sql = ", ".join(f"({'NULL' if v is None else repr(v) if v != float('inf') else chr(39) + 'inf' + chr(39)}::DOUBLE)"
                        for v in vals)
        theirs = [r[0] for r in con.execute(f"SELECT {fround_sql('x', d)} FROM (VALUES {sql}) t(x)").fetchall()]
        assert ours == theirs
    assert rewrite_round_sql("SELECT round(a, 0), 'round(b, 2)' AS s") == "SELECT round(a, 0), 'round(b, 2)' AS s"


def test_halves_round_to_even(spark):
    """As numpy does on the scaled value: 0.125 to two decimals is 0.12."""
    import numpy as np
    from strata.functions.exprs import fround
    vals = [0.125, 0.375, -0.125, 2.5, 0.5, 1.5, 12.345, 1 / 3, 1e16 + 2]
    got = spark.createDataFrame([(v,) for v in vals], "x double").select(fround("x", 2).alias("a"), fround("x", 0).alias("b")).collect()
    assert [r["a"] for r in got] == [float(np.round(v, 2)) for v in vals] and got[0]["a"] == 0.12
    assert [r["b"] for r in got] == [float(np.round(v)) for v in vals]


def test_stratified_split_rejects_a_one_row_class(spark):
    from strata.operators.split import stratified_split
    df = spark.createDataFrame([(i, 0) for i in range(5)] + [(9, 1)], "k long, y int")
    with pytest.raises(Exception, match="fewer than 2 rows"):
        stratified_split(df, "y", "k").collect()
