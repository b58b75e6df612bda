"""One test per semantic rule (pandas/scikit-learn behaviour reproduced on literal rows)."""
import math

import pytest
from pyspark.sql import functions as F

from strata.functions.exprs import coerce_double, safe_corr
from strata.functions.stats import column_medians
from strata.operators import clean, features, impute, joins, profile

PANEL_SCHEMA = "entity_id string, period int, x double"


def rows(df, order=("entity_id", "period")):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_s1_interpolation_is_by_position_not_period(spark):
    df = spark.createDataFrame([("a", 2000, 1.0), ("a", 2001, None), ("a", 2010, 4.0)], PANEL_SCHEMA)
    out = impute.interpolate_linear(df, ["x"])
    assert [r[2] for r in rows(out)] == [1.0, 2.5, 4.0]


def test_s2_edges_nearest_and_all_null_group_stays_null(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 3.0), ("a", 3, None), ("a", 4, 5.0), ("a", 5, None),
                                ("b", 1, None), ("b", 2, None)], PANEL_SCHEMA)
    out = rows(impute.interpolate_linear(df, ["x"]))
    assert [r[2] for r in out] == [3.0, 3.0, 4.0, 5.0, 5.0, None, None]


def test_s3_null_entity_reset_then_median(spark):
    df = spark.createDataFrame([(None, 1, 10.0), ("a", 1, 1.0), ("a", 2, None), ("b", 1, 3.0)], PANEL_SCHEMA)
    out = impute.impute_panel(df, cols=["x"])
    got = {(r["entity_id"], r["period"]): r["x"] for r in out.collect()}
    # the null-key row lost its value in the group transform; median of [1, 1, 3] = 1
    assert got[(None, 1)] == 1.0 and got[("a", 2)] == 1.0
    kept = impute.impute_panel(df, cols=["x"], null_entity="keep")
    assert {(r["entity_id"], r["period"]): r["x"] for r in kept.collect()}[(None, 1)] == 10.0


def test_s4_not_in_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1, None), ("a", 1, None), ("a", 2, None), ("b", 1, 1.0)], PANEL_SCHEMA)
    out = clean.drop_sparse_entities(df, "x", "entity_id", 0.5)
    assert sorted((r[0] or "") for r in out.collect()) == ["", "b"]
    out2 = clean.drop_periods(spark.createDataFrame([("a", None, 1.0), ("a", 1, 1.0), ("a", 2, 1.0)], PANEL_SCHEMA), [1])
    assert sorted(str(r[1]) for r in out2.collect()) == ["2", "None"]


def test_s5_merge_matches_null_with_null(spark):
    raw = spark.createDataFrame([(None, 1, 1.0), ("a", 1, 2.0)], PANEL_SCHEMA)
    tgt = spark.createDataFrame([(None, 1, 7.9), ("a", 1, None)], "entity_id string, period int, target double")
    out = joins.merge_target(raw, tgt).collect()
    assert [(r["entity_id"], r["target"]) for r in out] == [(None, 7)]


@pytest.mark.parametrize("text,expected", [
    ("1e3", 1000.0), (" 1 ", 1.0), ("inf", math.inf), (".5", 0.5), ("1,000", None), ("0x10", None),
    ("True", None), ("1d", None), ("2F ", None), ("", None), ("n/a", None)])
def test_s6_coercion_like_to_numeric(spark, text, expected):
    v = spark.createDataFrame([(text,)], "s string").select(coerce_double("s").alias("v")).first()["v"]
    assert v == expected


def test_s7_median_averages_middle_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    assert column_medians(df, ["x"]).first()["x"] == 2.5
    assert column_medians(df.limit(0), ["x"]).first()["x"] is None


def test_s8_population_sd_and_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    out = features.standard_scale(df, ["a", "b"]).orderBy("a").collect()
    assert [r["a"] for r in out] == [-1.0, 1.0] and [r["b"] for r in out] == [0.0, 0.0]


def test_s9_corr_of_constant_is_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 5.0, None), (3.0, 5.0, 3.0)], "a double, b double, c double")
    r = df.agg(safe_corr("a", "b").alias("ab"), safe_corr("a", "c").alias("ac")).first()
    assert r["ab"] is None and abs(r["ac"] - 1.0) < 1e-12


def test_s10_s11_constant_detection(spark):
    df = spark.createDataFrame([(0.1, 1.0, 2.0), (0.1, 2.0, 2.0), (0.1, 3.0, None)], "a double, b double, c double")
    got = sorted(r[0] for r in profile.zero_variance_columns(df).collect())
    assert got == ["a", "c"]
    one = spark.createDataFrame([(1.0,)], "z double")
    assert profile.zero_variance_columns(one).count() == 0


def test_s13_duplicates_count_beyond_first_with_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x")], "a int, b string")
    assert profile.duplicate_rows(df).first()[0] == 2


def test_s16_positive_weight_without_positives(spark):
    df = spark.createDataFrame([(0,), (0,)], "y int")
    assert profile.positive_weight(df, "y").first()["pos_weight"] == 1.0


def test_s17_class_shares_ignore_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (0,), (None,)], "y int")
    got = {r["y"]: r["share"] for r in profile.class_distribution(df, "y").collect()}
    assert got == {1: 2 / 3, 0: 1 / 3}


def test_label_rules_differ_at_cut(spark):
    df = spark.createDataFrame([("a", 1, 90.0), ("b", 1, None), ("c", 1, 95.0), ("d", 1, 10.0)], PANEL_SCHEMA)
    lt = {r["entity_id"]: r["label"] for r in clean.label_strict_lt(df, "x", 90).collect()}
    gt = {r["entity_id"]: r["label"] for r in clean.label_strict_gt(df, "x", 90).collect()}
    assert lt == {"a": 0, "b": 0, "c": 0, "d": 1}     # median 90 fills b
    assert gt == {"a": 1, "b": 1, "c": 0, "d": 1}


def test_sanitize_names_and_collision(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "`Public Debt (% of GDP)` double, `GDP Growth (% Annual)` double")
    assert clean.sanitize_names(df).columns == ["Public_Debt_of_GDP_", "GDP_Growth_Annual_"]
    bad = spark.createDataFrame([(1.0, 2.0)], "`a b` double, `a-b` double")
    with pytest.raises(ValueError):
        clean.sanitize_names(bad)


def test_quantize_clamps(spark):
    from strata.functions.exprs import quantize
    df = spark.createDataFrame([(-0.5,), (0.0,), (0.5,), (1.0,), (None,)], "s double")
    assert [r[0] for r in df.select(quantize("s")).collect()] == [0, 0, 4, 8, None]


def test_null_entities_do_not_share_a_window_group(spark):
    # a third of the rows without an entity: they get no fill and no lag, and the window
    # groups them by row hash instead of one big null group
    rows_ = [(None, p, float(p)) for p in range(30)] + [("a", p, None if p % 2 else float(p)) for p in range(60)]
    df = spark.createDataFrame(rows_, PANEL_SCHEMA)
    out = impute.interpolate_linear(df, ["x"])
    assert out.where("entity_id IS NULL AND x IS NOT NULL").count() == 0
    assert out.where("entity_id = 'a' AND x IS NULL").count() == 0
    lagged = features.lag_features(df, ["x"], [1])
    assert lagged.where("entity_id IS NULL AND x_lag1 IS NOT NULL").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64" in plan
