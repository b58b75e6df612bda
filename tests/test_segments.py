"""Segmented fills and lags of large entities equal the windows; no task holds a large entity."""
import pytest
from pyspark.sql import functions as F

from strata.functions.stats import global_index
from strata.operators import features, impute, segments


@pytest.fixture(scope="module")
def panel(spark):
    """Half the rows without an entity, a sixth of one entity; long gaps, a column without values, one null period each."""
    return spark.range(0, 4000, 1, 8).selectExpr(
        "CASE WHEN id % 2 = 0 THEN NULL WHEN id % 3 = 0 THEN 7 ELSE id % 40 END AS entity_id",
        "IF(id IN (500, 501, 505), NULL, cast((id * 7919) % 4001 AS int)) AS period",
        "IF(id % 5 < 3, NULL, cast(hash(id) AS double)) AS a", "IF((id * 7919) % 4001 BETWEEN 300 AND 3500, NULL, id * 1.5D) AS b",
        "IF(id % 2 = 0, NULL, cast(id AS double)) AS c", "id AS d")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("null_entity", ["reset", "keep"])
@pytest.mark.parametrize("fill", [impute.interpolate_linear, impute.forward_fill, impute.backward_fill])
def test_fills_of_large_entities(panel, fill, null_entity):
    want = rows(fill(panel, ["a", "b", "c"], null_entity=null_entity))
    assert rows(fill(panel, ["a", "b", "c"], null_entity=null_entity, hot_rows=100)) == want
    assert rows(fill(panel, ["a", "b", "c"], null_entity=null_entity, hot_rows=5000)) == want


@pytest.mark.parametrize("null_entity", ["reset", "keep"])
def test_lags_of_large_entities(panel, null_entity):
    want = rows(features.lag_features(panel, ["a", "d"], [1, 3], null_entity=null_entity))
    assert rows(features.lag_features(panel, ["a", "d"], [1, 3], null_entity=null_entity, hot_rows=100)) == want


def test_impute_panel_with_large_entities(panel):
    want = rows(impute.impute_panel(panel, cols=["a", "b", "c"], null_entity="keep"))
    assert rows(impute.impute_panel(panel, cols=["a", "b", "c"], null_entity="keep", hot_rows=50)) == want


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(1, 1, "x", 5), (1, 2, None, None)], "entity_id int, period int, s string, n int")
    out = impute.forward_fill(df, ["n"], hot_rows=1)
    assert out.columns == df.columns and rows(out) == [(1, 1, "x", 5), (1, 2, None, 5)]


def test_no_range_holds_a_large_entity(panel):
    hot = segments.split_hot(panel, "entity_id", "keep", 100)[1]
    assert hot.groupBy("entity_id").count().count() == 2
    placed = segments._placed(hot, "entity_id", "period")
    sizes = [r["count"] for r in placed.groupBy("_range").count().collect()]
    assert placed.where("entity_id IS NULL").select("_range").distinct().count() >= len(sizes) / 2
    assert len(sizes) == 1 or max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_many_ranges_share_an_entity(spark, panel):
    """With as many ranges as Spark is given, whatever their size."""
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = segments._placed(panel, "entity_id", "period")
        per = {r["_range"]: r["count"] for r in placed.groupBy("_range").count().collect()}
        assert len(per) >= 6 and max(per.values()) < 2 * 4000 / len(per)
        assert rows(segments.fill(panel, ["a", "b"], "entity_id", "period", "linear")) == rows(
            impute.interpolate_linear(panel, ["a", "b"], null_entity="keep"))
        assert rows(segments.lags(panel, ["d"], [1, 200], "entity_id", "period")) == rows(
            features.lag_features(panel, ["d"], [1, 200], null_entity="keep"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)


def test_positions_take_one_shuffle_and_no_window(spark):
    df = global_index(spark.range(1000).withColumn("u", F.hash("id")), ["u", "id"])
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Window") == 1 and "Window [" in text  # over one row a range only
    assert sorted(r["_gidx"] for r in df.collect()) == list(range(1000))
