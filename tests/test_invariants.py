"""Invariants of the operators on the driver tables."""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from strata.functions.stats import column_quantiles, global_index, prefix_sums
from strata.sources import fixtures as fx


def test_impute_keeps_observed_cells_and_fills_all(spark):
    from strata.operators.impute import impute_panel
    p = fx.panel(spark, SF_SMALL)
    out = impute_panel(p, check=True)
    cols = ["units", "spend", "disc_pct", "thin"]
    j = p.alias("a").join(out.alias("b"), ["entity_id", "period"])
    changed = j.where(" OR ".join(f"(a.{c} IS NOT NULL AND a.{c} <> b.{c})" for c in cols)).count()
    assert changed == 0
    assert out.where(" OR ".join(f"{c} IS NULL" for c in cols)).count() == 0


def test_split_disjoint_complete_and_exact_share(spark):
    from strata.operators.split import stratified_split
    d = fx.doc_classes(spark, SF_MID)
    s = stratified_split(d, "toxic", "doc_id", 0.2, 42)
    assert s.count() == d.count() and s.select("doc_id").distinct().count() == d.count()
    got = {(r["toxic"], r["split"]): r["count"] for r in s.groupBy("toxic", "split").count().collect()}
    assert got[(0, "test")] == round(0.2 * 348) and got[(1, "test")] == round(0.2 * 51)
    again = stratified_split(d, "toxic", "doc_id", 0.2, 42)
    assert s.exceptAll(again).count() == 0


def test_folds_partition_rows(spark):
    from strata.operators.split import stratified_folds
    d = fx.doc_classes(spark, SF_MID)
    f = stratified_folds(d, "toxic", "doc_id", 5, 42)
    sizes = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert sum(sizes) == d.count() and max(sizes) - min(sizes) <= 2


def test_auc_matches_spark_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from strata.operators.metrics import roc_auc
    m = fx.scored(spark, SF_MID)
    ours = roc_auc(m).first()["auc"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y", numBins=0)
    ref = ev.evaluate(m.withColumn("y", F.col("y").cast("double")))
    assert abs(ours - ref) < 1e-9 and 0 <= ours <= 1
    assert round(ours, 6) == 0.498282


def test_smote_equalises_classes_and_stays_between_parents(spark):
    from strata.operators.balance import balance_counts, smote
    d = fx.doc_classes(spark, SF_SMALL)
    cols = ["n_chars", "n_words", "n_lines"]
    out = smote(d, "toxic", cols, "doc_id", k=5, seed=7)
    counts = {r["toxic"]: r["count"] for r in out.groupBy("toxic").count().collect()}
    assert counts[0] == counts[1]
    mins = d.where("toxic = 1").agg(*[F.min(c).alias(c) for c in cols]).first()
    maxs = d.where("toxic = 1").agg(*[F.max(c).alias(c) for c in cols]).first()
    syn = out.where("synthetic").collect()
    assert syn and all(mins[c] - 1e-9 <= r[c] <= maxs[c] + 1e-9 for r in syn for c in cols)
    bc = {r["toxic"]: (r["rows_before"], r["rows_after"]) for r in balance_counts(d, out, "toxic").collect()}
    assert bc[1][1] == bc[0][1]


def test_knn_is_exact_against_brute_force(spark):
    from strata.operators.balance import knn_for_seeds
    import random
    rnd = random.Random(3)
    pts = [(i, float(rnd.randint(0, 50)), float(rnd.expovariate(0.01))) for i in range(300)]
    df = spark.createDataFrame(pts, "k long, a double, b double")
    seeds = df.where("k % 7 = 0").withColumn("_pos", F.col("k"))
    got = {(r["_pos"], r["_rnk"]): (r["n_a"], r["n_b"]) for r in knn_for_seeds(df, seeds, ["a", "b"], "k", 4).collect()}
    for s in [p for p in pts if p[0] % 7 == 0]:
        ranked = sorted((p for p in pts if p[0] != s[0]), key=lambda p: ((p[1] - s[1]) ** 2 + (p[2] - s[2]) ** 2, p[0]))
        for r in range(4):
            assert got[(s[0], r + 1)] == (ranked[r][1], ranked[r][2])


def test_prefix_sums_equal_single_window(spark):
    df = spark.range(0, 2000).select((F.col("id") * 7919 % 2000).alias("k"), (F.col("id") % 13).alias("v"))
    ours = prefix_sums(df, ["k"], ["v"]).select("k", "_gidx", "cum_v")
    w = Window.orderBy("k")
    ref = df.select("k", (F.row_number().over(w) - 1).alias("_gidx"),
                    F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_v"))
    assert ours.exceptAll(ref).count() == 0 and ours.count() == 2000


def test_radix_quantiles_equal_exact(spark):
    df = spark.range(0, 5001).select(((F.col("id") * 37) % 1013 / 7.0).alias("x"), (F.col("id") % 5).cast("double").alias("y"))
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    exact = df.agg(*[F.percentile(c, F.lit(p)).alias(f"{c}__q{p}") for c in ("x", "y") for p in probs]).first().asDict()
    for stored in (False, True):
        got = column_quantiles(df, ["x", "y"], probs, stored).first().asDict()
        assert all(abs(exact[k] - got[k]) < 1e-9 for k in exact)
    few = column_quantiles(df.where("id < 3").withColumn("z", F.lit(None).cast("double")), ["x", "z"], [0.5, 0.9]).first()
    assert few["z__q0.5"] is None and few["x__q0.5"] is not None


def test_ordered_bits_keep_the_order_of_doubles():
    import numpy as np
    from strata.functions.stats import bits_value, ordered_bits
    values = [-np.inf, -1.7e308, -1.0, -5e-324, -0.0, 0.0, 5e-324, 0.1, 1.0, 1.7e308, np.inf, np.nan]
    keys = ordered_bits(np.array(values)).tolist()
    assert keys == sorted(keys) and keys[4] == keys[5] and len(set(keys)) == len(keys) - 1
    assert [bits_value(k) for k in keys[:-1]] == values[:-1] and np.isnan(bits_value(keys[-1]))


def test_order_statistics_by_all_passes(spark):
    """Values that share their upper bits, so that every pass counts; and with the last pass early."""
    from strata.functions.stats import order_statistics
    df = spark.range(3000).selectExpr("1.0D + (id * 7919 % 3000) * 1e-13D AS a", "-(id % 7) * 1e300D AS b")
    values = [sorted(r[c] for r in df.collect()) for c in ("a", "b")]
    wanted = {(0, 0), (0, 1234), (0, 2999), (1, 0), (1, 1500), (1, 2999)}
    for few in (0, 10, 10_000):
        got = order_statistics(df, ["a", "b"], wanted, few)
        assert got == {(i, r): values[i][r] + 0.0 for i, r in wanted}


def test_quantiles_of_odd_columns(spark):
    df = spark.sql("SELECT * FROM VALUES (cast('-Infinity' AS double), 1.0D, cast(null AS double)), (0.0D, 1.0D, null), "
                   "(-0.0D, null, null), (3.5D, 2.0D, null) AS t(a, b, c)")
    got = column_quantiles(df, ["a", "b", "c"], [0.0, 0.5, 1.0]).first()
    assert list(got) == [float("-inf"), 0.0, 3.5, 1.0, 1.0, 2.0, None, None, None]
    assert list(column_quantiles(df.limit(0), ["a"], [0.5]).first()) == [None]


def test_quantile_jobs_do_not_grow_with_columns(spark):
    def jobs(cols, probs):
        df = spark.range(0, 3000).select(*[((F.col("id") * (37 + i)) % 1013 / 7.0).alias(f"x{i}") for i in range(cols)])
        spark.sparkContext.setJobGroup(f"q{cols}-{len(probs)}", "")
        column_quantiles(df, df.columns, probs)
        got = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"q{cols}-{len(probs)}"))
        spark.sparkContext._jsc.clearJobGroup()
        return got

    few, many = jobs(1, [0.5]), jobs(6, [0.1, 0.25, 0.5, 0.75, 0.9])
    assert many <= few + 2 and many < 20


def test_stream_equals_batch(spark, tmp_shared):
    from strata.streaming.scoring import stream_score
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    rule = lambda df: df.select("user_id", "event_id", F.when(F.col("value") >= 50, 1.0).otherwise(0.0).alias("prediction"))
    out = stream_score(spark, SF_SMALL, schema, rule, f"{tmp_shared}/store", f"{tmp_shared}/ckpt",
                       path_glob="events.parquet")
    batch_users = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("user_id").distinct()
    assert out.count() == batch_users.count() == 15
    assert out.select("user_id").exceptAll(batch_users).count() == 0
    # a restart over the same input stores nothing twice
    again = stream_score(spark, SF_SMALL, schema, rule, f"{tmp_shared}/store", f"{tmp_shared}/ckpt",
                         path_glob="events.parquet")
    assert again.count() == 15


def test_forecast_alignments(spark):
    from strata.operators.forecast import LinearModel, forecast_recursive
    df = spark.createDataFrame([("a", 1, 10.0, None), ("a", 2, 20.0, 10.0)],
                               "entity_id string, period int, y double, y_lag1 double")
    m = LinearModel(1.0, {"y_lag1": 1.0})
    ref = [r["prediction"] for r in forecast_recursive(df, m, 3, "y", {"y": 1}).orderBy("step").collect()]
    assert ref == [11.0, 21.0, 12.0]          # predicts the last year's value first (X9)
    sh = [r["prediction"] for r in forecast_recursive(df, m, 3, "y", {"y": 1}, align="shifted").orderBy("step").collect()]
    assert sh == [21.0, 22.0, 23.0]


def test_expanding_folds_follow_time(spark):
    from strata.operators.split import expanding_folds
    p = fx.panel(spark, SF_SMALL)
    f = expanding_folds(p, "period", 5).collect()
    for fold in range(5):
        tr = [r["period"] for r in f if r["fold"] == fold and r["role"] == "train"]
        te = [r["period"] for r in f if r["fold"] == fold and r["role"] == "test"]
        assert te and max(tr) < min(te)


def test_knn_exact_with_a_hot_duplicate_group(spark):
    from strata.operators.balance import knn_for_seeds, thin_duplicates
    import random
    rnd = random.Random(5)
    pts = [(i, 10.0, 10.0) for i in range(400)]                                   # a third+ identical
    pts += [(400 + i, float(rnd.randint(0, 40)), float(rnd.randint(0, 40))) for i in range(600)]
    df = spark.createDataFrame(pts, "k long, a double, b double")
    assert thin_duplicates(df, ["a", "b"], "k", 4).where("a = 10.0 AND b = 10.0").count() <= 4 + 1
    seeds = df.where("k % 37 = 0").withColumn("_pos", F.col("k"))
    got = {(r["_pos"], r["_rnk"]): (r["n_a"], r["n_b"]) for r in knn_for_seeds(df, seeds, ["a", "b"], "k", 3).collect()}
    for s in [p for p in pts if p[0] % 37 == 0]:
        ranked = sorted((p for p in pts if p[0] != s[0]), key=lambda p: ((p[1] - s[1]) ** 2 + (p[2] - s[2]) ** 2, p[0]))
        for r in range(3):
            assert got[(s[0], r + 1)] == (ranked[r][1], ranked[r][2])


def test_stream_two_batches_store_each_key_once(spark, tmp_shared):
    from strata.streaming.scoring import stream_score
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = f"{tmp_shared}/incoming"
    # two arriving files: even event ids first, odd ones second (every user appears in both)
    ev.where("event_id % 2 = 0").coalesce(1).write.parquet(f"{src}/part=a")
    ev.where("event_id % 2 = 1").coalesce(1).write.parquet(f"{src}/part=b")
    rule = lambda df: df.select("user_id", "event_id", F.lit(1.0).alias("prediction"))
    out = stream_score(spark, src, ev.schema, rule, f"{tmp_shared}/store", f"{tmp_shared}/ckpt",
                       max_files_per_trigger=1)
    import os
    offsets = os.listdir(f"{tmp_shared}/ckpt/offsets".replace("file:", ""))
    assert len([o for o in offsets if o.isdigit()]) >= 2   # one micro-batch per file (+ a no-data batch)
    assert out.count() == out.select("user_id").distinct().count() == ev.select("user_id").distinct().count()


def test_stream_stores_late_records(spark, tmp_shared):
    """A key that first appears with an old event time, after newer ones were seen, is stored; the first file wins."""
    from strata.streaming.scoring import stream_score
    src = f"{tmp_shared}/late"
    files = [[(1, 10, "2024-01-02 00:00:00"), (2, 11, "2024-01-03 00:00:00"), (2, 9, "2024-01-03 00:00:00")],
             [(3, 12, "2024-06-01 00:00:00"), (None, 13, "2024-06-01 00:00:00")], [(4, 14, "2020-01-01 00:00:00"), (1, 8, "2020-01-01 00:00:00")]]
    for i, rows in enumerate(files):
        df = spark.createDataFrame(rows, "user_id int, event_id int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
        df.coalesce(1).write.parquet(f"{src}/f={i}")
        schema = df.schema
    out = stream_score(spark, src, schema, lambda d: d.select("user_id", "event_id"), f"{tmp_shared}/late-store",
                       f"{tmp_shared}/late-ckpt", tie="event_id", max_files_per_trigger=1)
    got = {(r.user_id, r.event_id) for r in out.collect()}
    assert {k for k, _ in got} == {1, 2, 3, 4, None} and len(got) == 5 and (2, 9) in got


def test_splits_keep_rows_without_a_label(spark):
    from strata.operators.split import stratified_folds, stratified_split
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i % 2) for i in range(40)], "k long, y int")
    exact = stratified_split(df, "y", "k", 0.25)
    assert exact.count() == 40 and exact.where("y IS NULL AND split = 'test'").count() == 2
    assert stratified_folds(df, "y", "k", 4).count() == 40


def test_shared_folder_is_required_on_a_cluster(monkeypatch):
    import pytest

    from strata import session

    class Context:
        master = "spark://host:7077"
        def getCheckpointDir(self):
            return None
        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_merge_target_grows_with_rows_not_pairs(spark):
    from strata.operators.joins import merge_target
    raw = spark.createDataFrame([(None, 1, float(i)) for i in range(50)], "entity_id string, period int, x double")
    tgt = spark.createDataFrame([(None, 1, 7.9 + i) for i in range(50)], "entity_id string, period int, target double")
    out = merge_target(raw, tgt)
    assert out.count() == 50 and {r.target for r in out.collect()} == {7}


def test_numbers_that_hold(spark):
    from strata.functions.exprs import quantize
    from strata.operators.features import one_hot
    from strata.operators.metrics import regression_metrics, roc_curve
    from strata.operators.profile import nullity_correlation
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (0.5,), (None,)], "x double")
    assert [r[0] for r in df.select(quantize("x")).collect()] == [8, 0, 4, None]
    flat = spark.createDataFrame([(2.0, 2.0), (2.0, 3.0)], "y double, prediction double")
    assert regression_metrics(flat).first()["r2"] == 0.0
    cats = one_hot(spark.createDataFrame([("a",), (None,)], "c string"), ["c"]).collect()
    assert sorted(r["c_a"] for r in cats) == [0, 1]
    scored = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, None)], "y int, score double")
    assert roc_curve(scored).agg(F.max("tpr")).first()[0] == 1.0
    many = spark.createDataFrame([(None, 1), (1, None), (None, None), (1, 1)], "a int, b int")
    assert nullity_correlation(many).where("col_a = 'a' AND col_b = 'b'").first()["corr"] == 0.0


def test_record_sink_appends_only_new_keys(spark, tmp_shared):
    from strata.sources import sink_predictions
    new = lambda ks: spark.createDataFrame([(k, 1.0, 2.0, 3.0, 4.0) for k in ks],
                                           "client_id string, income double, expenses double, debt double, assets double")
    path = f"{tmp_shared}/records"
    sink_predictions(spark, path, new(["a", "b", "b"]))
    first = spark.read.parquet(path).inputFiles()
    out = sink_predictions(spark, path, new(["b", "c"]))
    assert sorted((r.client_id, r.id) for r in out.collect()) == [("a", 1), ("b", 2), ("c", 3)]
    assert set(first) <= set(out.inputFiles())


def test_writers_at_the_same_time_get_distinct_ids(spark, tmp_shared):
    from concurrent.futures import ThreadPoolExecutor
    from strata.sources import sink_predictions
    from strata.sources.records import lease_ids
    path = f"{tmp_shared}/leased"
    new = lambda w: spark.createDataFrame([(f"{w}-{i}", 1.0, 2.0, 3.0, 4.0) for i in range(5)],
                                          "client_id string, income double, expenses double, debt double, assets double")
    sink_predictions(spark, path, new("first"))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda w: sink_predictions(spark, path, new(w)), range(4)))
    ids = [r.id for r in spark.read.parquet(path).collect()]
    assert len(ids) == 25 and len(set(ids)) == 25 and min(ids) == 1
    with ThreadPoolExecutor(6) as pool:
        tops = sorted(pool.map(lambda n: (lease_ids(spark, path, n), n), [3, 1, 4, 1, 5, 9]))
    assert all(a + n <= b for (a, n), (b, _) in zip(tops, tops[1:])) and tops[0][0] >= 25


def test_stream_reads_the_batch_s_buckets_only(spark, tmp_shared):
    from strata.streaming.scoring import of_buckets
    path = f"{tmp_shared}/buckets"
    spark.range(100).selectExpr("id AS k", "cast(id % 8 AS int) AS _bucket").write.partitionBy("_bucket").parquet(path)
    some = of_buckets(spark.read.parquet(path), [3, 1])
    text = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in text and "IN (1,3)" in text
    assert some.count() == 26
