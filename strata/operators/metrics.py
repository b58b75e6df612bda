"""Evaluation: prediction counts, KPIs, confusion, classification report, regression metrics,
ROC curve and AUC, and the long metrics record (D16-D20, E6, E7, A4).

The confusion table has one row per (label, prediction) pair, so everything after it runs
on a tiny table.  ROC and AUC need running totals in score order: scores are first
pre-aggregated per distinct value, then the global running sums come from the K2 helper.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import prefix_sums


def prediction_counts(df: DataFrame, col: str = "prediction") -> DataFrame:
    """Rows per predicted value."""
    return df.groupBy(col).count()


def kpis(data: DataFrame, predictions: DataFrame, entity: str = "entity_id") -> DataFrame:
    """Header totals: rows and distinct entities of the data, rows of the predictions."""
    d = data.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(entity).alias("entity_count"))
    p = predictions.agg(F.count(F.lit(1)).alias("prediction_count"))
    return d.crossJoin(p)


def confusion_counts(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Rows per (label, prediction)."""
    return df.groupBy(F.col(y).alias("y"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Per class precision, recall, F1 and support; macro and support-weighted averages;
    accuracy (as its own row, in ``f1_score``).  An undefined ratio is 0."""
    conf = confusion_counts(df, y, pred)
    classes = conf.select(F.col("y").alias("label")).union(conf.select(F.col("pred").alias("label"))).distinct()
    tp = conf.where(F.col("y") == F.col("pred")).select(F.col("y").alias("label"), F.col("n").alias("tp"))
    sup = conf.groupBy(F.col("y").alias("label")).agg(F.sum("n").alias("support"))
    prd = conf.groupBy(F.col("pred").alias("label")).agg(F.sum("n").alias("predicted"))
    per = (classes.join(tp, "label", "left").join(sup, "label", "left").join(prd, "label", "left")
           .na.fill(0, ["tp", "support", "predicted"]))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    per = per.select(F.col("label").cast("string").alias("label"), prec.alias("precision"), rec.alias("recall"),
                     F.col("support").cast("double").alias("support"), "tp")
    per = per.withColumn("f1_score", F.when(F.col("precision") + F.col("recall") > 0,
                                            2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                         .otherwise(F.lit(0.0)))
    tot = per.agg(F.sum("support").alias("total"), F.sum("tp").alias("correct"), F.count(F.lit(1)).alias("k"),
                  *[F.sum(m).alias(f"s_{m}") for m in ("precision", "recall", "f1_score")],
                  *[F.sum(F.col(m) * F.col("support")).alias(f"w_{m}") for m in ("precision", "recall", "f1_score")])
    macro = tot.select(F.lit("macro avg").alias("label"),
                       *[(F.col(f"s_{m}") / F.col("k")).alias(m) for m in ("precision", "recall", "f1_score")],
                       F.col("total").alias("support"))
    weighted = tot.select(F.lit("weighted avg").alias("label"),
                          *[F.when(F.col("total") > 0, F.col(f"w_{m}") / F.col("total")).otherwise(F.lit(0.0)).alias(m)
                            for m in ("precision", "recall", "f1_score")],
                          F.col("total").alias("support"))
    acc = tot.select(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"),
                     F.when(F.col("total") > 0, F.col("correct") / F.col("total")).otherwise(F.lit(0.0)).alias("f1_score"),
                     F.col("total").alias("support"))
    cols = ["label", "precision", "recall", "f1_score", "support"]
    return per.select(*cols).unionByName(macro.select(*cols)).unionByName(weighted.select(*cols)) \
              .unionByName(acc.select(*cols))


def regression_metrics(df: DataFrame, y: str = "y", pred: str = "prediction") -> DataFrame:
    """R^2, MAE and RMSE in one aggregate.  A constant target has R^2 1 if it is met exactly, else 0."""
    err = F.col(y) - F.col(pred)
    mse, spread = F.avg(err * err), F.var_pop(y)
    r2 = F.when(spread == 0, F.when(mse == 0, 1.0).otherwise(0.0)).otherwise(1 - F.try_divide(mse, spread))
    return df.agg(r2.alias("r2"),
                  F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"))


def _score_totals(df: DataFrame, y: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score (pre-aggregation before any ordering)."""
    return (df.where(F.col(score).isNotNull())
            .groupBy(F.col(score).alias("threshold"))
            .agg(F.sum(F.col(y).cast("long")).alias("tp"), F.sum((1 - F.col(y)).cast("long")).alias("fp")))


def roc_points(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """Cumulative true/false positives at every distinct score, descending (K2 running sums)."""
    totals = _score_totals(df, y, score)
    return prefix_sums(totals, ["threshold"], ["tp", "fp"], descending=True)


def roc_curve(df: DataFrame, y: str = "y", score: str = "score", drop_intermediate: bool = True) -> DataFrame:
    """(idx, threshold, fpr, tpr) at each distinct score from high to low, starting at the
    origin (idx 0, threshold null).  ``drop_intermediate`` removes points that are collinear
    with both neighbours (second difference of both counts is 0), as scikit-learn does.

    The step to a point is its score's own counts, and the step after it those of the next lower score, which in
    ascending order is the row before: one pass in that order gives sums and steps, without a self-join.
    """
    totals = _score_totals(df, y, score)
    pts = prefix_sums(totals, ["threshold"], ["tp", "fp"], previous="next_")
    n = pts.agg(F.sum("tp").alias("P"), F.sum("fp").alias("N"), F.count(F.lit(1)).alias("_scores"))  # one row
    pts = pts.crossJoin(F.broadcast(n)).withColumn("i", F.col("_scores") - 1 - F.col("_gidx"))
    if drop_intermediate:
        pts = pts.where((F.col("i") == 0) | (F.col("i") == F.col("_scores") - 1)
                        | (F.col("next_tp") != F.col("tp")) | (F.col("next_fp") != F.col("fp")))
    ctp, cfp = F.col("P") - F.col("cum_tp") + F.col("tp"), F.col("N") - F.col("cum_fp") + F.col("fp")
    rate = lambda c, of: F.try_divide(c.cast("double"), F.col(of))
    points = pts.select((F.col("i") + 1).alias("idx"), F.col("threshold").cast("double").alias("threshold"),
                        rate(cfp, "N").alias("fpr"), rate(ctp, "P").alias("tpr"))
    origin = n.select(F.lit(0).cast("long").alias("idx"), F.lit(None).cast("double").alias("threshold"),
                      rate(F.lit(0), "N").alias("fpr"), rate(F.lit(0), "P").alias("tpr"))
    return origin.unionByName(points)


def roc_auc(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """Area under the ROC curve = sum over scores of fp * (tp above + tp tied / 2) / (P * N)."""
    pts = roc_points(df, y, score)
    return pts.agg(F.try_divide(F.sum(F.col("fp").cast("double") * (F.col("cum_tp").cast("double") - F.col("tp") / 2.0)),
                                F.sum("tp").cast("double") * F.sum("fp").cast("double")).alias("auc"))


def metrics_long(metrics: DataFrame, run_id: str, model: str, kind: str = "metric") -> DataFrame:
    """A4: a wide metrics table (one row, or one row per label with a ``label`` column) in long
    form (run_id, model, kind, key, value) – the shape appended to the metrics store."""
    value_cols = [c for c, t in metrics.dtypes if c != "label" and t in ("double", "float", "int", "bigint")]
    if "label" in metrics.columns:
        m = metrics.select(F.col("label").cast("string").alias("label"), *[F.col(c).cast("double") for c in value_cols])
        long = m.unpivot(["label"], value_cols, "metric", "value")
        key = F.concat_ws("_", F.col("label"), F.col("metric"))
    else:
        m = metrics.select(*[F.col(c).cast("double") for c in value_cols])
        long = m.unpivot([], value_cols, "metric", "value")
        key = F.col("metric")
    return long.where(F.col("value").isNotNull()).select(
        F.lit(run_id).alias("run_id"), F.lit(model).alias("model"), F.lit(kind).alias("kind"),
        key.alias("key"), "value")


def sink_metrics_json(report: DataFrame, path: str) -> str:
    """A4: JSON report (one line per record) next to the long metrics table."""
    report.coalesce(1).write.mode("overwrite").json(path)
    return path
