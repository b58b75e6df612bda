"""The training composition (H15): split -> class weight -> median fill + scaling -> balancing
-> cross-validated search -> evaluation -> ROC -> importances -> versioned save.

By default each CV fold is scaled and balanced on its own training part (no synthetic rows
built from validation rows); ``reference_order=True`` scales and balances the whole training
set once before the search, as the reference did.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .balance import smote
from .features import fit_median_scaler
from .metrics import classification_report, metrics_long, roc_auc, roc_curve
from .models import MODEL_BUILDERS, feature_importance
from .profile import positive_weight
from .split import stratified_folds, stratified_split, train_test


@dataclass
class TrainResult:
    model: object
    metrics: DataFrame
    roc: DataFrame
    importances: DataFrame | None
    cv_scores: list = field(default_factory=list)
    version: int | None = None


def _prepare(train: DataFrame, apply: DataFrame, y: str, cols: list[str], key: str, k: int, seed: int):
    scaler = fit_median_scaler(train, cols)
    tr = scaler.transform(train.select(key, y, *cols))
    ap = scaler.transform(apply.select(key, y, *cols))
    bal = smote(tr, y, scaler.cols, key, k=k, seed=seed).withColumnRenamed("sample_id", key)
    return bal.drop("synthetic", "synthetic_id"), ap, scaler.cols


def _kept(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "fold")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _prob(df: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    return df.withColumn("score", vector_to_array("probability")[1])


def train_pipeline(df: DataFrame, y: str, cols: list[str], key: str, model: str = "xgb",
                   param_maps: list[dict] | None = None, folds: int = 5, test: float = 0.2, seed: int = 42,
                   k: int = 5, reference_order: bool = False, registry_root: str | None = None,
                   reweight: bool = False, parallelism: int = 4) -> TrainResult:
    """``reweight`` also weighs positives by D10 in fits on balanced rows (off: balancing already evens them out).
    Folds are prepared once, as Parquet; fits run as concurrent Spark jobs."""
    build = MODEL_BUILDERS[model]
    train, test_df = train_test(stratified_split(df, y, key, test, seed))
    w = positive_weight(train, y).first()["pos_weight"]
    maps = param_maps or [{}]
    kw = {"pos_weight": w} if reweight and model in ("xgb", "lgbm") else {}
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    ev = BinaryClassificationEvaluator(labelCol=y, rawPredictionCol="rawPrediction", metricName="areaUnderROC",
                                       numBins=0)
    scores = []
    if reference_order:
        bal, _, feats = _prepare(train, train, y, cols, key, k, seed)
        folded = _kept(stratified_folds(bal, y, key, folds, seed))
        per_fold = [(folded.where(F.col("fold") != f), folded.where(F.col("fold") == f), feats) for f in range(folds)]
    else:
        folded = stratified_folds(train, y, key, folds, seed)
        per_fold = []
        for f in range(folds):
            bal, val, feats = _prepare(folded.where(F.col("fold") != f), folded.where(F.col("fold") == f),
                                       y, cols, key, k, seed)
            per_fold.append((_kept(bal), _kept(val), feats))

    def score(task):
        pm, (bal, val, names) = task
        return ev.evaluate(build(bal, y, names, pm, **kw).transform(val))

    with ThreadPool(parallelism) as pool:
        got = pool.map(inheritable_thread_target(df.sparkSession)(score), [(pm, f) for pm in maps for f in per_fold])
    scores = [sum(got[i * folds:(i + 1) * folds]) / folds for i in range(len(maps))]
    best = maps[max(range(len(maps)), key=lambda i: scores[i])]
    bal, ap, feats = _prepare(train, test_df, y, cols, key, k, seed)
    bal = _kept(bal)
    final = build(bal, y, feats, best, **kw)
    scored = _prob(final.transform(ap)).select(y, F.col("prediction").cast("int").alias("pred"), "score")
    report = classification_report(scored, y, "pred")
    auc = roc_auc(scored, y, "score").withColumn("label", F.lit("roc"))
    metrics = metrics_long(report, "train", model).unionByName(
        metrics_long(auc.select("label", F.col("auc").alias("auc")), "train", model))
    numbers = {f"param_{k}": float(v) for k, v in best.items() if isinstance(v, (int, float))}
    counts = {f"rows_{when}_{r[0]}": float(r[1]) for when, d in (("before", train), ("after", bal))
              for r in d.groupBy(y).count().collect()}  # one row a class
    record = {**numbers, **counts, "positive_weight": float(w), "best_cv_auc": float(max(scores))}
    metrics = metrics.unionByName(df.sparkSession.createDataFrame(
        [("train", model, "run", k, v) for k, v in sorted(record.items())], metrics.schema))
    imp = feature_importance(final, feats, df.sparkSession)
    version = None
    if registry_root:
        from ..sources.registry import save_model_version
        version, _ = save_model_version(df.sparkSession, final, registry_root, f"panel-{model}")
    return TrainResult(final, metrics, roc_curve(scored, y, "score"), imp, scores, version)
