"""Model training, scoring and explanation on Spark ML.

Model equivalents (only Spark ML is available):
* boosted classifiers ("xgb", "lgbm") -> ``GBTClassifier`` with a positive-class weight column;
  learning_rate -> stepSize, n_estimators -> maxIter, max_depth -> maxDepth,
  subsample -> subsamplingRate, colsample_bytree -> featureSubsetStrategy (fraction),
  gamma -> minInfoGain.  L1/L2 leaf penalties have no counterpart.
* additive classifier ("ebm") -> ``GBTClassifier(maxDepth=1)``: boosted stumps are a sum of
  one-feature functions; no pairwise terms.
* forest / boosted / linear regressors -> ``RandomForestRegressor`` / ``GBTRegressor(lossType=
  "absolute")`` / ``LinearRegression``; perceptron -> ``MultilayerPerceptronClassifier``.
"""
from __future__ import annotations

import logging
import math
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, stored

log = logging.getLogger(__name__)

FEATURES_COL = "features"

#: One mapping for training and tuning.  What Spark's trees lack (leaf penalties, bags) is reported, not applied.
PARAM_MAP = {"learning_rate": "stepSize", "n_estimators": "maxIter", "max_depth": "maxDepth",
             "subsample": "subsamplingRate", "gamma": "minInfoGain", "seed": "seed",
             "min_samples_leaf": "minInstancesPerNode", "max_bins": "maxBins",
             "colsample_bytree": "featureSubsetStrategy", "num_leaves": "maxDepth"}
UNMAPPED = ("reg_alpha", "reg_lambda", "outer_bags", "inner_bags")
MAX_DEPTH = 30  # Spark's bound; a depth of None means no bound


def assembler(cols: list[str], out: str = FEATURES_COL):
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep")


def spark_params(kind: str, params: dict | None) -> tuple[dict, dict]:
    """(Spark ML parameters, parameters without a counterpart) of a draw from a search space.

    ``kind`` is ``boosted``, ``additive`` or ``forest``.  Prefixes like ``model__`` are dropped.  ``num_leaves`` n bounds
    the depth by ceil(log2 n); of several depths the smallest holds.
    """
    out, unmapped = {}, {}
    for k, v in (params or {}).items():
        k = k.rpartition("__")[2]
        name = "numTrees" if k == "n_estimators" and kind == "forest" else PARAM_MAP.get(k, k)
        if k in UNMAPPED or (kind == "additive" and name == "maxDepth"):
            unmapped[k] = v
            continue
        if name == "featureSubsetStrategy":
            v = str(min(1.0, float(v))) if not isinstance(v, str) else v
        elif name == "maxDepth":
            v = MAX_DEPTH if v is None else math.ceil(math.log2(v)) if k == "num_leaves" else int(v)
            v = min(MAX_DEPTH, v, out.get("maxDepth", MAX_DEPTH))
        elif name == "subsamplingRate":
            v = min(1.0, float(v))
        elif name in ("maxIter", "minInstancesPerNode", "maxBins", "seed", "numTrees"):
            v = int(v)
        out[name] = v
    return out, unmapped


def _apply_params(est, kind: str, params: dict | None):
    known, unmapped = spark_params(kind, params)
    if unmapped:
        log.info("parameters without a counterpart in Spark ML: %s", unmapped)
    for name, v in known.items():
        est.set(est.getParam(name), v)
    return est


def with_class_weight(df: DataFrame, label: str, weight: float, out: str = "_weight") -> DataFrame:
    """Positive rows weigh ``weight`` (n0/n1), negatives 1."""
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(F.lit(1.0)))


def _fit(df, label, features, est):
    from pyspark.ml import Pipeline
    return Pipeline(stages=[assembler(features), est]).fit(df)


def train_boosted(df: DataFrame, label: str, features: list[str], params: dict | None = None,
                  pos_weight: float | None = None, seed: int = 42):
    """H6: boosted trees classifier; ``pos_weight`` (see D10) re-weights the positive class."""
    from pyspark.ml.classification import GBTClassifier
    est = GBTClassifier(labelCol=label, featuresCol=FEATURES_COL, seed=seed, maxIter=20, maxDepth=3)
    if pos_weight is not None:
        df = with_class_weight(df, label, pos_weight)
        est.setWeightCol("_weight")
    return _fit(df, label, features, _apply_params(est, "boosted", params))


def train_additive(df: DataFrame, label: str, features: list[str], params: dict | None = None, seed: int = 42):
    """H7: boosted stumps (maxDepth 1) – an additive model of one-feature terms."""
    from pyspark.ml.classification import GBTClassifier
    est = GBTClassifier(labelCol=label, featuresCol=FEATURES_COL, seed=seed, maxIter=20, maxDepth=1)
    return _fit(df, label, features, _apply_params(est, "additive", params))


def train_forest_regressor(df: DataFrame, label: str, features: list[str], params: dict | None = None,
                           seed: int = 42):
    """H8: random-forest regression."""
    from pyspark.ml.regression import RandomForestRegressor
    est = RandomForestRegressor(labelCol=label, featuresCol=FEATURES_COL, seed=seed, numTrees=20, maxDepth=5)
    return _fit(df, label, features, _apply_params(est, "forest", params))


def train_boosted_regressor(df: DataFrame, label: str, features: list[str], params: dict | None = None,
                            seed: int = 42):
    """Boosted regression with the absolute-error objective."""
    from pyspark.ml.regression import GBTRegressor
    est = GBTRegressor(labelCol=label, featuresCol=FEATURES_COL, seed=seed, lossType="absolute",
                       maxIter=20, maxDepth=3)
    return _fit(df, label, features, _apply_params(est, "boosted", params))


def train_linear(df: DataFrame, label: str, features: list[str]):
    """H9: ordinary least squares (normal equations are solved distributedly by Spark ML)."""
    from pyspark.ml.regression import LinearRegression
    return _fit(df, label, features, LinearRegression(labelCol=label, featuresCol=FEATURES_COL, solver="normal"))


def train_mlp(df: DataFrame, label: str, features: list[str], hidden: tuple[int, int] = (64, 32),
              n_classes: int = 2, seed: int = 42, max_iter: int = 50):
    """Two hidden layers (no batch-norm or dropout in Spark ML)."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    est = MultilayerPerceptronClassifier(labelCol=label, featuresCol=FEATURES_COL, seed=seed, maxIter=max_iter,
                                         layers=[len(features), hidden[0], hidden[1], n_classes])
    return _fit(df, label, features, est)


MODEL_BUILDERS = {"xgb": train_boosted, "lgbm": train_boosted, "ebm": train_additive}


def score_batch(df: DataFrame, model, drop: list[str] = (), prediction: str = "prediction") -> DataFrame:
    """Drop label/name columns, predict every row, append ``prediction``."""
    base = df.drop(*[c for c in drop if c in df.columns])
    scored = model.transform(base)
    return scored.select(*[F.col(f"`{c}`") for c in base.columns], F.col("prediction").cast("double").alias(prediction))


def score_records(records: DataFrame, models: dict, model_name: str, features: list[str],
                  map_col: str = "features", keys: list[str] = ("client_id",)) -> DataFrame:
    """Free-form feature maps -> columns -> score; unknown model is an error; integer result."""
    if model_name not in models:
        raise KeyError(f"model {model_name!r} not loaded; known: {sorted(models)}")
    cols = records.select(*keys, *[F.col(map_col).getItem(f).cast("double").alias(f) for f in features])
    out = score_batch(cols, models[model_name])
    return out.select(*keys, F.col("prediction").cast("int").alias("prediction"))


def feature_importance(model, names: list[str], spark=None) -> DataFrame | None:
    """Importance per feature; ``None`` when the model has none."""
    stage = model.stages[-1] if hasattr(model, "stages") else model
    if not hasattr(stage, "featureImportances"):
        return None
    imp = stage.featureImportances.toArray().tolist()
    spark = spark or __import__("pyspark.sql", fromlist=["SparkSession"]).SparkSession.getActiveSession()
    return spark.createDataFrame(list(zip(names, [float(v) for v in imp])), "feature string, importance double")


def linear_attributions(df: DataFrame, model, keys: list[str]) -> DataFrame:
    """H14 (exact for linear models): contribution = coef x (x - mean x), long form."""
    means = df.agg(*[F.avg(f).alias(f"_m_{i}") for i, f in enumerate(model.features)])
    j = df.crossJoin(F.broadcast(means))
    parts = ", ".join(f"'{f}', CAST({w!r} AS DOUBLE) * (`{f}` - `_m_{i}`)"
                      for i, (f, w) in enumerate(model.coefs.items()))
    return j.selectExpr(*[f"`{k}`" for k in keys],
                        f"stack({len(model.coefs)}, {parts}) AS (feature, contribution)")


def mean_abs_attribution(attr: DataFrame) -> DataFrame:
    return attr.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs"))


def stump_attributions(df: DataFrame, model, features: list[str], keys: list[str]) -> DataFrame:
    """H14 for boosted stumps: per feature, the sum of its trees' leaf values (x learning rate
    weight), centred by its mean over the rows – expressed as native ``when`` columns."""
    stage = model.stages[-1] if hasattr(model, "stages") else model
    contrib = {f: F.lit(0.0) for f in features}
    for tree, w in zip(stage.trees, stage.treeWeights):
        root = tree._call_java("rootNode")
        if root.getClass().getSimpleName() != "InternalNode":
            continue
        split = root.split()
        fi = split.featureIndex()
        left, right = root.leftChild().prediction(), root.rightChild().prediction()
        if split.getClass().getSimpleName() == "ContinuousSplit":
            cond = F.col(f"`{features[fi]}`") <= F.lit(float(split.threshold()))
        else:
            cats = list(split.leftCategories())
            cond = F.col(f"`{features[fi]}`").isin([float(c) for c in cats])
        contrib[features[fi]] = contrib[features[fi]] + F.lit(float(w)) * F.when(cond, left).otherwise(right)
    raw = df.select(*keys, *[contrib[f].alias(f) for f in features])
    means = raw.agg(*[F.avg(f).alias(f"_m_{i}") for i, f in enumerate(features)])
    j = raw.crossJoin(F.broadcast(means))
    parts = ", ".join(f"'{f}', `{f}` - `_m_{i}`" for i, f in enumerate(features))
    return j.selectExpr(*[f"`{k}`" for k in keys], f"stack({len(features)}, {parts}) AS (feature, contribution)")


def tune(df: DataFrame, label: str, features: list[str], kind: str, param_maps: list[dict], fold_col: str,
         metric: str = "areaUnderROC", parallelism: int = 4, seed: int = 42, pos_weight: float | None = None):
    """Best mean cross-validated score over the param maps, refit on all rows.  The area under the curve is
    exact (no bins); ``pos_weight`` weighs positive rows in the fits.

    Folds come from a column (G3), so the split is reproducible; fits run as concurrent
    Spark jobs (``parallelism``).
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
    from pyspark.ml.regression import RandomForestRegressor
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    if kind in ("xgb", "lgbm", "ebm"):
        est = GBTClassifier(labelCol=label, featuresCol=FEATURES_COL, seed=seed,
                            maxDepth=1 if kind == "ebm" else 3, maxIter=10)
        ev = BinaryClassificationEvaluator(labelCol=label, metricName=metric, numBins=0)
        if pos_weight is not None:
            df = with_class_weight(df, label, pos_weight)
            est.setWeightCol("_weight")
    else:
        est = RandomForestRegressor(labelCol=label, featuresCol=FEATURES_COL, seed=seed, numTrees=10)
        ev = RegressionEvaluator(labelCol=label, metricName="r2")
    family = {"xgb": "boosted", "lgbm": "boosted", "ebm": "additive"}.get(kind, "forest")
    grid = ParamGridBuilder().build() if not param_maps else [
        {est.getParam(k): v for k, v in spark_params(family, pm)[0].items()} for pm in param_maps]
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=ev, foldCol=fold_col,
                        parallelism=parallelism, seed=seed)
    data = assembler(features).transform(df).withColumn(fold_col, F.col(fold_col).cast("int"))
    cvm = cv.fit(data)
    from pyspark.ml import PipelineModel
    return PipelineModel(stages=[assembler(features), cvm.bestModel]), list(cvm.avgMetrics)


def permutation_importance(df: DataFrame, model, features: list[str], label: str, key: str,
                           kind: str = "classifier", seed: int = 42) -> DataFrame:
    """H14 for models without exact attributions: drop in score when one feature's values are
    permuted across rows.  The permutation pairs the i-th row in key order with the i-th row
    in md5-draw order (two global positions, equi-join on position), so it is reproducible
    and never gathers a column in one task."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
    from ..functions.exprs import hash_uniform
    from ..functions.stats import global_index
    if kind == "classifier":
        ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", numBins=0)
    else:
        ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="r2")
    data = df.select(key, label, *features)
    base = ev.evaluate(model.transform(data))
    rows = global_index(data, [key], index_col="_i")
    out = []
    for f in features:
        donor = global_index(data.select(key, f, hash_uniform(key, seed, f).alias("_u")), ["_u", key], index_col="_i")
        permuted = rows.drop(f).join(donor.select("_i", f), "_i").drop("_i")
        out.append((f, float(base - ev.evaluate(model.transform(permuted)))))
    spark = df.sparkSession
    return spark.createDataFrame(out, "feature string, importance double")


def tune_expanding(df: DataFrame, label: str, features: list[str], param_maps: list[dict], folds: DataFrame,
                   period: str = "period", kind: str = "forest", seed: int = 42, parallelism: int = 4):
    """G7 with expanding time folds (G4): ``CrossValidator(foldCol)`` cannot express a
    training set that grows with the fold, so each (param map, fold) pair is fitted on the
    fold's past periods and scored (R^2) on its next block; the best map is refit on all rows.
    Returns (model, [(param_map_index, mean_r2)])."""
    from pyspark.ml.evaluation import RegressionEvaluator
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="r2")
    build = {"forest": train_forest_regressor, "boosted": train_boosted_regressor}[kind]
    path = scratch_path(df.sparkSession, "folds")
    df.join(folds, period).write.partitionBy("fold", "role").parquet(path)  # each fit reads its own rows
    tagged = df.sparkSession.read.parquet(path)
    fold_ids = sorted(r[0] for r in folds.select("fold").distinct().collect())

    def score(task):
        pm, f = task
        part = tagged.where(F.col("fold") == f)
        model = build(part.where(F.col("role") == "train"), label, features, pm, seed=seed)
        return ev.evaluate(model.transform(part.where(F.col("role") == "test")))

    with ThreadPool(parallelism) as pool:  # concurrent Spark jobs
        got = pool.map(inheritable_thread_target(df.sparkSession)(score), [(pm, f) for pm in param_maps for f in fold_ids])
    n = len(fold_ids)
    scores = [(i, sum(got[i * n:(i + 1) * n]) / n) for i in range(len(param_maps))]
    best = max(scores, key=lambda t: t[1])[0]
    return build(df, label, features, param_maps[best], seed=seed), scores


# The search space of the boosted classifier, (name, low, high exclusive) or (name, low, width).
BOOSTED_SPACE = {
    "n_estimators": ("randint", 100, 500),
    "learning_rate": ("uniform", 0.01, 0.1),
    "max_depth": ("randint", 3, 10),
    "gamma": ("uniform", 0, 0.5),
    "subsample": ("uniform", 0.7, 0.3),
    "colsample_bytree": ("uniform", 0.7, 0.3),
}


def tune_halving(df: DataFrame, label: str, features: list[str], param_maps: list[dict], fold_col: str, trees: int = 2,
                 times: int = 3, rungs: int = 3, kind: str = "xgb", seed: int = 42, parallelism: int = 8):
    """G7 with early stopping: successive halving over the number of trees.

    On the first rung every map is fitted with ``trees`` trees (never more than its own number) on every fold and
    scored by the exact area under the curve; the best 1/``times`` go on with ``times`` as many trees, for
    ``rungs`` rungs or until one is left.  Folds come from ``fold_col`` and are written once, fits of a rung run as
    concurrent Spark jobs.  ``gamma``, a loss summed over rows, is divided by their number for Spark's gain a row.
    Returns (best map, [(rung, map index, trees, mean area)]); the caller fits the best map
    with its own number of trees.
    """
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    build = {"xgb": train_boosted, "lgbm": train_boosted, "ebm": train_additive}[kind]
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC", numBins=0)
    kept = stored(df.select(F.col(fold_col).cast("int").alias("_fold"), label, *[F.col(f"`{c}`").cast("double").alias(c) for c in features]), "folds")
    counts = {r["_fold"]: r["count"] for r in kept.groupBy("_fold").count().collect()}
    folds, rows = sorted(counts), sum(counts.values())

    def score(task):
        draw, n, fold = task
        params = {**param_maps[draw], "n_estimators": n}
        if "gamma" in params:  # a loss over all rows there, a gain a row in Spark
            params["gamma"] = params["gamma"] / max(1, rows - counts[fold])
        model = build(kept.where(F.col("_fold") != fold), label, features, params, seed=seed)
        return ev.evaluate(model.transform(kept.where(F.col("_fold") == fold)))

    alive, history, n = list(range(len(param_maps))), [], trees
    for rung in range(rungs):
        sizes = {i: min(n, int(param_maps[i].get("n_estimators", n))) for i in alive}
        with ThreadPool(parallelism) as pool:
            got = pool.map(inheritable_thread_target(df.sparkSession)(score), [(i, sizes[i], f) for i in alive for f in folds])
        means = {i: sum(got[j * len(folds):(j + 1) * len(folds)]) / len(folds) for j, i in enumerate(alive)}
        history += [(rung, i, sizes[i], means[i]) for i in alive]
        alive = sorted(alive, key=lambda i: (-means[i], i))[:max(1, -(-len(alive) // times))]
        if len(alive) == 1:
            break
        n *= times
    return param_maps[alive[0]], history
