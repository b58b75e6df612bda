"""Recursive forecasts and stress scenarios for every entity at once.

The state is one row per entity (or entity x scenario).  Each step is a projection of that
state – predict, then shift the lag columns – so a forecast is a chain of narrow stages with
no shuffle after the latest-row aggregate.  Predictions of all steps are carried as columns
and unpivoted once at the end, so the latest-row aggregate is computed once.  Models that
add plan depth per step (Spark ML) get their lineage cut by a reliable checkpoint every few
steps.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .features import latest_per_entity


class LinearModel:
    """prediction = intercept + sum(coef x feature), evaluated as a native column expression."""

    def __init__(self, intercept: float, coefs: dict[str, float]):
        self.intercept = float(intercept)
        self.coefs = dict(coefs)
        self.features = list(coefs)

    def expr(self) -> Column:
        e = F.lit(self.intercept)
        for name, w in self.coefs.items():
            e = e + F.lit(float(w)) * F.col(f"`{name}`")
        return e

    def predict(self, df: DataFrame, out: str = "_pred") -> DataFrame:
        return df.withColumn(out, self.expr())

    def needs_checkpoint(self) -> bool:
        return False


#: Parameters that name what a stage reads, and what it makes.
_READS = ("inputCol", "featuresCol", "inputCols")
_MAKES = ("outputCol", "outputCols", "predictionCol", "probabilityCol", "rawPredictionCol", "varianceCol")


def _names(stage, params: tuple[str, ...]) -> dict[str, list[str]]:
    """Set column parameters of a stage, each as a list of names."""
    out = {}
    for name in params:
        if stage.hasParam(name) and stage.isDefined(stage.getParam(name)):
            value = stage.getOrDefault(name)
            if value:
                out[name] = [value] if isinstance(value, str) else list(value)
    return out


def _stages(model) -> list:
    """Stages of a fitted model, pipelines within pipelines laid out flat."""
    if not hasattr(model, "stages"):
        return [model]
    return [s for inner in model.stages for s in _stages(inner)]


class SparkModelAdapter:
    """A fitted Spark ML model, or a whole PipelineModel, as a step of a forecast.

    A pipeline's stages are copied and re-wired: what they make gets names of its own, so that columns carried
    from step to step (a prediction, a vector, an index of the same name) are neither read nor overwritten, and
    what they read from the data stays.  A vector that no stage makes is assembled from ``features``, which
    for a pipeline that makes its own may be left out.
    """

    def __init__(self, model, features: list[str] | None = None, prediction_col: str = "prediction"):
        self.stages, self.made, renamed = [], [], {}
        read: list[str] = []
        fitted = _stages(model)
        for n, stage in enumerate(fitted):
            copy = stage.copy()
            for name, cols in _names(stage, _READS).items():
                read += [c for c in cols if c not in renamed and c not in read]
                self._rename(copy, name, cols, renamed)
            fresh = {name: [f"_m{n}_{c}" for c in cols] for name, cols in _names(stage, _MAKES).items()}
            for name, cols in _names(stage, _MAKES).items():
                renamed |= dict(zip(cols, fresh[name]))
                self._rename(copy, name, cols, renamed)
                self.made += fresh[name]
            self.stages.append(copy)
        if prediction_col not in renamed:
            raise ValueError(f"the model makes no column {prediction_col!r}")
        self.prediction = renamed[prediction_col]
        vectors = _names(fitted[-1], ("featuresCol",)).get("featuresCol", [])
        #: The vector to assemble, if the model reads one that it doesn't make.
        self.vector = vectors[0] if vectors and vectors[0] in read else None
        self.features = list(features) if features is not None else [c for c in read if c != self.vector]
        if self.vector and not self.features:
            raise ValueError("a model without an assembler needs the names of its features")

    @staticmethod
    def _rename(stage, name: str, cols: list[str], renamed: dict[str, str]) -> None:
        new = [renamed.get(c, c) for c in cols]
        if new != cols:
            stage._set(**{name: new if name.endswith("s") else new[0]})

    def predict(self, df: DataFrame, out: str = "_pred") -> DataFrame:
        work = df
        if self.vector:
            from pyspark.ml.feature import VectorAssembler
            work = VectorAssembler(inputCols=self.features, outputCol="_m_features", handleInvalid="keep").transform(work)
            work = work.withColumn(self.vector, F.col("_m_features")).drop("_m_features")
        for stage in self.stages:
            work = stage.transform(work)
        return work.select(*[F.col(f"`{c}`") for c in df.columns if c != out], F.col(self.prediction).cast("double").alias(out))

    def needs_checkpoint(self) -> bool:
        return True


def _maybe_checkpoint(state: DataFrame, model, step: int, every: int) -> DataFrame:
    if model.needs_checkpoint() and step % every == 0:
        return reliable_checkpoint(state)
    return state


def forecast_recursive(df: DataFrame, model, horizon: int, target: str, lags: dict[str, int],
                       entity: str = "entity_id", period: str = "period", align: str = "reference",
                       checkpoint_every: int = 3) -> DataFrame:
    """Per entity, ``horizon`` steps ahead from its latest row.

    ``lags`` maps a column to its deepest lag (columns ``<col>_lag1 .. <col>_lag<p>``).
    ``align="reference"``: predict from the current row, label it period + 1, then set the
    target to the prediction and shift every lag (lag p <- lag p-1, lag 1 <- the previous
    value).  ``"shifted"``: shift first, then predict the new period.  Other features stay
    frozen.  Output: (entity, period, step, prediction).
    """
    state = latest_per_entity(df, entity, period)
    keep = [entity, period, target] + [c for c in model.features if c not in (entity, period, target)]
    for col, p in lags.items():
        keep += [col] + [f"{col}_lag{k}" for k in range(1, p + 1)]
    keep = list(dict.fromkeys(k for k in keep if k in state.columns))
    state = state.select(*[F.col(f"`{c}`") for c in keep])
    carried: list[str] = []

    def shift(s: DataFrame) -> DataFrame:
        sel = {c: F.col(f"`{c}`") for c in s.columns}
        for col, p in lags.items():
            for k in range(p, 1, -1):
                sel[f"{col}_lag{k}"] = F.col(f"`{col}_lag{k - 1}`")
            sel[f"{col}_lag1"] = F.col(f"`{col}`")
        sel[period] = F.col(period) + 1
        return s.select(*[v.alias(k) for k, v in sel.items()])

    for step in range(1, horizon + 1):
        if align == "shifted":
            state = shift(state)
        state = model.predict(state).withColumn(f"_p{step}", F.col("_pred"))
        carried.append(f"_p{step}")
        if align == "reference":
            state = shift(state)
        state = state.withColumn(target, F.col("_pred")).drop("_pred")
        state = _maybe_checkpoint(state, model, step, checkpoint_every)
    last = F.col(period) - horizon
    body = ", ".join(f"{i + 1}, `{c}`" for i, c in enumerate(carried))
    out = state.select(entity, last.alias("_base"), F.expr(f"stack({horizon}, {body}) AS (step, prediction)"))
    return out.select(entity, (F.col("_base") + F.col("step")).cast("int").alias(period),
                      F.col("step").cast("int").alias("step"), "prediction")


def stress_scenarios(df: DataFrame, model, shocks: dict[str, float | None], years: int, target: str,
                     driver: str, carried_lags: dict[str, str], target_lag: str,
                     entity: str = "entity_id", period: str = "period", shock_first_year: bool = False,
                     checkpoint_every: int = 3) -> DataFrame:
    """Per entity x scenario, ``years`` steps.  Each year: predict, then feed the prediction
    into ``target_lag``, copy every column of ``carried_lags`` into its lag, and set ``driver``
    to the scenario value (``None`` = the entity's last observed value).  With
    ``shock_first_year=False`` (reference behaviour) all scenarios share the first year.
    Output: (entity, scenario, period, step, prediction)."""
    latest = latest_per_entity(df, entity, period)
    specs = F.array(*[F.struct(F.lit(name).alias("scenario"), F.lit(v).cast("double").alias("shock"))
                      for name, v in shocks.items()])
    # scenarios are a fixed parameter list: exploded per entity row, no join
    state = latest.select("*", F.explode(specs).alias("_sc")).select(
        "*", F.col("_sc.scenario").alias("scenario"),
        F.coalesce(F.col("_sc.shock"), F.col(f"`{driver}`")).alias("_shock")).drop("_sc")
    if shock_first_year:
        state = state.withColumn(driver, F.col("_shock"))
    carried = []
    for step in range(1, years + 1):
        state = model.predict(state).withColumn(f"_p{step}", F.col("_pred"))
        carried.append(f"_p{step}")
        upd = {target_lag: F.col("_pred"), period: F.col(period) + 1, driver: F.col("_shock")}
        for src, lag in carried_lags.items():
            upd[lag] = F.col(f"`{src}`")
        state = state.select(*[(upd[c].alias(c) if c in upd else F.col(f"`{c}`")) for c in state.columns if c != "_pred"])
        state = _maybe_checkpoint(state, model, step, checkpoint_every)
    body = ", ".join(f"{i + 1}, `{c}`" for i, c in enumerate(carried))
    out = state.select(entity, "scenario", (F.col(period) - years).alias("_base"),
                       F.expr(f"stack({years}, {body}) AS (step, prediction)"))
    return out.select(entity, "scenario", (F.col("_base") + F.col("step")).cast("int").alias(period),
                      F.col("step").cast("int").alias("step"), "prediction")


def history_with_forecast(history: DataFrame, fitted: DataFrame, future: DataFrame, target: str,
                          entity: str = "entity_id", period: str = "period",
                          fitted_col: str = "prediction", future_col: str = "prediction") -> DataFrame:
    """Actual (renamed), fitted and future series of every entity in one long table."""
    a = history.select(entity, period, F.col(target).alias("actual"))
    f = fitted.select(entity, period, F.col(fitted_col).alias("fitted"))
    u = future.select(entity, period, F.col(future_col).alias("forecast"))
    return a.unionByName(f, allowMissingColumns=True).unionByName(u, allowMissingColumns=True)
