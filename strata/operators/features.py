"""Feature preparation: lags, latest rows, median fill + scaling, one-hot, z-scores
(E4, E5, H1-H3)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import column_medians
from .joins import with_scalar


def _c(name: str):
    return F.col(f"`{name}`")


def lag_features(df: DataFrame, cols: list[str], periods: list[int], entity: str = "entity_id",
                 period: str = "period", null_entity: str = "reset", hot_rows: int | None = None) -> DataFrame:
    """``<col>_lag<p>`` = value p periods earlier within the entity.

    Rows without an entity get no lag (``"reset"``, as a pandas group shift) and are spread
    over tiny window groups; ``"keep"`` treats the missing entity as one entity.  Entities of more than
    ``hot_rows`` rows are numbered in ranges and meet their earlier rows by position (``segments.lags``);
    the input is then counted once.
    """
    from .impute import _grouped, _spec
    from .segments import lags, split_hot
    cool, hot = split_hot(df, entity, null_entity, hot_rows)
    w = _spec(entity, period)

    def lag(c, p):
        e = F.lag(_c(c), p).over(w)
        return F.when(_c(entity).isNotNull(), e) if null_entity == "reset" else e
    out = _grouped(cool, entity, null_entity).select(
        *[_c(c) for c in df.columns], *[lag(c, p).alias(f"{c}_lag{p}") for c in cols for p in periods])
    return out if hot is None else out.unionByName(lags(hot, cols, periods, entity, period))


def latest_per_entity(df: DataFrame, entity: str = "entity_id", period: str = "period") -> DataFrame:
    """E5: the last row of each entity by period, as a partial aggregate (no sort of the panel)."""
    others = [c for c in df.columns if c != entity]
    return (df.groupBy(_c(entity).alias(entity))
            .agg(F.max_by(F.struct(*[_c(c) for c in others]), _c(period)).alias("_last"))
            .select(entity, *[F.col(f"_last.`{c}`").alias(c) for c in others]))


class MedianScalerModel:
    """Fitted H1 parameters (median, mean and sd per kept column) held as plain numbers: the
    fit is an estimator, its tiny result is applied as literals (no re-evaluation of the
    training plan when the model is applied)."""

    def __init__(self, params: dict[str, tuple[float, float, float]]):
        self.params = params
        self.cols = list(params)

    def transform(self, df: DataFrame) -> DataFrame:
        out = []
        for c in df.columns:
            if c in self.params:
                med, mean, sd = self.params[c]
                filled = F.coalesce(_c(c).cast("double"), F.lit(med))
                out.append(((filled - F.lit(mean)) / F.lit(sd)).alias(c))
            else:
                out.append(_c(c))
        return df.select(*out)

    def params_frame(self, spark) -> DataFrame:
        return spark.createDataFrame([(c, *v) for c, v in self.params.items()],
                                     "column string, median double, mean double, sd double")


def fit_median_scaler(train: DataFrame, cols: list[str], stored: bool = False) -> MedianScalerModel:
    """H1 fit: medians of the train rows; mean and population sd of the median-filled train
    rows (sd 0 -> 1).  Columns with no value at all are dropped.  ``stored``: ``train`` is cheap to read
    several times, as it comes from a table."""
    med_row = column_medians(train.select(*[_c(c).cast("double").alias(c) for c in cols]), cols, stored).first()
    kept = [c for c in cols if med_row[c] is not None]
    filled = train.select(*[F.coalesce(_c(c).cast("double"), F.lit(med_row[c])).alias(c) for c in kept])
    mom = filled.agg(*[e for c in kept for e in (
        F.avg(_c(c)).alias(f"m_{c}"),
        F.when(F.stddev_pop(_c(c)) == 0, F.lit(1.0)).otherwise(F.stddev_pop(_c(c))).alias(f"s_{c}"))]).first()
    return MedianScalerModel({c: (float(med_row[c]), float(mom[f"m_{c}"]), float(mom[f"s_{c}"])) for c in kept})


def median_impute_scale(train: DataFrame, apply: DataFrame, cols: list[str], stored: bool = False) -> DataFrame:
    """H1: fit on ``train``, apply to ``apply`` (dropped columns disappear from the output)."""
    model = fit_median_scaler(train, cols, stored)
    dropped = [c for c in cols if c not in model.cols]
    return model.transform(apply.drop(*dropped))


def standard_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """H3: z-score with the population sd; a constant column is divided by 1."""
    stats = df.agg(*[e for c in cols for e in (
        F.avg(_c(c)).alias(f"_mean_{c}"),
        F.when(F.stddev_pop(_c(c)) == 0, F.lit(1.0)).otherwise(F.stddev_pop(_c(c))).alias(f"_sd_{c}"))])
    joined = with_scalar(df, stats)
    return joined.select(*[(((_c(c) - F.col(f"`_mean_{c}`")) / F.col(f"`_sd_{c}`")).alias(c) if c in cols else _c(c))
                           for c in df.columns])


def category_values(df: DataFrame, col: str) -> list:
    """Distinct non-null categories in order: the column names of the wide form.  For more categories than a
    table can have columns, use ``one_hot_long`` or ``one_hot_vector``."""
    return sorted(r[0] for r in df.select(col).where(_c(col).isNotNull()).distinct().collect())


def one_hot_long(df: DataFrame, col: str, keys: list[str]) -> DataFrame:
    """H2 (long form): one (keys, column, category, 1) row per non-null cell; any number of categories."""
    return df.where(_c(col).isNotNull()).select(*[_c(k) for k in keys], F.lit(col).alias("column"),
                                                _c(col).cast("string").alias("category"), F.lit(1).alias("value"))


def one_hot(df: DataFrame, cols: list[str], keep_source: bool = False) -> DataFrame:
    """H2: one 0/1 indicator column ``<col>_<value>`` per category (wide form); a null category is 0 in all."""
    out = df
    for c in cols:
        vals = category_values(df, c)
        out = out.select("*", *[_c(c).eqNullSafe(F.lit(v)).cast("int").alias(f"{c}_{v}") for v in vals])
        if not keep_source:
            out = out.drop(c)
    return out


def one_hot_vector(df: DataFrame, col: str, out_col: str | None = None):
    """H2 (model form): StringIndexer + OneHotEncoder(dropLast=False) into a vector column."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    out_col = out_col or f"{col}_vec"
    pipe = Pipeline(stages=[
        StringIndexer(inputCol=col, outputCol=f"{col}_idx", handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol=f"{col}_idx", outputCol=out_col, dropLast=False)])
    model = pipe.fit(df)
    return model, model.transform(df).drop(f"{col}_idx")
