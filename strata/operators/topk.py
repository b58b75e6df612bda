"""Sorts, limits and top-k."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import fround
from .profile import missing_by_entity


def sort_panel(df: DataFrame, entity: str = "entity_id", period: str = "period") -> DataFrame:
    """by entity, then period; nulls last (range-partitioned global sort)."""
    return df.orderBy(F.col(entity).asc_nulls_last(), F.col(period).asc_nulls_last())


def top_missing_entities(df: DataFrame, col: str, n: int = 15, entity: str = "entity_id",
                         decimals: int = 2) -> DataFrame:
    """the n entities with the highest % of null ``col`` (ties by entity), rounded.

    ``orderBy + limit`` plans as TakeOrderedAndProject: each task keeps its own n best rows.
    """
    return (missing_by_entity(df, col, entity)
            .orderBy(F.col("missing_pct").desc(), F.col(entity).asc_nulls_last()).limit(n)
            .select(entity, fround("missing_pct", decimals).alias("missing_pct")))


def top_importances(importances: DataFrame, n: int = 15) -> DataFrame:
    """the n most important features (ties by name)."""
    return importances.orderBy(F.col("importance").desc(), F.col("feature")).limit(n)


def latest_forecast(forecast: DataFrame, entity: str = "entity_id", period: str = "period",
                    value: str = "prediction") -> DataFrame:
    """last forecast period and its value per entity (partial aggregate, no sort)."""
    return forecast.groupBy(entity).agg(F.max(period).alias(period), F.max_by(value, period).alias(value))
