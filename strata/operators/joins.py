"""Joins and lookups."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_target(raw: DataFrame, target: DataFrame, keys: list[str] = ("entity_id", "period"),
                 target_col: str = "target") -> DataFrame:
    """Join on the keys with null-safe equality (pandas merge matches null with null), keep labelled rows,
    label to int.  The rule for a key with several labels, null keys included, is its smallest label: every
    row gets one label at most, so the output never grows beyond the input."""
    keys = list(keys)
    t = (target.where(F.col(target_col).isNotNull()).groupBy(*[F.col(k).alias(f"_t_{k}") for k in keys])
         .agg(F.min(target_col).alias(target_col)))
    cond = reduce(lambda a, b: a & b, [raw[k].eqNullSafe(t[f"_t_{k}"]) for k in keys])
    joined = raw.join(t, cond).drop(*[f"_t_{k}" for k in keys])
    return joined.withColumn(target_col, F.col(target_col).cast("int"))


def anti_entities(df: DataFrame, entities: DataFrame, entity: str) -> DataFrame:
    """Rows whose entity is not in the set; null entities are kept (``~isin``)."""
    known = df.where(F.col(entity).isNotNull())
    listed = entities.select(entity).where(F.col(entity).isNotNull()).distinct()
    # split off, rows without an entity don't meet in one partition of the join
    return known.join(listed, entity, "left_anti").select(*df.columns).unionByName(df.where(F.col(entity).isNull()))


def first_per_key(df: DataFrame, key: str, order_by: str, cols: list[str]) -> DataFrame:
    """The first row per key in ``order_by`` order, as a partial aggregate (no sort, skew safe)."""
    return (df.groupBy(key).agg(F.min_by(F.struct(*cols), F.col(order_by)).alias("_first"))
            .select(key, "_first.*"))


def map_lookup(spine: DataFrame, spine_key: str, predictions: DataFrame, pred_key: str, pred_order: str,
               pred_cols: list[str], data: DataFrame, data_key: str, data_order: str,
               data_cols: list[str]) -> DataFrame:
    """For each spine id the first matching prediction and data row; unmatched ids kept."""
    p = first_per_key(predictions, pred_key, pred_order, pred_cols).withColumnRenamed(pred_key, spine_key)
    d = first_per_key(data, data_key, data_order, data_cols).withColumnRenamed(data_key, spine_key)
    return spine.join(p, spine_key, "left").join(d, spine_key, "left")


def entity_directory(df: DataFrame, entity: str = "entity_id", name: str = "entity_name") -> DataFrame:
    """C4: distinct id -> name pairs."""
    return df.select(entity, name).distinct()


def entity_names(df: DataFrame, name: str = "entity_name") -> DataFrame:
    """C4: sorted distinct names (the selector list)."""
    return df.select(name).where(F.col(name).isNotNull()).distinct().orderBy(name)


def entity_ids_by_name(df: DataFrame, entity: str = "entity_id", name: str = "entity_name") -> DataFrame:
    """C4: the first (smallest) id of every name and how many ids share it."""
    return df.groupBy(name).agg(F.min(entity).alias(entity), F.count_distinct(entity).alias("n_ids"))


def entity_id_for(df: DataFrame, name_value: str, entity: str = "entity_id", name: str = "entity_name"):
    row = df.where(F.col(name) == F.lit(name_value)).agg(F.min(entity)).first()
    return row[0]


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a one-row aggregate to every row (broadcast; one row by construction)."""
    return df.crossJoin(F.broadcast(one_row))
