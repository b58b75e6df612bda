"""Class balancing by synthetic minority over-sampling (H4) and its counts (H5).

Every smaller class is grown to the majority size.  Synthetic row j of a class takes a seed
row (position drawn by md5), its r-th nearest neighbour in the same class (r drawn in
1..k) and a step u in [0, 1): ``x + u * (neighbour - x)``.  Neighbours are searched for the drawn
seeds only, without enumerating all pairs (``neighbours``).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import hash_uniform
from ..functions.stats import global_index
from .neighbours import knn_for_seeds, lsh_for_seeds, thin_duplicates  # noqa: F401


def smote(df: DataFrame, y: str, cols: list[str], key: str, k: int = 5, seed: int = 42, search: str = "cells") -> DataFrame:
    """H4: the input rows plus synthetic rows until every class has the majority's size.

    Output: (sample_id, synthetic_id, *cols, y, synthetic).  Original rows keep their key, of any type, as
    sample_id and have no synthetic_id; synthetic rows are numbered from 1 over all classes (class order breaks
    ties between classes) and have no sample_id.  ``search``: "cells" finds exact neighbours, "lsh" near ones by
    locality-sensitive hashing.  A null label is refused.
    """
    if search not in ("cells", "lsh"):
        raise ValueError(f"search is 'cells' or 'lsh', not {search!r}")
    find = knn_for_seeds if search == "cells" else lsh_for_seeds
    spark = df.sparkSession
    counts = [(r[0], r[1]) for r in df.groupBy(y).count().collect()]
    if any(label is None for label, _ in counts):
        raise ValueError(f"column {y!r} holds rows without a label")
    counts.sort(key=lambda t: (-t[1], t[0]))
    parts = [df.select(F.col(key).alias("sample_id"), F.lit(None).cast("long").alias("synthetic_id"),
                       *[F.col(c).cast("double").alias(c) for c in cols], F.col(y), F.lit(False).alias("synthetic"))]
    offset, n_maj = 0, counts[0][1] if counts else 0
    for label, n in counts[1:]:
        if n <= k:
            raise ValueError(f"class {label!r} has {n} rows; need more than k={k}")
        n_new = n_maj - n
        if n_new == 0:
            continue
        cls = df.where(F.col(y) == F.lit(label)).select(key, *[F.col(c).cast("double").alias(c) for c in cols])
        pos = global_index(cls, [key], index_col="_pos")
        salt = f"{label}"
        draws = spark.range(n_new).select(
            F.col("id").alias("_j"),
            F.floor(hash_uniform(F.col("id"), seed, f"{salt}:row") * F.lit(n)).cast("long").alias("_pos"),
            (F.floor(hash_uniform(F.col("id"), seed, f"{salt}:nn") * F.lit(k)) + 1).cast("int").alias("_rnk"),
            hash_uniform(F.col("id"), seed, f"{salt}:step").alias("_step"))
        seeds = pos.join(draws.select("_pos").distinct(), "_pos", "left_semi")
        nbrs = find(pos.select(key, *cols), seeds.select("_pos", key, *cols), cols, key, k)
        parts.append(draws.join(pos.select("_pos", *cols), "_pos").join(nbrs, ["_pos", "_rnk"]).select(
            F.lit(None).cast(df.schema[key].dataType).alias("sample_id"), (F.col("_j") + 1 + offset).alias("synthetic_id"),
            *[(F.col(c) + F.col("_step") * (F.col(f"n_{c}") - F.col(c))).alias(c) for c in cols],
            F.lit(label).cast(df.schema[y].dataType).alias(y), F.lit(True).alias("synthetic")))
        offset += n_new
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def balance_counts(before: DataFrame, after: DataFrame, y: str) -> DataFrame:
    """H5: rows per class before and after balancing."""
    b = before.groupBy(y).agg(F.count(F.lit(1)).alias("rows_before"))
    a = after.groupBy(y).agg(F.count(F.lit(1)).alias("rows_after"))
    return b.join(a, y, "full")
