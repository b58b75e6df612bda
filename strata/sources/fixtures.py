"""Derived panels built from the driver tables with Spark (the inputs of the registered queries).

* ``panel``       P: customer x year panel with natural gaps (units, spend, disc_pct, thin)
* ``panel_null``  N: P with null entity keys
* ``target_side`` T: labels to merge onto N
* ``events_defects`` E: event rows with planted text/infinity/constant defects
* ``doc_classes`` D: small imbalanced classification set from labels + documents
* ``scored``      M: labels, hard predictions and scores from events
* ``forecast_base`` F: imputed P with lag-1 columns
* ``prediction_records`` R: stored and arriving prediction records from customers
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

MAX_PERIODS = 100_000  # bound asserted in the plan before the period list is broadcast


def _cents(c):
    """x as an exact integer number of hundredths: equal to the unscaled value of
    CAST(x AS DECIMAL(p, 2)) (both round half up from the shortest decimal form of x)."""
    return F.round(F.round(c, 2) * 100, 0).cast("long")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P.  Lineitem is pre-aggregated per order (partial aggregation before the shuffle), joined
    1:1 to its order, then both order and line measures are summed per (customer, year) in one
    aggregate.  Exact integer sums keep every engine bit-identical.  The dense customer x year grid
    uses the distinct years of the data (a small, checked list)."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    lines = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_extendedprice", "l_discount"])
    # Exact decimal arithmetic on integer units: cents (x 100) and basis points of a cent
    # (x 10^4) summed as longs.  Dividing the exact integer sum by the power of ten in
    # double is correctly rounded, i.e. equal to CAST(SUM(DECIMAL) AS DOUBLE), while staying
    # in codegen'd long arithmetic instead of wide decimals.
    ext_c = _cents(F.col("l_extendedprice"))
    per_order = lines.groupBy("l_orderkey").agg(
        F.sum(ext_c * _cents(F.col("l_discount"))).alias("_disc_amt"),
        F.sum(ext_c).alias("_ext"))
    o = orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").cast("int").alias("period"),
                      _cents(F.col("o_totalprice")).alias("_price"))
    joined = o.join(per_order, o.o_orderkey == per_order.l_orderkey, "left")
    agg = joined.groupBy(F.col("o_custkey").alias("entity_id"), "period").agg(
        F.count(F.lit(1)).cast("double").alias("units"),
        (F.sum("_price").cast("double") / F.lit(100.0)).alias("spend"),
        ((F.sum("_disc_amt").cast("double") / F.lit(10000.0)) * 100
         / (F.sum("_ext").cast("double") / F.lit(100.0))).alias("disc_pct"))
    # the period list is broadcast: its size bound is asserted inside the plan (no extra job)
    years = o.agg(F.sort_array(F.collect_set("period")).alias("_years")).select(
        F.when(F.assert_true(F.size("_years") <= MAX_PERIODS,
                             f"more than {MAX_PERIODS} distinct periods").isNull(), F.col("_years")).alias("_years"))
    customers = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    grid = (customers.crossJoin(F.broadcast(years))  # one-row side: the period list
            .select(F.col("c_custkey").alias("entity_id"), F.col("c_name").alias("entity_name"),
                    F.explode("_years").alias("period")))
    p = grid.join(agg, ["entity_id", "period"], "left")
    return p.select("entity_id", "entity_name", "period", "units", "spend", "disc_pct",
                    F.when(F.col("entity_id") % 10 != 0, F.col("spend")).alias("thin"))


def panel_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N: P with a null entity key for every 50th customer."""
    p = panel(spark, sf_dir)
    return p.withColumn("entity_id", F.when(F.col("entity_id") % 50 == 0, F.lit(None).cast("long"))
                        .otherwise(F.col("entity_id")))


def target_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T: (entity_id, period, target) from N for null keys and ids not divisible by 3."""
    n = panel_null(spark, sf_dir)
    return (n.where(F.col("entity_id").isNull() | (F.col("entity_id") % 3 != 0))
            .select("entity_id", "period", F.col("units").cast("int").alias("target")))


def events_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E: events with text, infinity and constant defects planted by event id."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "ts", "value"])
    eid = F.col("event_id")
    text = (F.when(eid % 7 == 0, F.lit("n/a")).when(eid % 11 == 0, F.lit(""))
            .when(eid % 13 == 0, F.lit("1,000")).when(eid % 17 == 0, F.lit("1d"))
            .when(eid % 19 == 0, F.lit(" 5 ")).otherwise(F.col("value").cast("string")))
    inf = (F.when(eid % 97 == 0, F.lit(float("inf"))).when(eid % 89 == 0, F.lit(float("-inf")))
           .when(eid % 83 == 0, F.lit(None).cast("double")).otherwise(F.col("value")))
    return ev.select("event_id", "user_id", "event_type", F.hour("ts").cast("int").alias("hr"),
                     F.col("ts").cast("date").alias("day"), "value", text.alias("value_text"),
                     inf.alias("value_inf"), F.lit(7.0).alias("constant_col"))


def doc_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D: labelled documents with three integer-valued size features."""
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "n_chars", "lang"])
    t = F.col("text")
    return lab.join(docs, "doc_id").select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"),
        (F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1).cast("double").alias("n_words"),
        (F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit("")))).cast("double").alias("n_lines"),
        "lang", "quality", "toxic")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M: y = error event, pred = value >= 50, score = round(value) / 500."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "event_type", "value"])
    return ev.select("event_id",
                     F.when(F.col("event_type") == "error", 1).otherwise(0).alias("y"),
                     F.when(F.col("value") >= 50, 1).otherwise(0).alias("pred"),
                     (F.round("value", 0) / F.lit(500.0)).alias("score"))


FORECAST_COLS = ["units", "spend", "disc_pct"]


def forecast_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F: P (without ``thin``) imputed by E8, with lag-1 of spend, disc_pct and units."""
    from ..operators.features import lag_features
    from ..operators.impute import impute_panel
    p = panel(spark, sf_dir).drop("thin")
    imp = impute_panel(p, "entity_id", "period", cols=FORECAST_COLS)
    return lag_features(imp, ["spend", "disc_pct", "units"], [1], "entity_id", "period")


def _record_cols(c):
    bal = F.col("c_acctbal")
    return [F.col("c_name").alias("client_id"), bal.alias("income"), (bal * 0.5).alias("expenses"),
            (bal * 0.25).alias("debt"), (bal * 2.0).alias("assets")]


def prediction_records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """R: stored records (even customer keys, id = key) and an arriving batch (every customer,
    multiples of 5 twice)."""
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_acctbal"])
    existing = cust.where(F.col("c_custkey") % 2 == 0).select(
        F.col("c_custkey").cast("long").alias("id"), *_record_cols(cust),
        F.lit(None).cast("double").alias("prediction"), F.lit(None).cast("string").alias("risk_level"),
        F.lit(None).cast("timestamp").alias("timestamp"))
    new = cust.select(*_record_cols(cust)).unionByName(
        cust.where(F.col("c_custkey") % 5 == 0).select(*_record_cols(cust)))
    return existing, new
