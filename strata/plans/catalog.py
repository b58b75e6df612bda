"""The registered queries: key -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes (spark, sf_dir), reads the driver tables (through the fixture builders)
and returns a DataFrame over the whole tables.  Computed columns carry the same alias in
the Spark plan and the SQL text; floats that two engines sum in different orders are
rounded in both.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import NA_TOKENS, fround
from ..operators import clean, joins, profile, impute, features
from ..session import scratch_path, stored
from ..sources import fixtures as fx
from ..sources.csv_io import scan_csv, sink_csv
from ..sources.tables import read_table
from . import fixture_sql as fs
from .sqlgen import (corr_pairs_sql, interp_sql, nullity_corr_sql, nullity_distance_sql,
                     rewrite_round_sql, union_per_column)

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}

P_COLS = ["entity_id", "entity_name", "period", "units", "spend", "disc_pct", "thin"]
P_MEASURES = ["units", "spend", "disc_pct", "thin"]


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, rewrite_round_sql(sql) if sql is not None else None)
        return fn
    return deco


def W(body: str, *names: str) -> str:
    return fs.with_ctes(body, *names)


# ---------------------------------------------------------------- A: sources and sinks

@register("csv_roundtrip", W("SELECT * FROM p", "p"))
def q_csv_roundtrip(spark, sf):
    p = fx.panel(spark, sf)
    path = scratch_path(spark, "csv")
    sink_csv(p, path)
    return scan_csv(spark, path, schema=p.schema)


_NA = ", ".join("'" + t + "'" for t in NA_TOKENS)


@register("csv_documents", f"SELECT doc_id, CASE WHEN text IN ({_NA}) THEN NULL ELSE text END AS text FROM documents")
def q_csv_documents(spark, sf):
    """Texts with quotes, commas and line feeds through the CSV dialect."""
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    path = scratch_path(spark, "csv-docs")
    sink_csv(docs, path)
    return scan_csv(spark, path, schema=docs.schema)


# ---------------------------------------------------------------- B: projections, filters, rules

@register("select_features", W("SELECT entity_id, period, spend, units FROM p", "p"))
def q_select_features(spark, sf):
    return clean.select_features(fx.panel(spark, sf), ["entity_id", "period", "spend", "units"])


@register("drop_columns", W("SELECT entity_id, entity_name, period, units, spend, disc_pct FROM p", "p"))
def q_drop_columns(spark, sf):
    return clean.drop_columns(fx.panel(spark, sf), ["thin", "not_a_column"])


COERCE_SQL = ("CASE WHEN regexp_matches(value_text, '[0-9.][dDfF]\\s*$') THEN NULL "
              "ELSE TRY_CAST(value_text AS DOUBLE) END")


@register("coerce_numeric", W(f"SELECT event_id, event_type, {COERCE_SQL} AS value_text FROM e", "e"))
def q_coerce_numeric(spark, sf):
    e = fx.events_defects(spark, sf).select("event_id", "event_type", "value_text")
    return clean.coerce_numeric(e, except_cols=["event_type"])


@register("drop_periods", W("SELECT * FROM n WHERE period IS NULL OR period NOT IN (1995, 2001)", "n"))
def q_drop_periods(spark, sf):
    return clean.drop_periods(fx.panel_null(spark, sf), [1995, 2001])


SPARSE_SQL = """SELECT * FROM n WHERE entity_id IS NULL OR entity_id NOT IN (
  SELECT entity_id FROM n WHERE entity_id IS NOT NULL GROUP BY entity_id
  HAVING avg(CAST(thin IS NULL AS DOUBLE)) > 0.5)"""


@register("drop_sparse_entities", W(SPARSE_SQL, "n"))
def q_drop_sparse_entities(spark, sf):
    return clean.drop_sparse_entities(fx.panel_null(spark, sf), "thin", "entity_id", 0.5)


@register("drop_sparse_columns", W("SELECT entity_id, entity_name, period, units, spend, disc_pct FROM p", "p"))
def q_drop_sparse_columns(spark, sf):
    return clean.drop_sparse_columns(fx.panel(spark, sf), 0.3)


E_NO_DAY = ["event_id", "user_id", "event_type", "hr", "value", "value_text", "value_inf", "constant_col"]


@register("replace_inf_dropna", W(
    "SELECT event_id, user_id, event_type, hr, value, value_text, value_inf, constant_col FROM e "
    "WHERE value_inf IS NOT NULL AND NOT isinf(value_inf) AND event_id IS NOT NULL AND user_id IS NOT NULL "
    "AND event_type IS NOT NULL AND hr IS NOT NULL AND value IS NOT NULL AND value_text IS NOT NULL", "e"))
def q_replace_inf_dropna(spark, sf):
    return clean.replace_inf_dropna(fx.events_defects(spark, sf).select(*E_NO_DAY))


@register("label_strict_lt", W(
    "SELECT entity_id, entity_name, period, spend, disc_pct, thin, "
    "CASE WHEN coalesce(units, (SELECT median(units) FROM p)) < 2 THEN 1 ELSE 0 END AS label FROM p", "p"))
def q_label_strict_lt(spark, sf):
    return clean.label_strict_lt(fx.panel(spark, sf), "units", cut=2)


@register("label_strict_gt", W(
    "SELECT entity_id, entity_name, period, spend, disc_pct, thin, "
    "CASE WHEN coalesce(units, (SELECT median(units) FROM p)) > 2 THEN 0 ELSE 1 END AS label FROM p", "p"))
def q_label_strict_gt(spark, sf):
    return clean.label_strict_gt(fx.panel(spark, sf), "units", cut=2)


@register("drop_null_target", W("SELECT * FROM p WHERE spend IS NOT NULL", "p"))
def q_drop_null_target(spark, sf):
    return clean.drop_null_target(fx.panel(spark, sf), "spend")


REF_NAMES = {"units": "Units (count)", "spend": "Spend (USD)", "disc_pct": "Discount (% of price)",
             "thin": "Thin spend, sampled"}


@register("sanitize_names", W(
    "SELECT entity_id, entity_name, period, units AS Units_count_, spend AS Spend_USD_, "
    "disc_pct AS Discount_of_price_, thin AS Thin_spend_sampled FROM p", "p"))
def q_sanitize_names(spark, sf):
    p = fx.panel(spark, sf)
    return clean.sanitize_names(p.select(*[F.col(c).alias(REF_NAMES.get(c, c)) for c in p.columns]))


@register("entity_history", W("SELECT * FROM p WHERE entity_id = 42 ORDER BY period", "p"))
def q_entity_history(spark, sf):
    return clean.entity_history(fx.panel(spark, sf), 42)


@register("quantize_scores", W(
    "SELECT event_id, score, least(8, greatest(0, CAST(floor(9.0 * (score - 0.0) / 1.0) AS INTEGER))) AS fill_class "
    "FROM m", "m"))
def q_quantize(spark, sf):
    from ..functions.exprs import quantize
    m = fx.scored(spark, sf)
    return m.select("event_id", "score", quantize("score", 0.0, 1.0, 9).alias("fill_class"))


@register("clean_columns", W(
    f"SELECT event_id, user_id, event_type, hr, value, {COERCE_SQL} AS value_text, value_inf FROM e", "e"))
def q_clean_columns(spark, sf):
    return clean.clean_columns(fx.events_defects(spark, sf), drop=["constant_col", "day"],
                               categorical=["event_type"], frac=0.8)


CLEAN_PANEL_SQL = """, n1 AS (SELECT * FROM n WHERE period IS NULL OR period NOT IN (1995))
SELECT * FROM n1 WHERE entity_id IS NULL OR entity_id NOT IN (
  SELECT entity_id FROM n1 WHERE entity_id IS NOT NULL GROUP BY entity_id
  HAVING avg(CAST(thin IS NULL AS DOUBLE)) > 0.5)"""


def _clean_panel_sql(body_after: str) -> str:
    text = W("SELECT 1", "n")
    return text[: text.rindex("SELECT 1")].rstrip() + CLEAN_PANEL_SQL.replace(
        "SELECT * FROM n1 WHERE", ", cleaned AS (SELECT * FROM n1 WHERE", 1) + ")\n" + body_after


@register("clean_panel", _clean_panel_sql("SELECT * FROM cleaned"))
def q_clean_panel(spark, sf):
    return clean.clean_panel(fx.panel_null(spark, sf), "thin", "entity_id", 0.5, [1995])


@register("null_matrix", W(
    "SELECT entity_id, period, entity_name IS NULL AS entity_name, units IS NULL AS units, "
    "spend IS NULL AS spend, disc_pct IS NULL AS disc_pct, thin IS NULL AS thin FROM p", "p"))
def q_null_matrix(spark, sf):
    return clean.null_matrix(fx.panel(spark, sf), ["entity_id", "period"])


# ---------------------------------------------------------------- C: joins and lookups

@register("merge_target", W(
    "SELECT n.*, CAST(t.target AS INTEGER) AS target FROM n JOIN "
    "(SELECT entity_id, period, min(target) AS target FROM t WHERE target IS NOT NULL GROUP BY ALL) t "
    "ON n.entity_id IS NOT DISTINCT FROM t.entity_id AND n.period IS NOT DISTINCT FROM t.period", "n", "t"))
def q_merge_target(spark, sf):
    return joins.merge_target(fx.panel_null(spark, sf), fx.target_side(spark, sf))


@register("anti_entities", W(
    "SELECT * FROM n WHERE entity_id IS NULL OR entity_id NOT IN ("
    "SELECT entity_id FROM n WHERE entity_id IS NOT NULL GROUP BY entity_id HAVING count(thin) = 0)", "n"))
def q_anti_entities(spark, sf):
    n = fx.panel_null(spark, sf)
    empty = n.groupBy("entity_id").agg(F.count("thin").alias("k")).where("k = 0")
    return joins.anti_entities(n, empty, "entity_id")


@register("map_lookup", """
WITH c AS (SELECT c_nationkey, arg_min(c_custkey, c_custkey) AS c_custkey, arg_min(c_acctbal, c_custkey) AS prediction
           FROM customer GROUP BY c_nationkey),
     s AS (SELECT s_nationkey, arg_min(s_suppkey, s_suppkey) AS s_suppkey, arg_min(s_name, s_suppkey) AS s_name,
                  arg_min(s_acctbal, s_suppkey) AS s_acctbal FROM supplier GROUP BY s_nationkey)
SELECT n_nationkey, n_name, c.c_custkey, c.prediction, s.s_suppkey, s.s_name, s.s_acctbal
FROM nation LEFT JOIN c ON c.c_nationkey = n_nationkey LEFT JOIN s ON s.s_nationkey = n_nationkey
""")
def q_map_lookup(spark, sf):
    from ..sources.tables import read_table
    nation = read_table(spark, sf, "nation", ["n_nationkey", "n_name"])
    cust = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey", "c_acctbal"]) \
        .withColumnRenamed("c_acctbal", "prediction")
    supp = read_table(spark, sf, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    return joins.map_lookup(nation, "n_nationkey", cust, "c_nationkey", "c_custkey", ["c_custkey", "prediction"],
                            supp, "s_nationkey", "s_suppkey", ["s_suppkey", "s_name", "s_acctbal"])


@register("cast_label", "SELECT event_id, CAST(trunc(value) AS INTEGER) AS value FROM events")
def q_cast_label(spark, sf):
    return clean.cast_label(read_table(spark, sf, "events", ["event_id", "value"]), "value")


@register("entity_pairs", W("SELECT DISTINCT entity_id, entity_name FROM p", "p"))
def q_entity_pairs(spark, sf):
    return joins.entity_directory(fx.panel(spark, sf))


@register("entity_names", W("SELECT DISTINCT entity_name FROM p WHERE entity_name IS NOT NULL", "p"))
def q_entity_names(spark, sf):
    return joins.entity_names(fx.panel(spark, sf))


@register("entity_id_for", W("SELECT min(entity_id) AS entity_id FROM p WHERE entity_name = 'Customer#000000007'", "p"))
def q_entity_id_for(spark, sf):
    found = joins.entity_id_for(fx.panel(spark, sf), "Customer#000000007")
    return spark.createDataFrame([(found,)], "entity_id bigint")


@register("entity_directory", W(
    "SELECT entity_name, min(entity_id) AS entity_id, count(DISTINCT entity_id) AS n_ids FROM p GROUP BY entity_name",
    "p"))
def q_entity_directory(spark, sf):
    return joins.entity_ids_by_name(fx.panel(spark, sf))


# ---------------------------------------------------------------- D: aggregates and checks

@register("missing_by_entity", W(
    "SELECT entity_id, round(avg(CAST(thin IS NULL AS DOUBLE)) * 100, 6) AS missing_pct FROM p GROUP BY entity_id",
    "p"))
def q_missing_by_entity(spark, sf):
    return profile.missing_by_entity(fx.panel(spark, sf), "thin").withColumn("missing_pct", fround("missing_pct", 6))


@register("missing_by_period", W(
    "SELECT period, round(avg(CAST(thin IS NULL AS DOUBLE)) * 100, 6) AS missing_pct FROM p GROUP BY period", "p"))
def q_missing_by_period(spark, sf):
    return profile.missing_by_period(fx.panel(spark, sf), "thin").withColumn("missing_pct", fround("missing_pct", 6))


@register("missing_by_column", W(
    "SELECT * FROM (" + union_per_column(
        P_COLS, "SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS missing_count, "
                "round((count(*) - count({c})) / count(*) * 100, 2) AS missing_pct FROM p") +
    ") WHERE missing_count > 0", "p"))
def q_missing_by_column(spark, sf):
    return profile.missing_by_column(fx.panel(spark, sf))


@register("missing_cells", W(
    "SELECT CAST(" + " + ".join(f"(count(*) - count({c}))" for c in P_COLS) + " AS BIGINT) AS null_cells, "
    f"CAST(count(*) * {len(P_COLS)} AS BIGINT) AS total_cells, "
    "CASE WHEN count(*) > 0 THEN (" + " + ".join(f"(count(*) - count({c}))" for c in P_COLS) +
    f") / (count(*) * {len(P_COLS)}) * 100 ELSE 0.0 END AS null_pct FROM p", "p"))
def q_missing_cells(spark, sf):
    return profile.missing_cells(fx.panel(spark, sf))


@register("duplicate_rows", W(
    "SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_rows FROM "
    "(SELECT count(*) AS c FROM e GROUP BY user_id, event_type, hr)", "e"))
def q_duplicate_rows(spark, sf):
    return profile.duplicate_rows(fx.events_defects(spark, sf).select("user_id", "event_type", "hr"))


E_FLOATS = ["value", "value_inf", "constant_col"]


@register("inf_by_column", W(
    "SELECT * FROM (" + union_per_column(
        E_FLOATS, "SELECT '{c}' AS \"column\", CAST(count_if(isinf({c})) AS BIGINT) AS inf_count FROM e") +
    ") WHERE inf_count > 0", "e"))
def q_inf_by_column(spark, sf):
    return profile.inf_by_column(fx.events_defects(spark, sf).select("event_id", *E_FLOATS))


E_NUMERIC = ["event_id", "user_id", "hr", "value", "value_inf", "constant_col"]


@register("zero_variance_columns", W(union_per_column(
    E_NUMERIC, "SELECT '{c}' AS \"column\" FROM e HAVING count({c}) > 1 AND min({c}) = max({c})"), "e"))
def q_zero_variance(spark, sf):
    return profile.zero_variance_columns(fx.events_defects(spark, sf).select(*E_NUMERIC))


@register("null_target_count", W("SELECT CAST(count(*) - count(value_inf) AS BIGINT) AS null_target FROM e", "e"))
def q_null_target_count(spark, sf):
    return profile.null_target_count(fx.events_defects(spark, sf), "value_inf")


@register("class_distribution", W(
    "SELECT toxic, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM d GROUP BY toxic", "d"))
def q_class_distribution(spark, sf):
    return profile.class_distribution(fx.doc_classes(spark, sf), "toxic").withColumn("share", fround("share", 6))


@register("positive_weight", W(
    "SELECT CAST(count_if(toxic = 0) AS BIGINT) AS n0, CAST(count_if(toxic = 1) AS BIGINT) AS n1, "
    "round(CASE WHEN count_if(toxic = 1) > 0 THEN count_if(toxic = 0) / count_if(toxic = 1) ELSE 1.0 END, 6) "
    "AS pos_weight FROM d", "d"))
def q_positive_weight(spark, sf):
    return profile.positive_weight(fx.doc_classes(spark, sf), "toxic").withColumn("pos_weight", fround("pos_weight", 6))


@register("describe_panel", W(union_per_column(
    P_MEASURES, "SELECT '{c}' AS \"column\", count({c}) AS \"count\", round(avg({c}), 2) AS mean, "
                "round(stddev_samp({c}), 2) AS std, round(min({c}), 2) AS \"min\", "
                "round(quantile_cont({c}, 0.25), 2) AS p25, round(quantile_cont({c}, 0.5), 2) AS p50, "
                "round(quantile_cont({c}, 0.75), 2) AS p75, round(max({c}), 2) AS \"max\" FROM p"), "p"))
def q_describe_panel(spark, sf):
    return profile.describe_panel(fx.panel(spark, sf), P_MEASURES)


CORR_COLS = ["period", "units", "spend", "disc_pct", "thin"]


@register("correlation_matrix", W(corr_pairs_sql(CORR_COLS, "p"), "p"))
def q_correlation_matrix(spark, sf):
    return profile.correlation_matrix(fx.panel(spark, sf), CORR_COLS)


@register("nullity_correlation", W(nullity_corr_sql(P_MEASURES, "p"), "p"))
def q_nullity_correlation(spark, sf):
    return profile.nullity_correlation(fx.panel(spark, sf), P_COLS)


CLEAN_REPORT_SIDE = ("SELECT count(*) AS rows_{t}, {ncols} AS cols_{t}, "
                     "CAST(count(DISTINCT entity_id) + max(CAST(entity_id IS NULL AS INTEGER)) AS BIGINT) AS entities_{t}, "
                     "CAST({nulls} AS BIGINT) AS null_cells_{t} FROM {src}")


def _cleaning_report_sql():
    nulls = " + ".join(f"(count(*) - count({c}))" for c in P_COLS)
    b = CLEAN_REPORT_SIDE.format(t="before", ncols=len(P_COLS), nulls=nulls, src="n")
    a = CLEAN_REPORT_SIDE.format(t="after", ncols=len(P_COLS), nulls=nulls, src="cleaned")
    body = (f"SELECT *, round(CASE WHEN rows_before * cols_before > 0 THEN null_cells_before / (rows_before * cols_before) * 100 ELSE 0.0 END, 2) AS null_pct_before, "
            f"round(CASE WHEN rows_after * cols_after > 0 THEN null_cells_after / (rows_after * cols_after) * 100 ELSE 0.0 END, 2) AS null_pct_after, "
            f"entities_before - entities_after AS entities_removed, '1995' AS removed_years "
            f"FROM ({b}) CROSS JOIN ({a})")
    return _clean_panel_sql(body)


@register("cleaning_report", _cleaning_report_sql())
def q_cleaning_report(spark, sf):
    n = fx.panel_null(spark, sf)
    return profile.cleaning_report(n, clean.clean_panel(n, "thin", "entity_id", 0.5, [1995]),
                                   "entity_id", [1995])


@register("removed_entities", _clean_panel_sql(
    "SELECT DISTINCT entity_id FROM n WHERE entity_id IS NOT NULL "
    "AND entity_id NOT IN (SELECT entity_id FROM cleaned WHERE entity_id IS NOT NULL)"))
def q_removed_entities(spark, sf):
    n = fx.panel_null(spark, sf)
    return profile.removed_entities(n, clean.clean_panel(n, "thin", "entity_id", 0.5, [1995]))


@register("nullity_distance", W(nullity_distance_sql(P_COLS, "p"), "p"))
def q_nullity_distance(spark, sf):
    return profile.nullity_distance(fx.panel(spark, sf), P_COLS)


@register("integrity_report", W(
    "SELECT * FROM (SELECT (SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM (SELECT count(*) AS c FROM n "
    "GROUP BY ALL_COLS)) AS duplicate_rows, * FROM (".replace("ALL_COLS", ", ".join(P_COLS)) + union_per_column(
        P_COLS, "SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS missing_count, "
                "round((count(*) - count({c})) / count(*) * 100, 2) AS missing_pct FROM n") +
    ")) WHERE missing_count > 0", "n"))
def q_integrity_report(spark, sf):
    return profile.integrity_report(fx.panel_null(spark, sf))


# ---------------------------------------------------------------- E: windows

@register("interpolate_linear", W(interp_sql(P_MEASURES, "n", "entity_id", "period", P_COLS, mode="interp"), "n"))
def q_interpolate_linear(spark, sf):
    return impute.interpolate_linear(fx.panel_null(spark, sf), P_MEASURES)


@register("interpolate_segmented", W(interp_sql(P_MEASURES, "n", "entity_id", "period", P_COLS, mode="interp"), "n"))
def q_interpolate_segmented(spark, sf):
    """The same fill with a bound of rows a window so low that many entities go through the segmented scan."""
    return impute.interpolate_linear(fx.panel_null(spark, sf), P_MEASURES, hot_rows=5)


@register("forward_fill", W(interp_sql(P_MEASURES, "p", "entity_id", "period", P_COLS, mode="ffill"), "p"))
def q_forward_fill(spark, sf):
    return impute.forward_fill(fx.panel(spark, sf), P_MEASURES)


@register("backward_fill", W(interp_sql(P_MEASURES, "p", "entity_id", "period", P_COLS, mode="bfill"), "p"))
def q_backward_fill(spark, sf):
    return impute.backward_fill(fx.panel(spark, sf), P_MEASURES)


@register("lag_features", W(
    "SELECT *, " + ", ".join(
        f"lag({c}, {k}) OVER (PARTITION BY entity_id ORDER BY period) AS {c}_lag{k}"
        for c in ("spend", "units") for k in (1, 2)) + " FROM p", "p"))
def q_lag_features(spark, sf):
    return features.lag_features(fx.panel(spark, sf), ["spend", "units"], [1, 2])


@register("lag_segmented", REGISTRY["lag_features"][1])
def q_lag_segmented(spark, sf):
    return features.lag_features(fx.panel(spark, sf), ["spend", "units"], [1, 2], hot_rows=5)


@register("latest_per_entity", W(
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY period DESC) AS rn "
    "FROM p) WHERE rn = 1", "p"))
def q_latest_per_entity(spark, sf):
    return features.latest_per_entity(fx.panel(spark, sf))


@register("impute_panel", W(interp_sql(P_MEASURES, "p", "entity_id", "period", P_COLS, mode="impute"), "p"))
def q_impute_panel(spark, sf):
    return impute.impute_panel(fx.panel(spark, sf))


# ---------------------------------------------------------------- F: sorts and top-k

@register("sort_panel", W("SELECT * FROM n ORDER BY entity_id NULLS LAST, period NULLS LAST", "n"))
def q_sort_panel(spark, sf):
    from ..operators.topk import sort_panel
    return sort_panel(fx.panel_null(spark, sf))


@register("top_missing_entities", W(
    "SELECT entity_id, round(avg(CAST(thin IS NULL AS DOUBLE)) * 100, 2) AS missing_pct FROM p GROUP BY entity_id "
    "ORDER BY avg(CAST(thin IS NULL AS DOUBLE)) DESC, entity_id LIMIT 15", "p"))
def q_top_missing(spark, sf):
    from ..operators.topk import top_missing_entities
    return top_missing_entities(fx.panel(spark, sf), "thin", n=15)


# ---------------------------------------------------------------- A: record store

REC_COLS = ["id", "client_id", "income", "expenses", "debt", "assets", "prediction", "risk_level"]


@register("append_predictions", W("""SELECT id, client_id, income, expenses, debt, assets, prediction, risk_level FROM r_existing
UNION ALL
SELECT mx.m + row_number() OVER (ORDER BY fresh.client_id) AS id, client_id, income, expenses, debt, assets,
       CAST(NULL AS DOUBLE) AS prediction, CAST(NULL AS VARCHAR) AS risk_level
FROM (SELECT DISTINCT * FROM r_new WHERE client_id NOT IN (SELECT client_id FROM r_existing)) fresh,
     (SELECT max(id) AS m FROM r_existing) mx""", "r_existing", "r_new"))
def q_append_predictions(spark, sf):
    from ..sources.records import append_predictions
    existing, new = fx.prediction_records(spark, sf)
    return append_predictions(existing, new).select(*REC_COLS)


@register("page_predictions", W(
    "SELECT * FROM r_existing ORDER BY id LIMIT 100 OFFSET 10", "r_existing"))
def q_page_predictions(spark, sf):
    from ..sources.records import page
    existing, _ = fx.prediction_records(spark, sf)
    return page(existing.select(*REC_COLS), skip=10, limit=100)


# ---------------------------------------------------------------- D: evaluation

@register("prediction_counts", W("SELECT pred, count(*) AS \"count\" FROM m GROUP BY pred", "m"))
def q_prediction_counts(spark, sf):
    from ..operators.metrics import prediction_counts
    return prediction_counts(fx.scored(spark, sf), "pred")


@register("kpis", W("SELECT (SELECT count(*) FROM p) AS row_count, (SELECT count(DISTINCT entity_id) FROM p) AS entity_count, "
                    "(SELECT count(*) FROM m) AS prediction_count", "p", "m"))
def q_kpis(spark, sf):
    from ..operators.metrics import kpis
    return kpis(fx.panel(spark, sf), fx.scored(spark, sf))


@register("confusion_counts", W("SELECT y, pred, count(*) AS n FROM m GROUP BY y, pred", "m"))
def q_confusion_counts(spark, sf):
    from ..operators.metrics import confusion_counts
    return confusion_counts(fx.scored(spark, sf))


REPORT_SQL = """, conf AS (SELECT y, pred, count(*) AS n FROM m GROUP BY y, pred),
labs AS (SELECT y AS label FROM conf UNION SELECT pred FROM conf),
per AS (SELECT l.label,
          coalesce((SELECT sum(n) FROM conf WHERE y = l.label AND pred = l.label), 0) AS tp,
          coalesce((SELECT sum(n) FROM conf WHERE y = l.label), 0) AS support,
          coalesce((SELECT sum(n) FROM conf WHERE pred = l.label), 0) AS predicted FROM labs l),
per2 AS (SELECT CAST(label AS VARCHAR) AS label,
          CASE WHEN predicted > 0 THEN CAST(tp AS DOUBLE) / predicted ELSE 0.0 END AS precision,
          CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / support ELSE 0.0 END AS recall,
          CAST(support AS DOUBLE) AS support, tp FROM per),
per3 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1_score FROM per2),
rep AS (
SELECT label, precision, recall, f1_score, support FROM per3
UNION ALL SELECT 'macro avg', sum(precision) / count(*), sum(recall) / count(*), sum(f1_score) / count(*), sum(support) FROM per3
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                 sum(f1_score * support) / sum(support), sum(support) FROM per3
UNION ALL SELECT 'accuracy', NULL, NULL, CAST(sum(tp) AS DOUBLE) / sum(support), sum(support) FROM per3),
rep6 AS (SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score,
                support FROM rep)
"""


def _m_with(body: str) -> str:
    text = W("SELECT 1", "m")
    return text[: text.rindex("SELECT 1")].rstrip() + REPORT_SQL + body


def _report(spark, sf):
    from ..operators.metrics import classification_report
    rep = classification_report(fx.scored(spark, sf))
    return rep.select("label", *[fround(c, 6).alias(c) for c in ("precision", "recall", "f1_score")], "support")


@register("classification_report", _m_with("SELECT * FROM rep6"))
def q_classification_report(spark, sf):
    return _report(spark, sf)


@register("metrics_long", _m_with(" UNION ALL ".join(
    f"SELECT 'm_fixture' AS run_id, 'rule' AS model, 'metric' AS kind, "
    f"label || '_{m}' AS key, "
    f"CAST({m} AS DOUBLE) AS value FROM rep6 WHERE {m} IS NOT NULL"
    for m in ("precision", "recall", "f1_score", "support"))))
def q_metrics_long(spark, sf):
    from ..operators.metrics import metrics_long
    return metrics_long(_report(spark, sf), "m_fixture", "rule")


ROC_BASE = """, s AS (SELECT score AS threshold, sum(y) AS tp, sum(1 - y) AS fp FROM m WHERE score IS NOT NULL GROUP BY score),
c AS (SELECT threshold, tp, fp, row_number() OVER (ORDER BY threshold DESC) - 1 AS i,
             sum(tp) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ctp,
             sum(fp) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cfp FROM s),
tot AS (SELECT CAST(sum(y) AS DOUBLE) AS P, CAST(sum(1 - y) AS DOUBLE) AS N FROM m)
"""


def _roc_with(body: str) -> str:
    text = W("SELECT 1", "m")
    return text[: text.rindex("SELECT 1")].rstrip() + ROC_BASE + body


@register("roc_curve", _roc_with("""
, k AS (SELECT *, lag(ctp) OVER (ORDER BY i) AS p_tp, lag(cfp) OVER (ORDER BY i) AS p_fp,
               lead(ctp) OVER (ORDER BY i) AS n_tp, lead(cfp) OVER (ORDER BY i) AS n_fp, max(i) OVER () AS last_i FROM c),
kept AS (SELECT threshold, i, ctp, cfp FROM k WHERE i = 0 OR i = last_i OR n_fp - 2 * cfp + p_fp <> 0 OR n_tp - 2 * ctp + p_tp <> 0
         UNION ALL SELECT CAST(NULL AS DOUBLE), -1, 0, 0)
SELECT CAST(i + 1 AS BIGINT) AS idx, threshold, round(CAST(cfp AS DOUBLE) / N, 6) AS fpr, round(CAST(ctp AS DOUBLE) / P, 6) AS tpr
FROM kept, tot"""))
def q_roc_curve(spark, sf):
    from ..operators.metrics import roc_curve
    r = roc_curve(fx.scored(spark, sf))
    return r.select("idx", "threshold", fround("fpr", 6).alias("fpr"), fround("tpr", 6).alias("tpr"))


@register("roc_auc", _roc_with(
    "SELECT round(sum(fp * (ctp - CAST(tp AS DOUBLE) / 2.0)) / CAST(sum(tp) * sum(fp) AS DOUBLE), 6) AS auc FROM c"))
def q_roc_auc(spark, sf):
    from ..operators.metrics import roc_auc
    return roc_auc(fx.scored(spark, sf)).select(fround("auc", 6).alias("auc"))


# ---------------------------------------------------------------- G: splits and folds

def _u_sql(key: str, seed: int = 42) -> str:
    from ..functions.exprs import hash_uniform_sql
    return hash_uniform_sql(key, seed)


D_COLS = ["doc_id", "n_chars", "n_words", "n_lines", "lang", "quality", "toxic"]


@register("stratified_split", W(
    f"SELECT {', '.join(D_COLS)}, CASE WHEN row_number() OVER (PARTITION BY toxic ORDER BY u, doc_id) - 1 "
    f"< round(0.2 * count(*) OVER (PARTITION BY toxic)) THEN 'test' ELSE 'train' END AS split "
    f"FROM (SELECT *, {_u_sql('doc_id')} AS u FROM d)", "d"))
def q_stratified_split(spark, sf):
    from ..operators.split import stratified_split
    return stratified_split(fx.doc_classes(spark, sf), "toxic", "doc_id", 0.2, 42)


@register("stratified_folds", W(
    f"SELECT {', '.join(D_COLS)}, CAST((row_number() OVER (PARTITION BY toxic ORDER BY u, doc_id) - 1) % 5 AS INTEGER) AS fold "
    f"FROM (SELECT *, {_u_sql('doc_id')} AS u FROM d)", "d"))
def q_stratified_folds(spark, sf):
    from ..operators.split import stratified_folds
    return stratified_folds(fx.doc_classes(spark, sf), "toxic", "doc_id", 5, 42)


@register("temporal_split", W(
    "SELECT entity_id, entity_name, units, spend, disc_pct, thin, "
    "CASE WHEN period < 1999 THEN 'train' ELSE 'test' END AS split FROM p WHERE period IS NOT NULL", "p"))
def q_temporal_split(spark, sf):
    from ..operators.split import temporal_split
    return temporal_split(fx.panel(spark, sf), "period", 1999)


@register("expanding_folds", W("""SELECT fold, role, period, count(*) AS n_rows FROM p JOIN (
  SELECT CAST(fold AS INTEGER) AS fold, period,
         CASE WHEN pi < np - 5 * (np // 6) + fold * (np // 6) THEN 'train'
              WHEN pi < np - 5 * (np // 6) + (fold + 1) * (np // 6) THEN 'test' END AS role
  FROM (SELECT period, row_number() OVER (ORDER BY period) - 1 AS pi, count(*) OVER () AS np
        FROM (SELECT DISTINCT period FROM p WHERE period IS NOT NULL)) per,
       (SELECT range AS fold FROM range(5)) folds) fp USING (period)
WHERE role IS NOT NULL GROUP BY fold, role, period""", "p"))
def q_expanding_folds(spark, sf):
    from ..operators.split import expanding_folds, fold_rows
    p = fx.panel(spark, sf)
    return fold_rows(p, expanding_folds(p, "period", 5)).groupBy("fold", "role", "period") \
        .agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------- H: feature preparation

def _h1_sql():
    med = ", ".join(f"median({c}) AS md_{c}" for c in P_MEASURES)
    fill = ", ".join(f"coalesce({c}, md_{c}) AS {c}" for c in P_MEASURES)
    mom = ", ".join(f"avg({c}) AS mn_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS sd_{c}"
                    for c in P_MEASURES)
    out = ", ".join(f"round((coalesce({c}, md_{c}) - mn_{c}) / sd_{c}, 6) AS {c}" for c in P_MEASURES)
    return W(f"SELECT entity_id, entity_name, period, {out} FROM p, (SELECT {med} FROM p WHERE period < 1999) med, "
             f"(SELECT {mom} FROM (SELECT {fill} FROM p, (SELECT {med} FROM p WHERE period < 1999) m2 "
             f"WHERE period < 1999)) mom", "p")


@register("median_impute_scale", _h1_sql())
def q_median_impute_scale(spark, sf):
    p = stored(fx.panel(spark, sf), "panel")   # read by several passes: medians, moments, apply
    out = features.median_impute_scale(p.where(F.col("period") < 1999), p, P_MEASURES, stored=True)
    return out.select(*[fround(c, 6).alias(c) if c in P_MEASURES else F.col(c) for c in out.columns])


@register("standard_scale", W(
    "SELECT entity_id, entity_name, period, " + ", ".join(
        f"round(({c} - mn_{c}) / sd_{c}, 6) AS {c}" for c in P_MEASURES) + " FROM p, (SELECT " + ", ".join(
        f"avg({c}) AS mn_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS sd_{c}"
        for c in P_MEASURES) + " FROM p) s", "p"))
def q_standard_scale(spark, sf):
    out = features.standard_scale(fx.panel(spark, sf), P_MEASURES)
    return out.select(*[fround(c, 6).alias(c) if c in P_MEASURES else F.col(c) for c in out.columns])


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@register("one_hot", W("SELECT event_id, " + ", ".join(
    f"CAST(event_type = '{v}' AS INTEGER) AS event_type_{v}" for v in EVENT_TYPES) + " FROM e", "e"))
def q_one_hot(spark, sf):
    return features.one_hot(fx.events_defects(spark, sf).select("event_id", "event_type"), ["event_type"])


# ---------------------------------------------------------------- I: forecasting (linear model)

# Model coefficients are rounded to about ten significant digits so that both engines apply
# the identical model (their regression sums agree only to ~1e-15 relative):
# spend on spend_lag1 slope ~0.3 -> 10 decimals; intercept and the spend-per-unit slope
# ~1e5 -> 4 decimals.
SLOPE_DP, ICPT_DP, UNIT_SLOPE_DP = 10, 4, 4
LIN_SQL = (f", lin AS (SELECT round(regr_slope(spend, spend_lag1), {SLOPE_DP}) AS b, "
           f"round(regr_intercept(spend, spend_lag1), {ICPT_DP}) AS a, "
           f"round(regr_slope(spend, units), {UNIT_SLOPE_DP}) AS g FROM f)\n")


def _f_with(body: str) -> str:
    text = W("SELECT 1", "f")
    return text[: text.rindex("SELECT 1")].rstrip() + LIN_SQL + body


def _lin_model(fdf):
    from ..operators.forecast import LinearModel
    row = fdf.agg(fround(F.regr_slope("spend", "spend_lag1"), SLOPE_DP).alias("b"),
                  fround(F.regr_intercept("spend", "spend_lag1"), ICPT_DP).alias("a"),
                  fround(F.regr_slope("spend", "units"), UNIT_SLOPE_DP).alias("g")).first()
    return row, LinearModel(row["a"], {"spend_lag1": row["b"]})


@register("linear_fit", _f_with("SELECT b AS slope, a AS intercept FROM lin"))
def q_linear_fit(spark, sf):
    row, _ = _lin_model(fx.forecast_base(spark, sf))
    return spark.createDataFrame([(row["b"], row["a"])], "slope double, intercept double")


@register("regression_metrics", _f_with(
    "SELECT round(1 - avg((spend - (a + b * spend_lag1)) * (spend - (a + b * spend_lag1))) / var_pop(spend), 6) AS r2, "
    "round(avg(abs(spend - (a + b * spend_lag1))), 6) AS mae, "
    "round(sqrt(avg((spend - (a + b * spend_lag1)) * (spend - (a + b * spend_lag1)))), 6) AS rmse "
    "FROM f, lin WHERE spend_lag1 IS NOT NULL"))
def q_regression_metrics(spark, sf):
    from ..operators.metrics import regression_metrics
    fdf = fx.forecast_base(spark, sf)
    _, model = _lin_model(fdf)
    scored = model.predict(fdf.where(F.col("spend_lag1").isNotNull()), "prediction")
    m = regression_metrics(scored, "spend", "prediction")
    return m.select(*[fround(c, 6).alias(c) for c in m.columns])


FC_SQL = """, last AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY period DESC) AS rn FROM f) WHERE rn = 1),
s1 AS (SELECT entity_id, period, a + b * spend_lag1 AS p1, spend AS y0, a, b FROM last, lin),
s2 AS (SELECT *, a + b * y0 AS p2 FROM s1),
s3 AS (SELECT *, a + b * p1 AS p3 FROM s2),
s4 AS (SELECT *, a + b * p2 AS p4 FROM s3),
s5 AS (SELECT *, a + b * p3 AS p5 FROM s4),
fc AS (SELECT entity_id, CAST(period + 1 AS INTEGER) AS period, 1 AS step, p1 AS prediction FROM s5
  UNION ALL SELECT entity_id, CAST(period + 2 AS INTEGER), 2, p2 FROM s5
  UNION ALL SELECT entity_id, CAST(period + 3 AS INTEGER), 3, p3 FROM s5
  UNION ALL SELECT entity_id, CAST(period + 4 AS INTEGER), 4, p4 FROM s5
  UNION ALL SELECT entity_id, CAST(period + 5 AS INTEGER), 5, p5 FROM s5)
"""


def _forecast(spark, sf, fdf=None):
    from ..operators.forecast import forecast_recursive
    fdf = fdf if fdf is not None else fx.forecast_base(spark, sf)
    _, model = _lin_model(fdf)
    return forecast_recursive(fdf, model, 5, "spend", {"spend": 1}, align="reference")


@register("forecast_recursive", _f_with(FC_SQL + "SELECT entity_id, period, CAST(step AS INTEGER) AS step, "
                                        "round(prediction, 4) AS prediction FROM fc"))
def q_forecast_recursive(spark, sf):
    return _forecast(spark, sf).withColumn("prediction", fround("prediction", 4))


@register("latest_forecast", _f_with(FC_SQL + "SELECT entity_id, max(period) AS period, "
                                     "round(arg_max(prediction, period), 4) AS prediction FROM fc GROUP BY entity_id"))
def q_latest_forecast(spark, sf):
    from ..operators.topk import latest_forecast
    return latest_forecast(_forecast(spark, sf)).withColumn("prediction", fround("prediction", 4))


@register("history_with_forecast", _f_with(FC_SQL + """SELECT entity_id, period, spend AS actual, CAST(NULL AS DOUBLE) AS fitted, CAST(NULL AS DOUBLE) AS forecast FROM f
UNION ALL SELECT entity_id, period, NULL, round(a + b * spend_lag1, 4), NULL FROM f, lin
UNION ALL SELECT entity_id, period, NULL, NULL, round(prediction, 4) FROM fc"""))
def q_history_with_forecast(spark, sf):
    from ..operators.forecast import history_with_forecast
    fdf = fx.forecast_base(spark, sf)
    _, model = _lin_model(fdf)
    fitted = model.predict(fdf, "prediction").withColumn("prediction", fround("prediction", 4))
    fut = _forecast(spark, sf, fdf).withColumn("prediction", fround("prediction", 4))
    return history_with_forecast(fdf, fitted, fut, "spend")


STRESS_SQL = """, last AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY period DESC) AS rn FROM f) WHERE rn = 1),
sc AS (SELECT * FROM (VALUES ('base', NULL), ('stress', -2.0)) t(scenario, shock)),
y1 AS (SELECT entity_id, scenario, period, coalesce(CAST(shock AS DOUBLE), units) AS shock,
              a + b * spend_lag1 + g * units AS p1, a, b, g FROM last, sc, lin),
y2 AS (SELECT *, a + b * p1 + g * shock AS p2 FROM y1),
y3 AS (SELECT *, a + b * p2 + g * shock AS p3 FROM y2)
"""


@register("stress_scenarios", _f_with(STRESS_SQL + """SELECT entity_id, scenario, CAST(period + 1 AS INTEGER) AS period, 1 AS step, round(p1, 4) AS prediction FROM y3
UNION ALL SELECT entity_id, scenario, CAST(period + 2 AS INTEGER), 2, round(p2, 4) FROM y3
UNION ALL SELECT entity_id, scenario, CAST(period + 3 AS INTEGER), 3, round(p3, 4) FROM y3"""))
def q_stress_scenarios(spark, sf):
    from ..operators.forecast import LinearModel, stress_scenarios
    fdf = fx.forecast_base(spark, sf)
    row, _ = _lin_model(fdf)
    model = LinearModel(row["a"], {"spend_lag1": row["b"], "units": row["g"]})
    out = stress_scenarios(fdf, model, {"base": None, "stress": -2.0}, 3, target="spend", driver="units",
                           carried_lags={"units": "units_lag1", "disc_pct": "disc_pct_lag1"},
                           target_lag="spend_lag1")
    return out.withColumn("prediction", fround("prediction", 4))


@register("attributions_linear", _f_with("""SELECT entity_id, period, 'spend_lag1' AS feature,
  round(b * (spend_lag1 - (SELECT avg(spend_lag1) FROM f WHERE spend_lag1 IS NOT NULL)), 4) AS contribution
FROM f, lin WHERE spend_lag1 IS NOT NULL
UNION ALL SELECT entity_id, period, 'units', round(g * (units - (SELECT avg(units) FROM f WHERE spend_lag1 IS NOT NULL)), 4)
FROM f, lin WHERE spend_lag1 IS NOT NULL"""))
def q_attributions_linear(spark, sf):
    from ..operators.forecast import LinearModel
    from ..operators.models import linear_attributions
    base = fx.forecast_base(spark, sf)
    fdf = base.where(F.col("spend_lag1").isNotNull())
    row, _ = _lin_model(base)
    model = LinearModel(row["a"], {"spend_lag1": row["b"], "units": row["g"]})
    out = linear_attributions(fdf, model, ["entity_id", "period"])
    return out.withColumn("contribution", fround("contribution", 4))


# ---------------------------------------------------------------- H: balancing

SMOTE_COLS = ["n_chars", "n_words", "n_lines"]


def _smote_sql() -> str:
    from ..functions.exprs import hash_uniform_sql
    u = lambda salt: hash_uniform_sql("j", 42, f"1:{salt}")
    feats = ", ".join(SMOTE_COLS)
    dist = " + ".join(f"(b.{c} - a.{c}) * (b.{c} - a.{c})" for c in SMOTE_COLS)
    syn = ", ".join(f"round(x.{c} + dr.step * (nb.{c} - x.{c}), 6) AS {c}" for c in SMOTE_COLS)
    body = f""", mn AS (SELECT doc_id, {feats}, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM d WHERE toxic = 1),
cnt AS (SELECT CAST(count_if(toxic = 0) - count_if(toxic = 1) AS BIGINT) AS n_new, CAST(count_if(toxic = 1) AS BIGINT) AS n_min FROM d),
dr AS (SELECT j, CAST(floor({u('row')} * n_min) AS BIGINT) AS pos, CAST(floor({u('nn')} * 5) + 1 AS INTEGER) AS rnk,
              {u('step')} AS step FROM cnt, (SELECT range AS j FROM range((SELECT n_new FROM cnt))) g),
nnr AS (SELECT a.pos, b.doc_id, {', '.join('b.' + c for c in SMOTE_COLS)},
               row_number() OVER (PARTITION BY a.pos ORDER BY {dist}, b.doc_id) AS rk
        FROM mn a JOIN mn b ON a.doc_id <> b.doc_id WHERE a.pos IN (SELECT pos FROM dr))
SELECT CAST(doc_id AS BIGINT) AS sample_id, {', '.join(f'round({c}, 6) AS {c}' for c in SMOTE_COLS)}, toxic, false AS synthetic FROM d
UNION ALL
SELECT -(dr.j + 1) AS sample_id, {syn}, 1 AS toxic, true AS synthetic
FROM dr JOIN mn x ON x.pos = dr.pos JOIN nnr nb ON nb.pos = dr.pos AND nb.rk = dr.rnk"""
    text = W("SELECT 1", "d")
    return text[: text.rindex("SELECT 1")].rstrip() + body


def _smote(spark, sf):
    from ..operators.balance import smote
    return smote(fx.doc_classes(spark, sf), "toxic", SMOTE_COLS, "doc_id", k=5, seed=42)


@register("smote", _smote_sql())
def q_smote(spark, sf):
    out = _smote(spark, sf)
    # one column of ids: the documents' own ones, and negative numbers for synthetic rows
    return out.select(F.coalesce(F.col("sample_id").cast("long"), -F.col("synthetic_id")).alias("sample_id"),
                      *[fround(c, 6).alias(c) for c in SMOTE_COLS], "toxic", "synthetic")


@register("balance_counts", W(
    "SELECT toxic, count(*) AS rows_before, max(n_maj) AS rows_after FROM d, "
    "(SELECT max(c) AS n_maj FROM (SELECT count(*) AS c FROM d GROUP BY toxic)) GROUP BY toxic", "d"))
def q_balance_counts(spark, sf):
    from ..operators.balance import balance_counts
    d = fx.doc_classes(spark, sf)
    return balance_counts(d, _smote(spark, sf), "toxic")


# ---------------------------------------------------------------- J: streaming

def _event_rule(df: DataFrame) -> DataFrame:
    """Rule scorer shared by the stream and the batch check: high-value events are risky."""
    return df.select("user_id", "event_id", "event_type", "value",
                     F.when(F.col("value") >= 50, 1.0).otherwise(0.0).alias("prediction"))


@register("stream_score", """SELECT user_id, event_id, event_type, value, CASE WHEN value >= 50 THEN 1.0 ELSE 0.0 END AS prediction
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def q_stream_score(spark, sf):
    from ..streaming.scoring import stream_score
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    root = scratch_path(spark, "stream")
    return stream_score(spark, sf, schema, _event_rule, f"{root}/store", f"{root}/_checkpoint",
                        key="user_id", event_time="ts", tie="event_id", path_glob="events.parquet").drop("_epoch")


# ---------------------------------------------------------------- H: Spark ML models (rows-only checks)

D_FEATS = ["n_chars", "n_words", "n_lines", "quality"]


def _d_split(spark, sf):
    from ..operators.split import stratified_split, train_test
    return train_test(stratified_split(fx.doc_classes(spark, sf), "toxic", "doc_id", 0.2, 42))


def _scored_test(model, test, keys):
    from ..operators.models import score_batch
    return score_batch(test.select(*keys, *D_FEATS), model).select(*keys, "prediction")


@register("train_boosted", None)
def q_train_boosted(spark, sf):
    from ..operators.models import train_boosted
    from ..operators.profile import positive_weight
    train, test = _d_split(spark, sf)
    w = positive_weight(train, "toxic").first()["pos_weight"]
    model = train_boosted(train, "toxic", D_FEATS, {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.1},
                          pos_weight=w)
    return _scored_test(model, test, ["doc_id", "toxic"])


@register("train_additive", None)
def q_train_additive(spark, sf):
    from ..operators.models import train_additive
    train, test = _d_split(spark, sf)
    return _scored_test(train_additive(train, "toxic", D_FEATS, {"n_estimators": 10}), test, ["doc_id", "toxic"])


@register("train_mlp", None)
def q_train_mlp(spark, sf):
    from ..operators.models import train_mlp
    from ..operators.features import standard_scale
    d = standard_scale(fx.doc_classes(spark, sf), D_FEATS)
    from ..operators.split import stratified_split, train_test
    train, test = train_test(stratified_split(d, "toxic", "doc_id", 0.2, 42))
    return _scored_test(train_mlp(train, "toxic", D_FEATS, hidden=(8, 4), max_iter=30), test, ["doc_id", "toxic"])


F_FEATS = ["spend_lag1", "units_lag1", "disc_pct_lag1", "units", "disc_pct"]


def _f_temporal(spark, sf):
    fdf = fx.forecast_base(spark, sf).where(F.col("spend_lag1").isNotNull())
    return fdf.where(F.col("period") < 2000), fdf.where(F.col("period") >= 2000)


@register("train_forest_regressor", None)
def q_train_forest_regressor(spark, sf):
    from ..operators.metrics import regression_metrics
    from ..operators.models import score_batch, train_forest_regressor
    train, test = _f_temporal(spark, sf)
    model = train_forest_regressor(train, "spend", F_FEATS, {"n_estimators": 10, "maxDepth": 5})
    return regression_metrics(score_batch(test, model), "spend", "prediction")


@register("train_boosted_regressor", None)
def q_train_boosted_regressor(spark, sf):
    from ..operators.models import score_batch, train_boosted_regressor
    train, test = _f_temporal(spark, sf)
    model = train_boosted_regressor(train, "spend", F_FEATS, {"n_estimators": 10})
    return score_batch(test.select("entity_id", "period", "spend", *F_FEATS), model)


@register("train_linear_ml", None)
def q_train_linear_ml(spark, sf):
    from ..operators.models import train_linear
    train, _ = _f_temporal(spark, sf)
    lr = train_linear(train, "spend", F_FEATS).stages[-1]
    rows = [("intercept", float(lr.intercept))] + [(f, float(c)) for f, c in zip(F_FEATS, lr.coefficients.toArray())]
    return spark.createDataFrame(rows, "term string, coefficient double")


def _boosted_model(spark, sf):
    from ..operators.models import train_boosted
    train, test = _d_split(spark, sf)
    return train_boosted(train, "toxic", D_FEATS, {"n_estimators": 10, "max_depth": 3}), train, test


@register("feature_importance", None)
def q_feature_importance(spark, sf):
    from ..operators.models import feature_importance
    model, _, _ = _boosted_model(spark, sf)
    return feature_importance(model, D_FEATS, spark)


@register("top_importances", None)
def q_top_importances(spark, sf):
    from ..operators.models import feature_importance
    from ..operators.topk import top_importances
    model, _, _ = _boosted_model(spark, sf)
    return top_importances(feature_importance(model, D_FEATS, spark), 15)


@register("attributions_stumps", None)
def q_attributions_stumps(spark, sf):
    from ..operators.models import mean_abs_attribution, stump_attributions, train_additive
    train, test = _d_split(spark, sf)
    model = train_additive(train, "toxic", D_FEATS, {"n_estimators": 10})
    return mean_abs_attribution(stump_attributions(test, model, D_FEATS, ["doc_id"]))


RULE_SQL = "SELECT *, CASE WHEN disc_pct > 5.0 THEN 1.0 ELSE 0.0 END AS prediction FROM __THIS__"


@register("score_batch_rule", W(
    "SELECT entity_id, period, units, spend, disc_pct, CASE WHEN disc_pct > 5.0 THEN 1.0 ELSE 0.0 END AS prediction "
    "FROM p", "p"))
def q_score_batch_rule(spark, sf):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer
    from ..operators.models import score_batch
    model = PipelineModel(stages=[SQLTransformer(statement=RULE_SQL)])
    return score_batch(fx.panel(spark, sf), model, drop=["entity_name", "thin"])


@register("score_records", """SELECT c_name AS client_id,
  CAST(CASE WHEN c_acctbal * 0.25 > c_acctbal * 2.0 - 1000.0 THEN 1.0 ELSE 0.0 END AS INTEGER) AS prediction
FROM customer""")
def q_score_records(spark, sf):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer
    from ..operators.models import score_records
    from ..sources.tables import read_table
    cust = read_table(spark, sf, "customer", ["c_name", "c_acctbal"])
    bal = F.col("c_acctbal")
    records = cust.select(F.col("c_name").alias("client_id"),
                          F.create_map(F.lit("income"), bal, F.lit("expenses"), bal * 0.5,
                                       F.lit("debt"), bal * 0.25, F.lit("assets"), bal * 2.0).alias("features"))
    rule = PipelineModel(stages=[SQLTransformer(
        statement="SELECT *, CASE WHEN debt > assets - 1000.0 THEN 1.0 ELSE 0.0 END AS prediction FROM __THIS__")])
    return score_records(records, {"rule": rule}, "rule", ["income", "expenses", "debt", "assets"])


@register("tune_cv", None)
def q_tune_cv(spark, sf):
    from ..operators.models import tune
    from ..operators.split import grid_params, stratified_folds
    d = stratified_folds(fx.doc_classes(spark, sf), "toxic", "doc_id", 3, 42)
    maps = grid_params({"max_depth": [2, 3], "n_estimators": [5]})
    _, scores = tune(d, "toxic", D_FEATS, "xgb", maps, "fold", parallelism=2)
    return spark.createDataFrame([(i, str(m), float(s)) for i, (m, s) in enumerate(zip(maps, scores))],
                                 "param_map int, params string, mean_auc double")


@register("forecast_ml", None)
def q_forecast_ml(spark, sf):
    from ..operators.forecast import SparkModelAdapter, forecast_recursive
    from ..operators.models import train_boosted_regressor
    fdf = fx.forecast_base(spark, sf)
    train = fdf.where(F.col("spend_lag1").isNotNull())
    model = train_boosted_regressor(train, "spend", ["spend_lag1", "units"], {"n_estimators": 5}).stages[-1]
    return forecast_recursive(fdf, SparkModelAdapter(model, ["spend_lag1", "units"]), 4, "spend", {"spend": 1})


@register("train_pipeline", None)
def q_train_pipeline(spark, sf):
    from ..operators.workflow import train_pipeline
    res = train_pipeline(fx.doc_classes(spark, sf), "toxic", ["n_chars", "n_words", "n_lines"], "doc_id",
                         model="xgb", param_maps=[{"max_depth": 2, "n_estimators": 5}], folds=5,
                         registry_root=scratch_path(spark, "models"))
    return res.metrics


@register("permutation_importance", None)
def q_permutation_importance(spark, sf):
    from ..operators.models import permutation_importance
    model, _, test = _boosted_model(spark, sf)
    return permutation_importance(test, model, D_FEATS, "toxic", "doc_id", kind="classifier")


@register("tune_expanding", None)
def q_tune_expanding(spark, sf):
    from ..operators.models import tune_expanding
    from ..operators.split import expanding_folds, grid_params
    fdf = fx.forecast_base(spark, sf).where(F.col("spend_lag1").isNotNull())
    folds = expanding_folds(fdf, "period", 3)
    maps = grid_params({"n_estimators": [5], "maxDepth": [3, 5]})
    _, scores = tune_expanding(fdf, "spend", F_FEATS, maps, folds, kind="forest")
    return spark.createDataFrame([(i, str(maps[i]), float(s)) for i, s in scores],
                                 "param_map int, params string, mean_r2 double")


@register("search_halving", None)
def q_search_halving(spark, sf):
    """Twenty draws of the boosted classifier's whole search space over five folds, by successive halving."""
    from ..operators.models import BOOSTED_SPACE, tune_halving
    from ..operators.split import random_params, stratified_folds
    d = stratified_folds(fx.doc_classes(spark, sf), "toxic", "doc_id", 5, 42)
    maps = random_params(BOOSTED_SPACE, 20, 42)
    _, history = tune_halving(d, "toxic", D_FEATS, maps, "fold")
    return spark.createDataFrame([(r, i, str(maps[i]), n, float(s)) for r, i, n, s in history],
                                 "rung int, param_map int, params string, trees int, mean_auc double")
