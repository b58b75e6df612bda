"""Oracle-side (DuckDB) definitions of the derived fixtures, as CTE bodies.

Each string defines the same rows as the Spark builder of the same name in
``strata.sources.fixtures``; oracle queries are written as ``WITH p AS (...) SELECT ...``.
"""

P = """
WITH o AS (SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS period,
                  CAST(COUNT(*) AS DOUBLE) AS units,
                  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend
           FROM orders GROUP BY o_custkey, year(o_orderdate)),
     l AS (SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS period,
                  CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) * 100
                  / CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS disc_pct
           FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey, year(o_orderdate)),
     y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS period FROM orders)
SELECT c_custkey AS entity_id, c_name AS entity_name, y.period, o.units, o.spend, l.disc_pct,
       CASE WHEN c_custkey % 10 <> 0 THEN o.spend END AS thin
FROM customer CROSS JOIN y
LEFT JOIN o ON o.o_custkey = c_custkey AND o.period = y.period
LEFT JOIN l ON l.o_custkey = c_custkey AND l.period = y.period
"""

N = """
SELECT CASE WHEN entity_id % 50 = 0 THEN NULL ELSE entity_id END AS entity_id,
       entity_name, period, units, spend, disc_pct, thin FROM p
"""

T = """
SELECT entity_id, period, CAST(units AS INTEGER) AS target FROM n
WHERE entity_id IS NULL OR entity_id % 3 <> 0
"""

E = """
SELECT event_id, user_id, event_type, CAST(hour(ts) AS INTEGER) AS hr, CAST(ts AS DATE) AS day, value,
       CASE WHEN event_id % 7 = 0 THEN 'n/a' WHEN event_id % 11 = 0 THEN '' WHEN event_id % 13 = 0 THEN '1,000'
            WHEN event_id % 17 = 0 THEN '1d' WHEN event_id % 19 = 0 THEN ' 5 ' ELSE CAST(value AS VARCHAR) END AS value_text,
       CASE WHEN event_id % 97 = 0 THEN CAST('inf' AS DOUBLE) WHEN event_id % 89 = 0 THEN CAST('-inf' AS DOUBLE)
            WHEN event_id % 83 = 0 THEN NULL ELSE value END AS value_inf,
       CAST(7.0 AS DOUBLE) AS constant_col
FROM events
"""

D = """
SELECT doc_id, CAST(n_chars AS DOUBLE) AS n_chars,
       CAST(length(text) - length(replace(text, ' ', '')) + 1 AS DOUBLE) AS n_words,
       CAST(length(text) - length(replace(text, chr(10), '')) AS DOUBLE) AS n_lines,
       lang, quality, toxic
FROM labels JOIN documents USING (doc_id)
"""

M = """
SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y,
       CASE WHEN value >= 50 THEN 1 ELSE 0 END AS pred,
       round(value, 0) / 500.0 AS score
FROM events
"""

R_EXISTING = """
SELECT CAST(c_custkey AS BIGINT) AS id, c_name AS client_id, c_acctbal AS income, c_acctbal * 0.5 AS expenses,
       c_acctbal * 0.25 AS debt, c_acctbal * 2.0 AS assets,
       CAST(NULL AS DOUBLE) AS prediction, CAST(NULL AS VARCHAR) AS risk_level
FROM customer WHERE c_custkey % 2 = 0
"""

R_NEW = """
SELECT c_name AS client_id, c_acctbal AS income, c_acctbal * 0.5 AS expenses, c_acctbal * 0.25 AS debt,
       c_acctbal * 2.0 AS assets FROM customer
UNION ALL
SELECT c_name AS client_id, c_acctbal AS income, c_acctbal * 0.5 AS expenses, c_acctbal * 0.25 AS debt,
       c_acctbal * 2.0 AS assets FROM customer WHERE c_custkey % 5 = 0
"""


def with_ctes(body: str, *names: str) -> str:
    """``WITH`` clause of the named fixtures (in dependency order) followed by ``body``."""
    deps = {"n": ["p"], "t": ["p", "n"], "f": ["p"]}
    order: list[str] = []
    for n in names:
        for d in deps.get(n, []) + [n]:
            if d not in order:
                order.append(d)
    defs = {"p": P, "n": N, "t": T, "e": E, "d": D, "m": M, "r_existing": R_EXISTING, "r_new": R_NEW}
    extra = {k: v for k, v in EXTRA.items()}
    parts = []
    for n in order:
        text = defs.get(n) or extra[n]
        parts.append(f"{n} AS ({text})")
    return "WITH " + ",\n".join(parts) + "\n" + body


def _f_sql() -> str:
    from .sqlgen import interp_sql
    cols = ["entity_id", "entity_name", "period", "units", "spend", "disc_pct"]
    imp = interp_sql(["units", "spend", "disc_pct"], "p", "entity_id", "period", cols, mode="impute")
    lags = ", ".join(f"lag({c}, 1) OVER (PARTITION BY entity_id ORDER BY period) AS {c}_lag1"
                     for c in ("spend", "disc_pct", "units"))
    return f"SELECT *, {lags} FROM ({imp}) fi"


EXTRA: dict[str, str] = {"f": _f_sql()}
