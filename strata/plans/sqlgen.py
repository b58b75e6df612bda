"""Small generators for oracle SQL that repeats per column or per column pair."""
from __future__ import annotations


def union_per_column(cols: list[str], template: str) -> str:
    return "\nUNION ALL\n".join(template.format(c=c) for c in cols)


def corr_pairs_sql(cols: list[str], src: str, decimals: int = 6) -> str:
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            inner = (f"SELECT CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END AS xa, "
                     f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({b} AS DOUBLE) END AS xb FROM {src}")
            val = (f"round(CASE WHEN count(xa) < 2 OR min(xa) = max(xa) OR min(xb) = max(xb) THEN NULL "
                   f"ELSE covar_pop(xa, xb) / nullif(stddev_pop(xa) * stddev_pop(xb), 0) END, {decimals})")
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {val} AS corr FROM ({inner})")
            if a != b:
                parts.append(f"SELECT '{b}' AS col_a, '{a}' AS col_b, {val} AS corr FROM ({inner})")
    return "\nUNION ALL\n".join(parts)


def nullity_corr_sql(cols: list[str], src: str, decimals: int = 6) -> str:
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            na, nb = f"count_if({a} IS NULL)", f"count_if({b} IS NULL)"
            nab = f"count_if({a} IS NULL AND {b} IS NULL)"
            val = (f"round(CAST(count(*) * {nab} - {na} * {nb} AS DOUBLE) / sqrt(CAST({na} * (count(*) - {na}) AS DOUBLE)"
                   f" * CAST({nb} * (count(*) - {nb}) AS DOUBLE)), {decimals})")
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {val} AS corr FROM {src}")
            if a != b:
                parts.append(f"SELECT '{b}' AS col_a, '{a}' AS col_b, {val} AS corr FROM {src}")
    return "\nUNION ALL\n".join(parts)


def nullity_distance_sql(cols: list[str], src: str, decimals: int = 6) -> str:
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
                         f"round(sqrt(CAST(count_if(({a} IS NULL) <> ({b} IS NULL)) AS DOUBLE)), {decimals}) AS distance "
                         f"FROM {src}")
    return "\nUNION ALL\n".join(parts)


def _fill_exprs(cols, entity, period, mode):
    wb = f"(PARTITION BY {entity} ORDER BY {period} NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    wf = f"(PARTITION BY {entity} ORDER BY {period} NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    inner, outer = [], {}
    for c in cols:
        v = f"CAST({c} AS DOUBLE)"
        if mode == "ffill":
            outer[c] = f"last_value({v} IGNORE NULLS) OVER {wb}"
            continue
        if mode == "bfill":
            outer[c] = f"first_value({v} IGNORE NULLS) OVER {wf}"
            continue
        inner += [f"last_value(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) OVER {wb} AS {c}__px",
                  f"last_value({v} IGNORE NULLS) OVER {wb} AS {c}__pv",
                  f"first_value(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) OVER {wf} AS {c}__nx",
                  f"first_value({v} IGNORE NULLS) OVER {wf} AS {c}__nv"]
        outer[c] = (f"coalesce({v}, {c}__pv + ({c}__nv - {c}__pv) * (rn - {c}__px) / nullif({c}__nx - {c}__px, 0), "
                    f"{c}__nv, {c}__pv)")
    return inner, outer


def interp_sql(cols: list[str], src: str, entity: str, period: str, all_cols: list[str], mode: str = "interp") -> str:
    """E1 (interp) / E2 (ffill) / E3 (bfill) / E8 (impute) in window SQL, with the null-entity reset."""
    fill_mode = "interp" if mode in ("interp", "impute") else mode
    inner, outer = _fill_exprs(cols, entity, period, fill_mode)
    sel = []
    for c in all_cols:
        if c in outer:
            sel.append(f"CASE WHEN {entity} IS NULL THEN NULL ELSE {outer[c]} END AS {c}")
        else:
            sel.append(c)
    if fill_mode == "interp":
        ranked = f"SELECT *, row_number() OVER (PARTITION BY {entity} ORDER BY {period} NULLS LAST) AS rn FROM {src}"
        filled = f"SELECT {', '.join(sel)} FROM (SELECT *, {', '.join(inner)} FROM ({ranked}))"
    else:
        filled = f"SELECT {', '.join(sel)} FROM {src}"
    if mode != "impute":
        return filled
    final = [f"coalesce({c}, (SELECT median({c}) FROM ({filled}) f2)) AS {c}" if c in outer else c for c in all_cols]
    return f"SELECT {', '.join(final)} FROM ({filled}) f1"


def fround_sql(expr: str, d: int) -> str:
    """Rounding to d decimals, halves to even on the scaled binary value (``functions.exprs.fround``)."""
    m = f"CAST({10 ** d} AS DOUBLE)"
    return f"(round_even(CAST({expr} AS DOUBLE) * {m}, 0) / {m})"


def rewrite_round_sql(sql: str) -> str:
    """Replace every ``round(expr, d)`` with d >= 1 (outside string literals) by ``fround_sql``."""
    out, i, n = [], 0, len(sql)
    while i < n:
        ch = sql[i]
        if ch == "'":
            j = sql.index("'", i + 1) + 1
            out.append(sql[i:j])
            i = j
            continue
        if (sql[i:i + 6].lower() == "round(" and (i == 0 or not (sql[i - 1].isalnum() or sql[i - 1] == "_"))):
            j, depth, comma = i + 6, 1, None
            while depth:
                c = sql[j]
                if c == "'":
                    j = sql.index("'", j + 1)
                elif c == "(":
                    depth += 1
                elif c == ")":
                    depth -= 1
                elif c == "," and depth == 1:
                    comma = j
                j += 1
            digits = sql[comma + 1:j - 1].strip() if comma else ""
            if digits.isdigit() and int(digits) >= 1:
                out.append(fround_sql(rewrite_round_sql(sql[i + 6:comma]), int(digits)))
                i = j
                continue
        out.append(ch)
        i += 1
    return "".join(out)
