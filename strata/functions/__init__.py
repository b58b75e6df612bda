"""Column-expression helpers (exprs) and scalable order statistics / prefix sums (stats)."""
from .exprs import (  # noqa: F401
    NA_TOKENS, coerce_double, fround, hash_uniform, hash_uniform_sql, normalize_floats,
    numeric_columns, quantize, safe_corr,
)
from .stats import column_medians, column_quantiles, global_index, prefix_sums  # noqa: F401
