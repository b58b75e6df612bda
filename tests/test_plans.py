"""Plan checks: native expressions only, pushed-down scans, shared window sorts."""
import pytest

from conftest import SF_SMALL


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["impute_panel", "drop_sparse_entities", "missing_by_column", "roc_auc",
                                  "correlation_matrix", "merge_target", "stress_scenarios"])
def test_no_python_udf_in_hot_path(spark, name):
    import __spark_entry__ as entry
    txt = plan_text(entry.queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in txt and "ArrowEvalPython" not in txt


def test_impute_shares_one_window_sort_per_step(spark):
    from strata.operators.impute import impute_panel
    from strata.sources import fixtures as fx
    df = impute_panel(fx.panel(spark, SF_SMALL), materialize=False)
    txt = df._jdf.queryExecution().executedPlan().toString()
    sorts = [l for l in txt.splitlines() if "Sort [entity_id" in l]
    windows = [l for l in txt.splitlines() if "Window [" in l]
    # the filled panel feeds the output and the median aggregate: per branch one sort shared by
    # the row number and every fill of every column (two Window operators)
    assert len(sorts) <= 2 and len(windows) == 2 * len(sorts)


def test_scan_is_pruned(spark):
    from strata.operators.clean import select_features
    from strata.sources.tables import read_table
    df = select_features(read_table(spark, SF_SMALL, "orders"), ["o_orderkey", "o_custkey"])
    scans = [line.split("ReadSchema")[1] for line in plan_text(df).splitlines() if "ReadSchema" in line]
    assert scans and all("o_orderkey" in s and "o_totalprice" not in s for s in scans)


def test_no_unpartitioned_window_on_rows(spark):
    """The only windows without partition keys run over the sums of ranges or classes, one row each."""
    import __spark_entry__ as entry
    for name in ("roc_curve", "stratified_folds", "stratified_split", "append_predictions"):
        for line in plan_text(entry.queries()[name](spark, SF_SMALL)).splitlines():
            if "Window [" in line:
                keyed = line.count("], [") >= 2  # functions, partition keys, order
                assert keyed or "sum(_n#" in line or "lag(_l_" in line or "sum(_n_class#" in line or "sum(_t_" in line, line
