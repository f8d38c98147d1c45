"""Physical-plan properties: filters reach the scan, no Python on the data
path, and no window over raw lines keyed by customer alone."""

from churnscope.plans import steps as st
from churnscope.plans.catalog import QUERIES
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_feature_plans(spark):
    for name in ["rfm_base", "ts_features", "ch_features", "ts_feature_table", "score_auc"]:
        plan = _plan(QUERIES[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_filters_pushed_to_scan(spark):
    from churnscope.operators.clean import valid_sales
    from churnscope.sources import transactions_from_orders
    clean = valid_sales(transactions_from_orders(spark, SF_SMALL, with_country=False))
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_custkey)" in plan or "IsNotNull(o_custkey)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_returnflag:string>" in plan


def test_materialized_clean_is_column_pruned(spark):
    clean = st.clean_lines(spark, SF_SMALL)
    plan = clean.groupBy("CustomerID").count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<CustomerID:bigint>" in plan


def test_windows_only_on_bounded_grains(spark):
    stats = st.sequence_stats(spark, SF_SMALL)
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    # the only customer-keyed window runs over the day grain (ordered by day)
    for line in plan.splitlines():
        if "Window [" in line and "CustomerID" in line:
            assert "day" in line, line


def test_every_window_is_bounded(spark):
    """Windows either run per customer over the day grain, or over the
    offset tables of the distributed rank / the class counts of the split
    (one row per range partition or per class)."""
    from churnscope.operators import ml_prep as mp
    from churnscope.operators import rfm as rf
    from churnscope.operators import sequences as sq
    clean = st.clean_lines(spark, SF_SMALL)
    plans = [rf.rfm_table(clean), sq.sequence_stats(clean, write_grain=False),
             mp.stratified_split(st.feature_table(spark, SF_SMALL, "ch"))]
    seen = 0
    for df in plans:
        for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines():
            if "Window [" not in line:
                continue
            seen += 1
            bounded = (("CustomerID" in line and "day" in line)
                       or "_cnt" in line or "_pt" in line or "_nc" in line)
            assert bounded, line
    assert seen > 0
