"""A representative slice of the catalog against its DuckDB SQL at sf0.001."""

import math

import pytest

from churnscope.plans.catalog import ORACLE, QUERIES
from tests.conftest import SF_SMALL

NAMES = ["profile", "valid_sales", "csv_lines", "csv_rejects", "describe_valid", "rfm_table", "rfm_table_events", "segment_summary",
         "high_risk_customers", "half_trends_events", "ts_features", "ch_features_events",
         "ts_feature_table", "tier_summary", "score_auc", "best_f1_threshold",
         "roi_best_threshold", "stratified_split"]


def _norm(rows):
    def n(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 9)
        return str(v)[:26] if hasattr(v, "isoformat") else v
    return sorted((tuple(n(x) for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLE[name])
    assert sorted(rel.columns) == sorted(cols)
    idx = [rel.columns.index(c) for c in cols]
    exp = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert _norm(got) == _norm(exp)
