"""Plans that must hold at scale: no nested loops, no cross products, no window over all rows in one task."""

import re

import pytest

from checks import fixture as fx
from checks.queries import REGISTRY
from txnlake.plans import goldsets, views

NAMES = [
    "silver_build", "silver_amount_percentile", "silver_row_fraction", "silver_outlier_iqr", "ml_rolling_100",
    "ml_rolling_100_global", "ml_build", "st_rolling_100", "an_prediction_accuracy", "an_hourly_unified",
    "gl_amount_by_class", "prof_dataset", "prof_categorical", "st_cdc_latest", "gold_risk_profiles",
]
BOUNDED = ("windowspecdefinition(_part", "windowspecdefinition(day")


@pytest.mark.parametrize("name", NAMES)
def test_plan(spark, sf_dir, name):
    df = REGISTRY[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        # Below a window without partition key only per-partition totals or days may lie.
        if re.search(r"\bWindow \[", line) and any("SinglePartition" in x for x in lines[i : i + 4]):
            assert any(b in line for b in BOUNDED), line[:200]


@pytest.mark.parametrize("name", ["vw_fraud_summary", "gl_dataset_counts", "gl_dataset_compare", "gl_fraud_summary"])
def test_feature_sets_are_summed_in_one_scan(spark, sf_dir, name):
    plan = REGISTRY[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_empty_feature_sets_count_nothing(spark, sf_dir):
    nothing = fx.table(spark, sf_dir, "current").where("split = 'none'")
    assert {(r["table_name"], r["record_count"]) for r in goldsets.dataset_counts(nothing).collect()} == {
        ("ml_features_current", 0), ("ml_features_train", 0), ("ml_features_test", 0),
    }
    assert goldsets.dataset_compare(nothing).count() == 3 and views.fraud_summary(nothing).count() == 0
