"""Registered queries against their SQL. Set ORACLE=all to check every one."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, differences

CORE = (
    "csv_roundtrip", "validation_report", "drop_duplicates", "engineer_features", "encode_label_wide", "scale_robust",
    "stratified_split_three", "cv_folds", "prepare_splits", "roc_auc_by_model", "gate_decision", "feature_drift_report",
    "windowed_drift", "latency_p95", "alert_sustained", "stream_sustained", "knn_predict",
)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if os.environ.get("ORACLE") == "all" else CORE)
def test_query_equals_sql(spark, sf_dir, name):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    assert differences(got, connect(sf_dir).execute(entry.oracle_sql()[name]).df()) is None


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 3
