import os

import pytest

import __spark_entry__ as entry
from check_oracle import compare, duck

SF = "/root/testdata/sf0.01"
SOME = ["scan_delimited", "partitioned_roundtrip", "treatment_metrics", "join_dim_validated", "address_pivot", "cardinality_classes",
        "iqr_outliers", "target_stats", "target_correlation", "daily_metrics", "holiday_flag", "feature_distribution",
        "feature_layer", "fold_validity", "select_best_model", "one_hot", "stratified_sample"]


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 150


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
@pytest.mark.parametrize("name", SOME)
def test_query_agrees_with_sql(spark, name):
    message, *_ = compare(spark, duck(SF), name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert message is None, message


def test_entry(spark):
    if os.path.isdir(entry.SMOKE_DIR):
        assert entry.entry(spark).count() > 0
