"""Corpus queries that SQL can express."""
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
@pytest.mark.parametrize("name", ["op2_mix", "op3_host_rules", "op6_license_scan"])
def test_query_agrees_with_sql(spark, name):
    message, *_ = compare(spark, duck(SF), name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert message is None, message
