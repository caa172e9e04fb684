"""The physical plans of the registered queries; a plan does not depend on how many rows there are."""

import pytest

import __spark_entry__ as registered
from roundhaul.plans.queries import QUERIES

# The training-data queries use Arrow functions and are checked in tests/llm.
NAMES = sorted(QUERIES)
SMALL = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"]


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_joins_and_no_python(spark, name):
    text = registered.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in text]


@pytest.mark.parametrize(
    "name",
    [
        "row_count_match",
        "statistics_match",
        "float_tolerance",
        "content_match",
        "content_diff",
        "differing_rows",
        "keyed_diff",
        "audit_foreign_key",
        "load_difference",
        "validity_history",
    ],
)
def test_comparisons_do_not_join(spark, name):
    text = registered.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text
    assert text.count("Exchange") <= 2
