"""Plans have the shape that holds up on large data."""

import os

import pytest

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def everything():
    import __spark_entry__

    return __spark_entry__.queries()


SAMPLE = [
    "predicates", "top_k_orders", "latest_by_key", "join_left", "cond_agg", "pivot_counts", "grouping_sets_5", "flatten_array",
    "fct_payer_summary", "stg_diagnoses", "adv_multi_flatten", "adv_pivot_census", "int_diagnosis_pairs", "int_medication_interactions",
]


@pytest.mark.parametrize("name", SAMPLE)
def test_no_python_and_no_cartesian_product(spark, name):
    plan = plan_of(everything()[name](spark, DATA))
    assert "Python" not in plan
    assert "CartesianProduct" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(everything()["predicates"](spark, DATA))
    scan = plan[plan.index("FileScan"):]
    assert "In(l_returnflag" in scan and "GreaterThanOrEqual(l_shipdate" in scan
    assert "l_tax" not in scan.split("ReadSchema")[1]


def test_top_k_is_limited_before_the_shuffle(spark):
    plan = plan_of(everything()["top_k_orders"](spark, DATA))
    assert plan.count("WindowGroupLimit") == 2
    assert "Partial" in plan


def test_documents_are_parsed_once(spark):
    for name in ("stg_claims", "stg_patients", "stg_facility_events"):
        assert plan_of(everything()[name](spark, DATA)).count("from_json") == 1


def test_pairs_of_rules_are_counted_without_a_join_of_rows(spark):
    from wardflow.bindings.operator_queries import QUERIES

    assert plan_of(QUERIES["pair_rules"](spark, DATA)).count("Join") <= 1  # only part, to name the items


def test_events_are_parsed_before_they_are_counted_and_dealt_out(spark):
    assert "from_json" not in plan_of(everything()["int_event_response_analysis"](spark, DATA))
