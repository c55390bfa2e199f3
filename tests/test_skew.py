"""Queries on tables in which one key holds a third of all rows, with limits that force the ways for large data."""

import os

import pytest

import __spark_entry__
from tests.test_oracles import DATA, ORACLES, QUERIES, TABLES, comparable

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")

HOT = {
    "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 60 ELSE o_custkey END AS o_custkey)",
    "lineitem": "* REPLACE (CASE WHEN hash(l_linenumber, l_partkey, l_suppkey, l_extendedprice) % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey)",
    "events": "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 11 ELSE user_id END AS user_id)",
}
NAMES = [
    "claim_lines_running", "join_inner_back", "self_join_pairs", "pair_rules", "stats_percentiles", "grouping_sets_3", "listagg_ordered",
    "array_agg_sorted", "rank_family", "lag_lead", "first_last_ignore_nulls", "moving_frames", "range_1h", "ratio_to_report", "global_rank",
    "union_alerts", "detect_gaps_filled", "return_intervals_orders", "trend_states_events", "entity_360", "stg_procedures", "stg_care_plans",
    "int_claims_revenue", "int_clinical_alerts", "int_encounter_summary", "int_event_response_analysis", "int_provider_panels",
    "int_medication_interactions", "fct_payer_summary", "iqr_outliers", "int_patient_journey", "fct_revenue", "int_payer_performance",
    "stg_order_history", "fct_clinical_events_merged", "fct_revenue_loaded", "snp_patient_insurance_history",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    import duckdb

    folder, connection = tmp_path_factory.mktemp("skewed"), duckdb.connect()
    for name in TABLES:
        connection.execute(f"COPY (SELECT {HOT.get(name, '*')} FROM '{DATA}/{name}.parquet') TO '{folder}/{name}.parquet'")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return str(folder), connection


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys(tight, skewed, name):
    folder, connection = skewed
    df = QUERIES[name](tight, folder)
    columns = sorted(df.columns)
    got = sorted(tuple(comparable(r[c]) for c in columns) for r in df.collect())
    cursor = connection.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert got == sorted(tuple(comparable(r[names.index(c)]) for c in columns) for r in cursor.fetchall())


def test_names_are_registered():
    assert set(NAMES) <= set(__spark_entry__.queries())
