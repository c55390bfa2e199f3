"""Documents stored as VARIANT: the same models, read path by path."""

import os

import pytest

from tests.test_oracles import DATA
from wardflow.bindings.landing import PARAMS, model
from wardflow.plans.catalog import MODELS, inputs_of

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")

STAGING = sorted(n for n in MODELS if n.startswith("stg_") and n not in ("stg_facility_tags",))


@pytest.mark.parametrize("name", ["stg_patients", "stg_claims", "stg_procedures", "stg_order_history", "stg_vitals", "int_encounter_summary"])
def test_same_rows_without_parsing(spark, name):
    stored = model(spark, DATA, name, PARAMS, variant=True)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "to_json" not in plan
    # The scan reads the paths of the model, not the documents.
    assert "raw_data:struct<0:" in plan and "raw_data:variant" not in plan
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, model(spark, DATA, name, PARAMS).collect()))


def test_every_landing_table_can_be_stored(spark):
    tables = {i for n in STAGING for i in inputs_of(n) if i.startswith("raw_")}
    assert tables == {"raw_patients", "raw_encounters", "raw_lab_results", "raw_claims", "raw_facility_ops"}
