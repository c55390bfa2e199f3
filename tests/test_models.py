"""Every model on hand-written landing documents with the edge rows that matter."""

import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wardflow.params import Params
from wardflow.plans import intermediate, marts, staging
from wardflow.plans.catalog import MODELS, build, inputs_of, publish
from wardflow.session import fresh_path, shared_dir
from wardflow.sources.landing import FACILITY_SCHEMA, ICD10_SCHEMA, TABLES, read_seed
from wardflow.sources.tables import KeyedTable

PARAMS = Params(as_of=datetime(2024, 7, 1, 12, 0))

PATIENT = {
    "patient_id": "P1", "encounter_id": "E1", "facility_id": "FAC01", "admit_date": "2024-01-01", "discharge_date": None,
    "demographics": {"first_name": "Ada", "last_name": "Bee", "dob": "1930-12-31", "gender": "F", "ssn": "1"},
    "vitals": {"bp_systolic": "185", "bp_diastolic": 70, "heart_rate": "98.6", "temperature": 101, "o2_saturation": 95,
               "pain_level": 3, "recorded_at": "soon", "systolic_bp": 120, "o2_sat": None, "position": "sitting"},
    "diagnoses": [
        {"icd10": "I10", "description": "Essential hypertension", "is_primary": True, "onset": "2023-12-31", "severity": "Chronic"},
        {"icd10": "E11.65", "description": "Type 2 DM", "is_primary": False, "onset": "31.12.2023", "severity": "Acute"},
    ],
    "medications": [
        {"name": "Warfarin", "drug_name": "Warfarin", "route": "PO", "start_date": "2024-01-01"},
        {"name": "Aspirin", "drug_name": "Aspirin", "route": "IV", "start_date": ""},
        {"name": "Warfarin", "drug_name": "Warfarin", "route": "PO", "start_date": "2024-04-15"},
        {"name": "Atorvastatin", "route": "PO"}, {"name": "Fenofibrate", "route": "IV"},
    ],
    "insurance": [
        {"payer": "A", "plan_id": "1", "type": "Primary", "effective_date": "2024-06-30"},
        {"payer": "B", "plan_id": "2", "type": "Primary", "effective_date": "2020-01-31"},
    ],
    "mds_assessment": {"nursing_tier": "ES3", "nta_tier": "A", "section_i": ["I1"], "section_o": ["O0400 IV therapy"]},
    "notes": "Pt admitted, BP 120/80. GFR was 33", "allergies": [], "consent_date": "2024-02-30", "consent_form_id": "x",
}


def documents(spark, rows):
    schema = "raw_data string, _ingested_at timestamp_ntz, _source_file string, _batch_id string"
    return spark.createDataFrame([(json.dumps(d), at, "f", "b") for d, at in rows], schema)


@pytest.fixture(scope="module")
def relations(spark):
    old = {**PATIENT, "facility_id": "FAC02", "vitals": {**PATIENT["vitals"], "heart_rate": 50}}
    bare = {"patient_id": "P2", "facility_id": "FAC99", "admit_date": "2023-12-31", "discharge_date": "2024-01-01", "medications": []}
    patients = [(old, datetime(2024, 6, 28, 9)), (PATIENT, datetime(2024, 6, 30, 9, 30)), (bare, datetime(2024, 6, 30, 10))]
    encounters = [
        ({"encounter_id": "E1", "patient_id": "P1", "facility_id": "FAC01", "encounter_type": "Inpatient",
          "admit_datetime": "2024-01-06 23:30:00", "discharge_datetime": "2024-01-10 00:30:00", "charges": {"total": 0},
          "attending_provider": {"npi": "N1"}, "procedures": [{"code": "99213", "charge": 10}, {"code": "97110", "charge": 30}, {"code": "X1"}],
          "care_plan": [{"goal": "g", "intervention": "b", "priority": 2}, {"goal": None, "intervention": "z"}, {"goal": "h", "intervention": "a", "priority": 1}],
          "documents": [{"doc_type": "d", "sections": [{"section_name": "s", "content": "STAT now"}, {"section_name": "t"}]}],
          "referral": {"referral_date": "2024-01-07", "completed_date": None}}, datetime(2024, 1, 11)),
        ({"encounter_id": "E2", "patient_id": "P1", "facility_id": "FAC01", "encounter_type": "Rehab",
          "admit_datetime": "2024-01-20 08:00:00", "authorization": {"approved_days": 2, "used_days": 1}}, datetime(2024, 1, 21)),
    ]
    labs = [
        ({"patient_id": "P1", "order_id": f"L{i}", "collected_at": at, "critical_flag": False,
          "results": [{"analyte": "Na", "value": v, "ref_low": 10, "ref_high": 20, "flag": f}]}, datetime(2024, 5, 1))
        for i, (at, v, f) in enumerate([("2024-05-01 08:00:00", 15, None), ("2024-05-01 20:00:00", 5, "LOW"), ("2024-05-02 08:00:00", 12, None)])
    ]
    claims = [
        ({"claim_id": "C1", "patient_id": "P1", "encounter_id": "E1", "payer": "A", "claim_type": "I", "status": "Paid", "total_charges": 100,
          "total_paid": 90, "service_date": "2024-06-30", "submit_date": "2024-07-01", "remit_date": None,
          "line_items": [{"line_no": 2, "charge": 40}, {"line_no": 1, "charge": 60, "denial_code": "D"}]}, datetime(2024, 7, 1)),
        ({"claim_id": "C2", "patient_id": "P1", "encounter_id": "E1", "payer": "A", "claim_type": "O", "status": "Denied", "total_charges": 0,
          "total_paid": 0, "service_date": "bad", "denial_reasons": [" no-auth! "]}, datetime(2024, 7, 1)),
    ]
    ops = [
        ({"event_id": "V1", "facility_id": "FAC01", "event_type": "fall_alert", "timestamp": "2024-06-30 10:00:00", "severity": "Critical",
          "patient_id": "P1", "resolved": False, "resolution_time_minutes": 120, "location": {"wing": "W", "floor": 1, "room": 2, "bed": "A"}, "tags": ["urgent"]}, datetime(2024, 6, 30)),
        ({"facility_id": "FAC01", "budget": {"allocated": 0, "spent": 5}}, datetime(2024, 6, 30)),
        ({"facility_id": "FAC01", "measure_id": "M", "score": 100, "benchmark": 80}, datetime(2024, 6, 30)),
        ({"facility_id": "FAC01", "shift": {"start_time": "2024-06-29 22:00:00", "end_time": "2024-06-30 11:10:00"}}, datetime(2024, 6, 30)),
        ({"record_type": "provider_schedule", "provider_id": "N1", "is_active": True, "schedule": {"monday": {"start_time": "08:50", "end_time": "17:10"}, "friday": None}}, datetime(2024, 6, 1)),
        ({"provider_id": "N1", "hire_date": "2023-12-31", "is_active": True}, datetime(2024, 6, 2)),
    ]
    tables = dict(zip(TABLES, (documents(spark, rows) for rows in (patients, encounters, labs, claims, ops)), strict=True))
    seed = [("FAC01", "One", "SNF", "MA", 10, 4), ("FAC03", "Idle", "SNF", "AZ", 0, 5)]
    tables["facility_reference"] = spark.createDataFrame(seed, FACILITY_SCHEMA)
    return tables


def model(spark, relations, name):
    return build(name, spark, dict(relations), PARAMS)


GRAIN = {
    "stg_allergies": ["patient_id", "allergen"], "stg_diagnoses": ["patient_id", "icd10_code"], "stg_primary_diagnosis": ["patient_id"],
    "int_acuity_scoring": ["patient_id"], "int_census_forecast": ["facility_id", "forecast_date"], "int_cost_allocation": ["claim_type", "payer_name"],
    "int_drug_interactions": ["patient_id"], "int_encounter_summary": ["encounter_id"], "int_facility_census": ["facility_id", "admit_date"],
    "int_medication_interactions": ["patient_id"], "int_payer_performance": ["payer_name", "claim_type"], "int_provider_panels": ["provider_id"],
    "int_sliding_window": ["facility_id", "event_date"], "int_time_series_gaps": ["patient_id", "expected_time"], "adv_array_operations": ["patient_id"],
    "adv_date_spine": ["date_day"], "adv_hash_clustering": ["patient_id", "full_name", "admit_date"], "adv_object_agg": ["patient_id"],
    "adv_pivot_census": ["facility_id", "event_date"], "dim_facility": ["facility_id"], "dim_providers": ["provider_key"],
    "fct_daily_census": ["census_key"], "fct_payer_summary": ["payer_name", "claim_type"], "fct_quality_dashboard": ["quality_key"],
    "fct_staffing_metrics": ["facility_id", "event_date"], "snp_patient_insurance": ["patient_id"],
}


def test_all_models_are_there():
    assert len(MODELS) == 86
    assert all(i in MODELS or i in [*TABLES, "facility_reference"] for m in MODELS for i in inputs_of(m))


@pytest.mark.parametrize("name", list(MODELS))
def test_model_runs_and_keeps_its_grain(spark, relations, name):
    rows = model(spark, relations, name).collect()
    if name in GRAIN:
        keys = [tuple(r[k] for k in GRAIN[name]) for r in rows]
        assert len(keys) == len(set(keys)) > 0 or name == "stg_allergies"


def first(spark, relations, name, where):
    return model(spark, relations, name).filter(where).first()


def test_patients(spark, relations):
    p = first(spark, relations, "stg_patients", "facility_id = 'FAC01'")
    assert (p.age, p.length_of_stay, p.is_current_resident, p.heart_rate, p.bp_systolic) == (94, 182, True, 99, 185)
    bare = first(spark, relations, "stg_patients", "patient_id = 'P2'")
    assert (bare.length_of_stay, bare.diagnosis_count, bare.medication_count, bare.age) == (1, None, 0, None)


def test_explicit_null_and_missing_key_are_the_same(spark):
    rows = documents(spark, [({"patient_id": "A", "discharge_date": None}, None), ({"patient_id": "B"}, None)])
    got = {r.patient_id: r.is_current_resident for r in staging.stg_patients(rows, PARAMS).collect()}
    assert got == {"A": True, "B": True}


def test_variant_documents(spark, relations):
    as_variant = relations["raw_patients"].withColumn("raw_data", F.parse_json("raw_data"))
    assert sorted(map(str, staging.stg_diagnoses(as_variant, PARAMS).collect())) == sorted(
        map(str, staging.stg_diagnoses(relations["raw_patients"], PARAMS).collect())
    )


def test_malformed_strict_fields_fail_and_safe_ones_do_not(spark, relations):
    bad = documents(spark, [({"patient_id": "P", "admit_date": "someday"}, None)])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_patients(bad, PARAMS).collect()
    dx = first(spark, relations, "stg_diagnoses", "icd10_code = 'E11.65'")
    assert dx.onset_date is None and dx.days_before_admission is None and dx.diagnosis_type == "Secondary"


def test_boundaries_and_safe_parses(spark, relations):
    assert first(spark, relations, "stg_diagnoses", "icd10_code = 'I10'").days_before_admission == 1
    plans = model(spark, relations, "stg_insurance").filter("_ingested_at > '2024-06-29'")
    assert sorted(r.months_enrolled for r in plans.collect()) == [1, 54]
    consent = first(spark, relations, "stg_patient_consents", "_ingested_at > '2024-06-29'")
    assert (consent.consent_date, consent.consent_form_id, consent.is_active) == (None, None, False)


def test_claims(spark, relations):
    c1, c2 = sorted(model(spark, relations, "stg_claims").collect(), key=lambda r: r.claim_id)
    assert (c1.days_to_submit, c1.days_to_payment, c1.payment_ratio, c1.total_denied, c1.denial_reason_count) == (1, None, 0.9, 0.0, None)
    assert (c2.payment_ratio, c2.service_date, c2.is_denied, c2.denial_reason_count) == (0.0, None, True, 1)
    lines = model(spark, relations, "stg_claim_lines").collect()
    assert [(r.line_number, r.running_charge_total) for r in sorted(lines, key=lambda r: r.line_number)] == [(1, 60.0), (2, 100.0)]


def test_encounter_models(spark, relations):
    meds = {r.procedure_code: (r.procedure_category, r.code_prefix) for r in model(spark, relations, "stg_procedures").collect()}
    assert meds == {"99213": ("E&M", "99"), "97110": ("Therapy", "97"), "X1": ("Other", None)}
    goals = model(spark, relations, "stg_care_plans").collect()
    assert {r.care_goal: r.all_interventions for r in goals} == {"g": "a; b", "h": "a; b"}
    assert [r.section_name for r in model(spark, relations, "stg_clinical_documents").collect()] == ["s"]
    stay = {r.encounter_id: r for r in model(spark, relations, "int_readmission_risk").collect()}
    assert (stay["E2"].days_since_last_discharge, stay["E2"].is_30_day_readmission, stay["E1"].will_readmit_30d) == (10, True, True)
    assert first(spark, relations, "int_encounter_summary", "encounter_id = 'E1'").reimbursement_rate is None
    assert first(spark, relations, "int_encounter_summary", "encounter_id = 'E2'").needs_reauth is True


def test_facility_records(spark, relations):
    budget = model(spark, relations, "stg_facility_budgets").first()
    assert (budget.utilization_rate, budget.utilization_bucket, budget.budget_status) == (0.0, 1, "UNDER_UTILIZED")
    measure = model(spark, relations, "stg_quality_measures").first()
    assert (measure.quality_tier, measure.performance_status) == (6, "EXCEEDS")
    shift = model(spark, relations, "stg_staff_schedules").first()
    assert (shift.shift_hours, shift.shift_type, shift.day_of_week, shift.is_weekend) == (13, "EXTENDED", 6, True)
    plan = model(spark, relations, "stg_provider_schedules").first()
    assert (plan.monday_hours, plan.scheduled_days_count, plan.status) == (9, 2, "Active")
    event = first(spark, relations, "stg_facility_events", "event_id = 'V1'")
    assert (event.response_time_bucket, event.response_time_band, event.full_location) == (7, "120min+", "W-1-2A")
    provider = {r.is_current: r for r in model(spark, relations, "dim_providers").collect()}
    assert provider[False].valid_to == provider[True].valid_from and provider[True].years_of_service == 1


def test_medication_models(spark, relations):
    one = first(spark, relations, "int_drug_interactions", "patient_id = 'P1'")
    assert (one.bleeding_risk, one.blood_thinners, one.dual_anticoag_risk) == ("HIGH", ["Aspirin", "Warfarin"], True)
    pairs = first(spark, relations, "int_medication_interactions", "patient_id = 'P1'")
    # Two documents of five medications each; the statin and the fibrate meet 2 x 2 times.
    assert (pairs.total_medications, pairs.high_risk_interactions, pairs.interaction_pair_count) == (10, 4, 36)
    fills = model(spark, relations, "int_medication_adherence").filter("medication_name = 'Warfarin'").orderBy("fill_number").collect()
    assert [r.adherence_status for r in fills] == ["FIRST_FILL", "ADHERENT", "NON_ADHERENT", "ADHERENT"]


def test_lab_trends_look_back_over_readings_that_are_then_dropped(spark, relations):
    rows = {r.collected_at.day: r for r in model(spark, relations, "int_lab_trends").collect()}
    assert (rows[1].result_value, rows[1].trend_status, rows[1].prev_value) == (5.0, "NEW_LOW", 15.0)
    assert (rows[2].trend_status, rows[2].result_seq, rows[2].moving_avg_3) == ("NORMALIZED", 3, pytest.approx(32 / 3))


def test_cost_allocation_counts_subtotals_in_its_denominator(spark, relations):
    rows = model(spark, relations, "int_cost_allocation").collect()
    top = [r for r in rows if r.is_type_total and r.is_payer_total][0]
    assert top.total_charges == 100.0 and top.pct_of_total_charges == pytest.approx(0.25)


def test_gaps_use_a_spine_of_full_hours(spark, relations):
    slots = model(spark, relations, "int_time_series_gaps").filter("patient_id = 'P1' and not is_gap").collect()
    assert sorted(r.expected_time for r in slots) == [datetime(2024, 6, 28, 9), datetime(2024, 6, 30, 9)]


def test_patient_360_grain(spark, relations):
    names = ["stg_patients", "stg_primary_diagnosis", "stg_mds_assessments", "stg_insurance", "stg_vitals"]
    inputs = [model(spark, relations, n) for n in names]
    kept = intermediate.int_patient_360(*inputs, params=PARAMS)
    assert kept.count() == 3
    assert kept.filter("patient_id = 'P1'").select("primary_payer").distinct().collect()[0][0] == "A"
    # Two documents meet two assessments, four primary policies and two vital rows.
    assert intermediate.int_patient_360(*inputs, params=PARAMS, one_row_per_side=False).count() == 2 * 1 * 2 * 4 * 2 + 1


def test_dim_facility(spark, relations):
    rows = {r.facility_id: r for r in model(spark, relations, "dim_facility").collect()}
    assert set(rows) == {"FAC01", "FAC03"}
    assert (rows["FAC03"].occupancy_rate, rows["FAC03"].total_patients_served) == (None, 0)
    assert rows["FAC01"].occupancy_rate == 0.1


def test_calendar_flags(spark):
    rows = {r.date_day: r for r in build("adv_date_spine", spark, {}, PARAMS).collect()}
    assert len(rows) == 730
    assert rows[date(2024, 1, 6)].is_weekend and rows[date(2024, 1, 7)].is_weekend and not rows[date(2024, 1, 5)].is_weekend
    assert (rows[date(2024, 7, 1)].fiscal_quarter, rows[date(2024, 7, 1)].fiscal_year) == ("Q1", "FY2025")
    assert rows[date(2024, 2, 29)].is_month_end


def test_incremental_facts(spark, relations):
    claims, patients = (model(spark, relations, n) for n in ("stg_claims", "stg_patients"))
    table = KeyedTable(spark, fresh_path(spark, "revenue"), "revenue_key")
    marts.fct_revenue(claims.filter("claim_id = 'C1'"), patients, PARAMS, table)
    late = claims.withColumn("_ingested_at", F.when(F.col("claim_id") == "C2", F.lit("2024-07-02").cast("timestamp_ntz")).otherwise(F.col("_ingested_at")))
    got = marts.fct_revenue(late, patients, PARAMS, table)
    assert sorted((r.claim_id, r.fiscal_quarter) for r in got.collect()) == [("C1", "Q4"), ("C2", None)]
    census = KeyedTable(spark, fresh_path(spark, "census"), "census_key")
    for n in (1, 3):
        rows = marts.fct_daily_census(patients.orderBy("_ingested_at").limit(n), PARAMS, census)
    assert sorted(r.patient_count for r in rows.collect()) == [1, 1, 1]


def test_publish_stores_layers_and_reads_them_back(spark, relations):
    root, rels = fresh_path(spark, "lake"), dict(relations)
    facts = publish("fct_clinical_events", spark, rels, PARAMS, root)
    assert facts.count() == model(spark, relations, "fct_clinical_events").count()
    assert facts.inputFiles()[0].count("/gold/fct_clinical_events/") == 1
    assert rels["int_clinical_alerts"].inputFiles()[0].count("/silver/") == 1
    assert spark.table("bronze_stg_vitals").count() == 3


def test_publish_leaves_no_intermediate_relations(spark, relations, tight):
    def settled():
        return {p.name for p in Path(shared_dir(spark).removeprefix("file:")).glob("settled-*")}

    root, rels = fresh_path(spark, "lake"), dict(relations)
    for needed in inputs_of("int_payer_performance"):
        publish(needed, spark, rels, PARAMS, root)
    before = settled()
    plain = model(spark, relations, "int_payer_performance")
    assert settled() > before, "the model settles nothing, take another"
    before = settled()
    stored = publish("int_payer_performance", spark, {**rels}, PARAMS, root)
    assert settled() == before
    assert sorted(map(str, stored.collect())) == sorted(map(str, plain.collect()))


def test_seeds(spark, tmp_path):
    (tmp_path / "icd.csv").write_text("icd10_code,description,category,drg_weight\nI10,Hypertension,Cardiology,0.75\n")
    assert tuple(read_seed(spark, str(tmp_path / "icd.csv"), ICD10_SCHEMA).first()) == ("I10", "Hypertension", "Cardiology", 0.75)


def test_seeds_that_come_with_the_library(spark, relations):
    own = {name: relations[name] for name in TABLES}
    rows = {r.facility_id: r for r in build("dim_facility", spark, own, PARAMS).collect()}
    assert len(rows) == 6 and (rows["FAC01"].bed_count, rows["FAC01"].current_census) == (120, 1)
    codes = build("icd10_reference", spark, {}, PARAMS)
    assert codes.count() == 15 and codes.filter("icd10_code = 'I10'").first().drg_weight == 0.75
