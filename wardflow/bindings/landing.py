"""Landing documents derived from the given tables, so every model can run on them.

Patients come from customer, claims and encounters from orders with their lineitem rows, lab results
and facility events from events, and the other facility records from supplier. Money is kept to
quarters of a unit, so that sums do not depend on the order of addition.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.operators.aggregates import ordered_list
from wardflow.params import Params
from wardflow.plans.catalog import build
from wardflow.session import fresh_path
from wardflow.sources.landing import read_landing, write_variant

AS_OF = datetime(2001, 8, 1, 12, 30)
EVENTS_AS_OF = datetime(2024, 1, 29, 12, 30)
PARAMS = Params(as_of=AS_OF)
EVENT_PARAMS = Params(as_of=EVENTS_AS_OF)

# Medication names the models look for, and others.
MEDS = [
    "Warfarin", "Aspirin", "Heparin", "Enoxaparin", "Metformin", "Insulin", "Glipizide", "Lisinopril", "Losartan",
    "Metoprolol", "Atorvastatin", "Fenofibrate", "Carvedilol", "Zosyn",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _list(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def _items(n: str, most: int, body: str) -> str:
    """Array of `n` structs, `i` counting from 0."""
    return f"transform(filter(sequence(0, {most - 1}), i -> i < {n}), i -> {body})"


def _envelope(df: DataFrame, document: str, ingested: str) -> DataFrame:
    return df.select(
        F.expr(f"to_json({document})").alias("raw_data"),
        F.expr(ingested).cast("timestamp_ntz").alias("_ingested_at"),
        F.lit("derived").alias("_source_file"),
        F.lit("1").alias("_batch_id"),
    )


def raw_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per customer, and an earlier copy of every tenth."""
    people = table(spark, sf_dir, "customer").selectExpr("*", "c_custkey AS k")
    copies = people.selectExpr("*", "explode(if(k % 10 = 0, array(0, 1), array(0))) AS old")
    meds = _list(MEDS)
    document = f"""named_struct(
      'patient_id', concat('P', k), 'encounter_id', concat('E', k),
      'demographics', named_struct(
        'first_name', concat('F', k % 97), 'last_name', c_mktsegment,
        'dob', cast(date_add(date'1910-01-01', cast(k * 37 % 30000 as int)) as string),
        'gender', if(k % 2 = 0, 'F', 'M'), 'race', concat('R', k % 5), 'language', concat('L', k % 4),
        'marital_status', concat('M', k % 3), 'ssn', concat('900-', k)),
      'address', named_struct('street', concat(k, ' Main'), 'city', concat('City', c_nationkey),
        'state', concat('S', c_nationkey % 5), 'zip', concat('Z', k % 100)),
      'facility_id', concat('FAC0', k % 8),
      'admit_date', cast(date_add(date'2001-01-01', cast(k % 200 as int)) as string),
      'discharge_date', if(k % 3 = 0, null, cast(date_add(date'2001-01-01', cast(k % 200 + k % 90 as int)) as string)),
      'vitals', if(k % 19 = 0, null, named_struct(
        'bp_systolic', 100 + k % 100, 'bp_diastolic', 60 + k % 70,
        'heart_rate', if(k % 23 = 0, null, 45 + k % 120 - old * 7), 'temperature', 97 + (k % 20) / 4D, 'weight_lbs', 100 + k % 150,
        'o2_saturation', if(k % 11 = 0, '93.6', cast(85 + k % 15 as string)), 'pain_level', k % 11,
        'recorded_at', if(k % 13 = 0, 'unknown', concat('2001-07-30 0', k % 10, ':15:00')),
        'systolic_bp', 100 + k % 100, 'diastolic_bp', 60 + k % 70, 'o2_sat', if(k % 4 = 0, null, 85 + k % 15),
        'position', element_at(array('supine', 'sitting', 'standing', 'prone'), cast(k % 4 + 1 as int)))),
      'diagnoses', if(k % 17 = 0, null, {_items("k % 6", 5, '''named_struct(
        'icd10', element_at(array('I10', 'E11.65', concat('D', (k * 7 + i * 3) % 40), concat('D', (k + i * 5) % 60)), cast((k + i) % 4 + 1 as int)),
        'description', concat('desc ', (k + i) % 4), 'is_primary', i = 0 or (k % 25 = 0 and i = 1),
        'onset', if((k + i) % 9 = 0, 'n/a', cast(date_add(date'2000-06-01', cast(k % 300 + i as int)) as string)),
        'severity', element_at(array('Acute', 'Chronic', 'Critical', 'Mild'), cast((k + i) % 4 + 1 as int)))''')}),
      'medications', {_items("k % 8", 7, f'''named_struct(
        'name', element_at({meds}, cast((k + i * i * 3) % 14 + 1 as int)), 'drug_name', element_at({meds}, cast((k + i * i * 3) % 14 + 1 as int)),
        'dose', concat(i + 1, 'mg'), 'route', element_at(array('PO', 'IV', 'SubQ', 'IM', 'PR', 'TOP', 'XX'), cast((k + i) % 7 + 1 as int)),
        'frequency', concat('Q', i), 'start_date', if((k + i) % 10 = 0, '', cast(date_add(date'2001-01-01', cast(k % 50 + i * 33 as int)) as string)),
        'prescriber', concat('N', (k + i) % 50), 'ordered_at', concat('2001-05-0', i + 1, ' 10:59:30'),
        'administered_at', if((k + i) % 5 = 0, null, concat('2001-05-0', i + 1, ' 11:', 10 + k % 49, ':00')))''')},
      'allergies', {_items("k % 4", 3, '''named_struct('allergen', concat('Al', (k + i) % 3), 'reaction', concat('Re', i),
        'severity', concat('Sv', (k + i) % 3), 'reported_date', if(i = 2, 'bad', concat('2000-0', i + 1, '-15')))''')},
      'immunizations', {_items("k % 3 + 1", 3, '''named_struct('vaccine_name', if((k + i) % 7 = 0, null, concat('Vx', i)),
        'vaccine_code', concat('c', i), 'administered_date', cast(date_add(date'1998-11-20', cast(k % 900 + i as int)) as string),
        'dose_number', i + 1, 'site', 'arm')''')},
      'insurance', {_items("k % 3 + 1", 3, '''named_struct('payer', concat('Pay', (k + i) % 5), 'plan_id', concat('Pl', (k + i) % 9),
        'group_id', concat('G', k % 6), 'type', if(i = 0 or (k % 50 = 0 and i = 1), 'Primary', 'Secondary'),
        'effective_date', cast(date_add(date'1999-01-31', cast(k % 400 as int)) as string), 'plan_type', concat('T', i))''')},
      'contacts', {_items("k % 3", 2, '''named_struct('name', concat('Con', i), 'phone', concat('(555) ', k, '-', i), 'relationship', concat('Rel', i))''')},
      'mds_assessment', if(k % 29 = 0, null, named_struct(
        'nursing_tier', element_at(array('ES3', 'ES2', 'HDE2', 'HDE1', 'CBC1'), cast(k % 5 + 1 as int)),
        'nta_tier', element_at(array('A', 'B', 'C', 'D'), cast(k % 4 + 1 as int)),
        'pt_tier', element_at(array('RU', 'RV', 'RH'), cast(k % 3 + 1 as int)),
        'ot_tier', element_at(array('RU', 'RV', 'RH'), cast((k + 1) % 3 + 1 as int)),
        'slp_tier', element_at(array('SA', 'SB', 'SC'), cast((k + 2) % 3 + 1 as int)),
        'section_i', {_items("k % 3", 2, "concat('I', (k + i) % 9)")},
        'section_o', {_items("k % 4", 3, "element_at(array('O0100 injectable meds', 'IV therapy', 'O0400 speech therapy'), cast((k + i) % 3 + 1 as int))")})),
      'lab_results', {_items("k % 3", 2, "i")},
      'name', if(k % 5 = 0, null, c_name), 'dob', if(k % 6 = 0, null, 'x'), 'gender', if(k % 7 = 0, null, 'y'),
      'notes', if(k % 12 = 0, null, concat('Pt ', element_at(array('admitted', 'acute', 'routine', 'PROGRESS', 'stable'), cast(k % 5 + 1 as int)),
        ' on metformin and Lasix BP 1', k % 90, '/80 with BNP level ', k, ' HTN CHF s/p fall')),
      'consent_form_id', if(k % 4 = 0, 'none', cast(k as string)), 'version', concat(k % 3, '.25'),
      'consent_date', if(k % 5 = 0, null, '2000-02-28'), 'expiry_date', if(k % 3 = 0, 'open', cast(date_add(date'2001-07-01', cast(k % 60 as int)) as string)),
      'consent_type', concat('ct', k % 2), 'signed_by', c_name)"""
    ingested = (
        "timestamp_ntz'2001-07-25 00:00:00' + make_dt_interval(cast(k % 7 as int), cast(k % 24 as int), "
        "cast(k % 60 as int)) - make_dt_interval(0, cast(old * 2 as int))"
    )
    return _envelope(copies, document, ingested)


LINE = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag", "l_shipdate"]


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with all their line items as an ordered array; the data model bounds the lines of an order."""
    lines = table(spark, sf_dir, "lineitem")
    items = ordered_list(lines, ["l_orderkey"], LINE, None, "l")
    return (
        table(spark, sf_dir, "orders")
        .join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .selectExpr("*", "o_orderkey AS k", "floor(o_totalprice) AS price")
    )


CODE = "if(x.l_partkey % 17 = 0, concat('X', x.l_partkey), cast(97000 + x.l_partkey % 3000 as string))"


def raw_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _lines(spark, sf_dir)
    document = f"""named_struct(
      'claim_id', concat('C', k), 'patient_id', concat('P', o_custkey), 'encounter_id', concat('E', k),
      'payer', o_orderpriority, 'claim_type', o_orderstatus,
      'status', element_at(array('Paid', 'Denied', 'Partially Paid', 'Pending'), cast(k % 4 + 1 as int)),
      'service_date', cast(to_date(o_orderdate) as string),
      'submit_date', if(k % 31 = 0, '2001-13-45', cast(date_add(to_date(o_orderdate), cast(k % 20 as int)) as string)),
      'remit_date', if(k % 5 = 0, null, cast(date_add(to_date(o_orderdate), cast(k % 20 + k % 45 as int)) as string)),
      'total_charges', if(k % 101 = 0, 0D, cast(price as double)), 'total_paid', price * (k % 5) / 4D,
      'total_denied', if(k % 2 = 0, null, (k % 7) * 10),
      'line_items', transform(l, x -> named_struct('line_no', x.l_linenumber, 'cpt', {CODE},
        'units', cast(x.l_quantity as int), 'charge', floor(x.l_extendedprice), 'paid', floor(x.l_extendedprice) / 2D,
        'adjustment', x.l_quantity, 'denial_code', if(x.l_returnflag = 'R', concat('DN', x.l_suppkey % 9), null))),
      'denial_reasons', if(k % 4 = 1, {_items("k % 3", 2, "concat(' Reason-', i, ' #', k % 5, ' ')")}, null))"""
    return _envelope(orders, document, "cast(o_orderdate as timestamp_ntz) + make_dt_interval(1)")


def raw_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _lines(spark, sf_dir).selectExpr(
        "*",
        "cast(o_orderdate as timestamp_ntz) + make_dt_interval(0, cast(k % 24 as int), cast(k * 7 % 60 as int)) AS a",
    )
    document = f"""named_struct(
      'encounter_id', concat('E', k), 'patient_id', concat('P', o_custkey), 'facility_id', concat('FAC0', o_custkey % 8),
      'encounter_type', element_at(array('Inpatient', 'Rehab', 'Observation', 'Emergency', 'Outpatient'), cast(k % 5 + 1 as int)),
      'admit_datetime', cast(a as string),
      'discharge_datetime', if(o_orderstatus = 'O', null, cast(a + make_dt_interval(cast(k % 90 as int), cast(k % 5 as int)) as string)),
      'attending_provider', named_struct('npi', if(k % 50 = 49, null, concat('N', k % 50)), 'name', concat('Dr ', k % 50), 'specialty', concat('Sp', k % 7)),
      'charges', named_struct('room_and_board', price / 4D, 'pharmacy', price / 2D, 'supplies', k % 100, 'professional', k % 1000, 'total', price),
      'discharge_disposition', concat('Disp', k % 4), 'payer_id', o_orderpriority,
      'authorization', if(k % 8 = 0, null, named_struct('auth_number', concat('Au', k), 'approved_days', k % 30, 'used_days', k % 35,
        'status', element_at(array('Approved', 'Denied', 'Pending'), cast(k % 3 + 1 as int)))),
      'procedures', transform(l, x -> named_struct('code', {CODE}, 'description', concat('part ', x.l_partkey),
        'units', cast(x.l_quantity as int), 'charge', floor(x.l_extendedprice), 'performed_by', concat('S', x.l_suppkey),
        'service_date', cast(to_date(x.l_shipdate) as string))),
      'diagnosis_codes', {_items("k % 4", 3, "concat('D', (k + i * 11) % 60)")},
      'care_plan', {_items("k % 3", 2, '''named_struct('goal', if((k + i) % 6 = 0, null, concat('Goal', (k + i) % 5)),
        'intervention', concat('Do', (k * 3 + i) % 8), 'status', 'open', 'priority', (k + i) % 4, 'target_date', if(i = 1, 'soon', '2001-09-0' || (i + 1)))''')},
      'documents', {_items("k % 3", 2, '''named_struct('doc_type', concat('Type', i), 'title', concat('Title', k % 10),
        'sections', transform(filter(sequence(0, 1), j -> j < (k + i) % 3), j -> named_struct('section_name', concat('Sec', j),
          'content', if((k + j) % 11 = 0, null, concat(if(k % 6 = 0, 'STAT ', ''), repeat('note ', cast(k % 150 as int)), j)))))''')},
      'discharge_medications', {_items("k % 4", 3, '''named_struct('drug_name', element_at(array('Atorvastatin', 'LisinoPRIL', 'Metoprolol', 'Aspirin', 'valsartan', 'Carvedilol'), cast((k + i) % 6 + 1 as int)),
        'dose', concat(i, 'mg'), 'frequency', 'QD', 'route', element_at(array('iv', 'IM', 'SubQ', 'PO', 'IVP'), cast((k + i) % 5 + 1 as int)))''')},
      'orders', transform(l, x -> named_struct('order_type', x.l_returnflag, 'description', concat('line ', x.l_linenumber),
        'charge', if(x.l_partkey % 10 = 0, 0, floor(x.l_extendedprice)))),
      'referral', if(k % 3 = 0, named_struct('to_provider', concat('N', k % 9), 'from_provider', concat('N', k % 11), 'specialty', concat('Sp', k % 7),
        'reason', concat('Why', k % 5), 'priority', concat('Pr', k % 3), 'referral_date', if(k % 21 = 0, 'later', cast(to_date(o_orderdate) as string)),
        'completed_date', if(k % 2 = 0, null, cast(date_add(to_date(o_orderdate), cast(k % 40 as int)) as string))), null))"""
    return _envelope(orders, document, "cast(o_orderdate as timestamp_ntz) + make_dt_interval(2)")


def raw_lab_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").selectExpr(
        "*", "event_id AS k", "cast(ts as timestamp_ntz) AS t", "floor(value) AS v"
    )
    flag = "case when v + i * 5 < 5 then 'LOW' when v + i * 5 > 60 then 'HIGH' end"
    document = f"""named_struct(
      'patient_id', concat('P', user_id), 'order_id', concat('L', lpad(k, 12, '0')), 'test_panel', event_type, 'panel_name', upper(event_type),
      'collected_at', cast(t as string), 'resulted_at', if(k % 14 = 0, 'pending', cast(t + make_dt_interval(0, cast(k % 50 as int)) as string)),
      'ordering_provider', concat('N', k % 50), 'status', concat('st', k % 3), 'critical_flag', k % 10 = 0,
      'results', {_items("k % 2 + 1", 2, f'''named_struct('analyte', concat('An', (k + i) % 3), 'test_name', concat('An', (k + i) % 3),
        'value', v + i * 5, 'result', v + i * 5, 'unit', if(k % 40 = 0, null, 'mg'), 'ref_low', 5, 'reference_low', 5,
        'ref_high', 60, 'reference_high', 60, 'flag', {flag})''')})"""
    return _envelope(events, document, "t + make_dt_interval(0, 0, 5)")


def raw_facility_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor events only; `raw_facility_records` has the other record kinds."""
    events = table(spark, sf_dir, "events").selectExpr(
        "*", "event_id AS k", "cast(ts as timestamp_ntz) AS t", "floor(value) AS v"
    )
    # The event types the models know.
    kinds = _list(
        ["bed_sensor", "nurse_call", "fall_alert", "med_dispense", "door_access", "temp_alarm", "elopement_risk", "equipment_check"]
    )
    document = f"""named_struct(
      'event_id', concat('V', lpad(k, 12, '0')), 'facility_id', concat('FAC0', user_id % 7),
      'event_type', element_at({kinds}, cast((k * 5 + user_id) % 8 + 1 as int)), 'timestamp', cast(t as string),
      'location', named_struct('wing', concat('W', user_id % 3), 'floor', user_id % 4, 'room', k % 30, 'bed', if(k % 30 = 7, null, concat('B', k % 2))),
      'patient_id', if(k % 9 = 0, null, concat('P', user_id)), 'staff_id', concat('S', k % 40),
      'severity', element_at(array('Critical', 'High', 'Medium', 'Low'), cast((k + user_id) % 4 + 1 as int)),
      'sensor_data', named_struct('value', v, 'unit', 'u', 'threshold', 100, 'is_breach', v > 100),
      'resolved', if(k % 37 = 0, null, k % 3 <> 0), 'resolution_time_minutes', if(k % 12 = 0, null, v),
      'tags', {_items("k % 3", 2, "element_at(array('urgent', 'escalated', 'routine'), cast((k + i) % 3 + 1 as int))")})"""
    return _envelope(events, document, "t + make_dt_interval(0, 0, 1)")


def raw_facility_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Budgets, quality measures, shifts, provider schedules and provider versions, one kind per row."""
    rows = table(spark, sf_dir, "supplier").selectExpr("*", "s_suppkey AS k", "floor(s_acctbal) AS bal")
    kinds = rows.selectExpr("*", "explode(sequence(0, 5)) AS kind")
    document = """named_struct(
      'facility_id', concat('FAC0', k % 8),
      'department', if(kind in (0, 4, 5), concat('Dep', k % 6), null),
      'budget', if(kind = 0, named_struct('allocated', if(k % 7 = 0, 0, 8192), 'spent', bal, 'remaining', 8192 - bal), null),
      'measure_id', if(kind = 1, concat('Q', k), null), 'measure_name', if(kind = 1, concat('Measure ', k % 9), null),
      'score', if(kind = 1, bal / 64D, null), 'benchmark', if(kind = 1, 64, null),
      'staff_id', if(kind = 2, s_name, null),
      'shift', if(kind = 2, named_struct('start_time', concat('2001-06-', lpad(k % 28 + 1, 2, '0'), ' ', lpad(k % 24, 2, '0'), ':30:00'),
        'end_time', cast(cast(concat('2001-06-', lpad(k % 28 + 1, 2, '0'), ' ', lpad(k % 24, 2, '0'), ':30:00') as timestamp_ntz) + make_dt_interval(0, cast(6 + k % 9 as int), cast(k % 50 as int)) as string),
        'role', concat('Role', k % 3), 'department', concat('Dep', k % 6)), null),
      'record_type', if(kind = 3, 'provider_schedule', null),
      'provider_id', if(kind >= 3, concat('N', k % 50), null), 'name', if(kind >= 3, concat(s_name, if(kind = 5, ' II', '')), null),
      'specialty', if(kind >= 3, concat('Sp', k % 7), null), 'is_active', if(kind >= 3, k % 4 <> 0, null),
      'hire_date', if(kind >= 4, cast(date_add(date'1980-01-01', cast(k * 53 % 7000 as int)) as string), null),
      'schedule', if(kind = 3, named_struct('monday', if(k % 9 = 0, null, named_struct('start_time', '08:50', 'end_time', if(k % 5 = 0, 'late', concat(10 + k % 9, ':10')))),
        'tuesday', named_struct('start_time', '09:00'), 'friday', if(k % 2 = 0, 'off', null)), null))"""
    ingested = "timestamp_ntz'2001-07-01 00:00:00' + make_dt_interval(cast(kind as int), 0, 0, cast(k as int))"
    return _envelope(kinds, document, ingested)


def facility_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A facility with beds for each nation; the first has none, those from 8 on have no patient."""
    return table(spark, sf_dir, "nation").selectExpr(
        "concat('FAC0', n_nationkey) AS facility_id", "n_name AS facility_name", "'SNF' AS facility_type",
        "concat('S', n_regionkey) AS state", "cast(n_nationkey * 10 as int) AS bed_count", "cast(n_regionkey as int) AS cms_rating",
    )


SOURCES = {
    "raw_patients": raw_patients,
    "raw_encounters": raw_encounters,
    "raw_lab_results": raw_lab_results,
    "raw_claims": raw_claims,
    "raw_facility_ops": raw_facility_ops,
    "raw_facility_records": raw_facility_records,
    "facility_reference": facility_reference,
}

_RECORD_MODELS = {
    "stg_facility_budgets", "stg_quality_measures", "stg_staff_schedules", "stg_provider_schedules", "dim_providers",
}


_WRITTEN: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The landing table, derived and written to the shared folder once per session, then read.

    A model reads its landing table several times; without the written table each time would join
    and serialise the documents again.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        path = fresh_path(spark, name)
        SOURCES[name](spark, sf_dir).write.option("compression", "zstd").parquet(path)
        _WRITTEN[key] = path
    if not name.startswith("raw_"):
        return spark.read.parquet(_WRITTEN[key])
    return read_landing(spark, _WRITTEN[key])


def landed_variant(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The landing table with its documents as VARIANT, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, f"{name} as variant")
    if key not in _WRITTEN:
        path = fresh_path(spark, f"{name}-variant")
        # Not from the landing table as text: it would be written and read back for this alone.
        write_variant(SOURCES[name](spark, sf_dir), path)
        _WRITTEN[key] = path
    return read_landing(spark, _WRITTEN[key])


class Landing(dict):
    """Landing relations, each opened when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, records: bool, variant: bool = False):
        super().__init__()
        self.spark, self.sf_dir, self.records, self.variant = spark, sf_dir, records, variant

    def __contains__(self, name) -> bool:
        return name in SOURCES or super().__contains__(name)

    def __missing__(self, name):
        opened = landed_variant if self.variant and name.startswith("raw_") else landed
        relation = opened(self.spark, self.sf_dir, name)
        if self.records and name == "raw_facility_ops":
            relation = relation.unionByName(opened(self.spark, self.sf_dir, "raw_facility_records"))
        self[name] = relation
        return relation


def model(spark: SparkSession, sf_dir: str, name: str, params: Params = PARAMS, variant: bool = False) -> DataFrame:
    return build(name, spark, Landing(spark, sf_dir, name in _RECORD_MODELS, variant), params)
