"""Check SQL for the models: every relation is stated directly over the given tables.

`RELATIONS` are named sub-queries in an order in which each uses only earlier ones.
"""

from __future__ import annotations

import re

NOW = "TIMESTAMP '2001-08-01 12:30:00'"
TODAY = "DATE '2001-08-01'"

_MEDS = (
    "['Warfarin','Aspirin','Heparin','Enoxaparin','Metformin','Insulin','Glipizide','Lisinopril','Losartan',"
    "'Metoprolol','Atorvastatin','Fenofibrate','Carvedilol','Zosyn']"
)


def _days(n: str) -> str:
    return f"CAST({n} AS INTEGER)"


def _div0(a: str, b: str) -> str:
    return f"(CASE WHEN {b} IS NULL OR {b} = 0 THEN 0.0 ELSE {a} / {b} END)"


_LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_returnflag, l_shipdate"
_CODE = "CASE WHEN l_partkey % 17 = 0 THEN 'X' || l_partkey ELSE CAST(97000 + l_partkey % 3000 AS VARCHAR) END"

RELATIONS: dict[str, str] = {
    # -- base shapes
    "pat": """
        SELECT c.*, c_custkey AS k, old,
          TIMESTAMP '2001-07-25' + to_days(CAST(c_custkey % 7 AS INTEGER)) + to_hours(c_custkey % 24)
            + to_minutes(c_custkey % 60) - to_hours(old * 2) AS ing
        FROM customer c, unnest(CASE WHEN c_custkey % 10 = 0 THEN [0, 1] ELSE [0] END) t(old)""",
    "ord": """
        SELECT *, o_orderkey AS k, floor(o_totalprice) AS price, CAST(o_orderdate AS DATE) AS day,
          o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_orderkey * 7 % 60) AS adm
        FROM orders""",
    "lin": f"""
        SELECT l.*, o.k, o.o_custkey, o.price, o.o_orderpriority, o.day,
          row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) - 1 AS pos, floor(l_extendedprice) AS chg
        FROM lineitem l JOIN ord o ON o.k = l.l_orderkey""",
    "eve": "SELECT *, event_id AS k, floor(value) AS v FROM events",
    # -- patients
    "stg_patients": f"""
        SELECT 'P' || k AS patient_id, 'F' || (k % 97) AS first_name, c_mktsegment AS last_name,
          'F' || (k % 97) || ' ' || c_mktsegment AS full_name, dob AS date_of_birth,
          datediff('year', dob, {TODAY}) AS age, CASE WHEN k % 2 = 0 THEN 'F' ELSE 'M' END AS gender, 'R' || (k % 5) AS race,
          'L' || (k % 4) AS preferred_language, 'M' || (k % 3) AS marital_status, sha256('900-' || k) AS ssn_hash,
          k || ' Main' AS street, 'City' || c_nationkey AS city, 'S' || (c_nationkey % 5) AS state, 'Z' || (k % 100) AS zip_code,
          'FAC0' || (k % 8) AS facility_id, adm AS admit_date, dis AS discharge_date, k % 3 = 0 AS is_current_resident,
          datediff('day', adm, coalesce(dis, {TODAY})) AS length_of_stay,
          CASE WHEN k % 19 <> 0 THEN 100 + k % 100 END AS bp_systolic, CASE WHEN k % 19 <> 0 THEN 60 + k % 70 END AS bp_diastolic,
          CASE WHEN k % 19 <> 0 AND k % 23 <> 0 THEN 45 + k % 120 - old * 7 END AS heart_rate,
          CASE WHEN k % 19 <> 0 THEN 97 + (k % 20) / 4.0::DOUBLE END AS temperature_f,
          CASE WHEN k % 19 <> 0 THEN CAST(100 + k % 150 AS DOUBLE) END AS weight_lbs,
          CASE WHEN k % 19 <> 0 THEN CASE WHEN k % 11 = 0 THEN 94 ELSE 85 + k % 15 END END AS o2_saturation,
          CASE WHEN k % 19 <> 0 THEN k % 11 END AS pain_level,
          CASE WHEN k % 17 <> 0 THEN least(k % 6, 5) END AS diagnosis_count, least(k % 8, 7) AS medication_count,
          k % 3 AS lab_result_count,
          CASE WHEN k % 12 <> 0 THEN 'Pt ' || ['admitted','acute','routine','PROGRESS','stable'][k % 5 + 1]
            || ' on metformin and Lasix BP 1' || (k % 90) || '/80 with BNP level ' || k || ' HTN CHF s/p fall' END AS clinical_notes,
          ing AS _ingested_at, 'derived' AS _source_file, '1' AS _batch_id
        FROM (SELECT *, DATE '1910-01-01' + {_days('k * 37 % 30000')} AS dob, DATE '2001-01-01' + {_days('k % 200')} AS adm,
                CASE WHEN k % 3 <> 0 THEN DATE '2001-01-01' + {_days('k % 200 + k % 90')} END AS dis FROM pat)""",
    "stg_allergies": f"""
        SELECT 'P' || k AS patient_id, 'Al' || ((k + i) % 3) AS allergen, 'Re' || i AS reaction_type, 'Sv' || ((k + i) % 3) AS severity,
          CASE WHEN i < 2 THEN CAST('2000-0' || (i + 1) || '-15' AS DATE) END AS reported_date, i + 1 AS allergy_seq, ing AS _ingested_at
        FROM pat, unnest(range(k % 4)) t(i)
        QUALIFY row_number() OVER (PARTITION BY patient_id, allergen ORDER BY ing DESC, i) = 1""",
    "dxs": f"""
        SELECT k, old, i, 'P' || k AS patient_id, ['I10', 'E11.65', 'D' || ((k * 7 + i * 3) % 40), 'D' || ((k + i * 5) % 60)][(k + i) % 4 + 1] AS code,
          'desc ' || ((k + i) % 4) AS descr, i = 0 OR (k % 25 = 0 AND i = 1) AS prim,
          CASE WHEN (k + i) % 9 <> 0 THEN DATE '2000-06-01' + {_days('k % 300 + i')} END AS onset,
          ['Acute','Chronic','Critical','Mild'][(k + i) % 4 + 1] AS severity, DATE '2001-01-01' + {_days('k % 200')} AS adm, ing
        FROM pat, unnest(range(k % 6)) t(i) WHERE k % 17 <> 0""",
    "stg_diagnoses": """
        SELECT patient_id, code AS icd10_code, descr AS diagnosis_description, prim AS is_primary, onset AS onset_date, severity,
          i + 1 AS diagnosis_sequence, adm AS admit_date, datediff('day', onset, adm) AS days_before_admission,
          CASE WHEN prim THEN 'Primary' ELSE 'Secondary' END AS diagnosis_type, ing AS _ingested_at
        FROM dxs QUALIFY row_number() OVER (PARTITION BY patient_id, code ORDER BY ing DESC, i) = 1""",
    "stg_primary_diagnosis": """
        SELECT patient_id, code AS primary_icd10, descr AS primary_diagnosis_desc, severity, onset AS onset_date,
          first_value(code) OVER (PARTITION BY patient_id ORDER BY i, ing DESC) AS confirmed_primary_dx, ing AS _ingested_at
        FROM dxs WHERE prim QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY ing DESC, i) = 1""",
    "meds": f"""
        SELECT k, i, ing, 'P' || k AS patient_id, {_MEDS}[(k + i * i * 3) % 14 + 1] AS drug, (i + 1) || 'mg' AS dose,
          ['PO','IV','SubQ','IM','PR','TOP','XX'][(k + i) % 7 + 1] AS route, 'Q' || i AS frequency,
          CASE WHEN (k + i) % 10 <> 0 THEN DATE '2001-01-01' + {_days('k % 50 + i * 33')} END AS start_date, 'N' || ((k + i) % 50) AS prescriber
        FROM pat, unnest(range(k % 8)) t(i)""",
    "stg_medications": """
        SELECT patient_id, drug AS medication_name, dose, route, frequency, start_date, prescriber AS prescriber_id, i + 1 AS medication_sequence,
          coalesce(map(['PO','IV','SubQ','IM','PR','TOP'], ['Oral','Intravenous','Subcutaneous','Intramuscular','Rectal','Topical'])[route], 'Other') AS route_description,
          route IN ('IV','SubQ','IM') AS is_injectable,
          CASE route WHEN 'IV' THEN 'High Risk' WHEN 'SubQ' THEN 'Moderate Risk' WHEN 'IM' THEN 'Moderate Risk' ELSE 'Standard' END AS risk_category,
          ing AS _ingested_at FROM meds""",
    "stg_medication_orders": """
        SELECT patient_id, 'E' || k AS encounter_id, drug AS medication_name, dose, route, frequency, drug || ',' || dose || ',' || route AS med_summary_array,
          k % 8 AS total_medications, i + 1 AS order_sequence, TIMESTAMP '2001-05-01 10:59:30' + to_days(CAST(i AS INTEGER)) AS ordered_at,
          CASE WHEN (k + i) % 5 <> 0 THEN TIMESTAMP '2001-05-01 11:10:00' + to_days(CAST(i AS INTEGER)) + to_minutes(k % 49) END AS administered_at,
          datediff('minute', ordered_at, administered_at) AS minutes_to_administer, ing AS _ingested_at FROM meds""",
    "stg_immunizations": f"""
        SELECT 'P' || k AS patient_id, 'Vx' || i AS vaccine_name, 'c' || i AS vaccine_code, DATE '1998-11-20' + {_days('k % 900 + i')} AS administered_date,
          i + 1 AS dose_number, 'arm' AS injection_site, i + 1 AS immunization_seq, datediff('day', administered_date, {TODAY}) AS days_since_vaccination,
          datediff('year', administered_date, {TODAY}) > 1 AS needs_booster, ing AS _ingested_at
        FROM pat, unnest(range(k % 3 + 1)) t(i) WHERE (k + i) % 7 <> 0""",
    "stg_insurance": f"""
        SELECT 'P' || k AS patient_id, 'Pay' || ((k + i) % 5) AS payer_name, 'Pl' || ((k + i) % 9) AS plan_id, 'G' || (k % 6) AS group_id,
          CASE WHEN i = 0 OR (k % 50 = 0 AND i = 1) THEN 'Primary' ELSE 'Secondary' END AS coverage_type, DATE '1999-01-31' + {_days('k % 400')} AS effective_date,
          i + 1 AS insurance_rank, coverage_type = 'Primary' AS is_primary, datediff('month', effective_date, {TODAY}) AS months_enrolled, ing AS _ingested_at
        FROM pat, unnest(range(k % 3 + 1)) t(i)""",
    "stg_patient_contacts": """
        SELECT 'P' || k AS patient_id, 'Con' || i AS contact_name, '(555) ' || k || '-' || i AS contact_phone, 'Rel' || i AS relationship,
          '555' || k || i AS phone_digits_only, i + 1 AS contact_priority, ing AS _ingested_at FROM pat, unnest(range(k % 3)) t(i)""",
    "stg_patient_consents": f"""
        SELECT 'P' || k AS patient_id, CASE WHEN k % 4 <> 0 THEN k END AS consent_form_id, DATE '2000-02-28' AS consent_date,
          CASE WHEN k % 3 <> 0 THEN DATE '2001-07-01' + {_days('k % 60')} END AS expiry_date, 'ct' || (k % 2) AS consent_type,
          coalesce(expiry_date >= {TODAY}, false) AS is_active, datediff('day', consent_date, coalesce(expiry_date, {TODAY})) AS days_since_consent,
          CAST(k % 3 + 0.25 AS DOUBLE) AS form_version, c_name AS signed_by, ing AS _ingested_at FROM pat WHERE k % 5 <> 0""",
    "stg_mds_assessments": """
        SELECT 'P' || k AS patient_id, nursing_tier, nta_tier, pt_tier, ot_tier, slp_tier, len(si) AS section_i_count, len(so) AS section_o_count,
          array_to_string(si, ', ') AS section_i_codes, array_to_string(so, ', ') AS section_o_services,
          CASE nursing_tier WHEN 'ES3' THEN 5 WHEN 'ES2' THEN 4 WHEN 'HDE2' THEN 3 WHEN 'HDE1' THEN 2 ELSE 1 END AS nursing_score,
          CASE nta_tier WHEN 'A' THEN 4 WHEN 'B' THEN 3 WHEN 'C' THEN 2 ELSE 1 END AS nta_score, ing AS _ingested_at
        FROM (SELECT *, CASE WHEN has THEN ['ES3','ES2','HDE2','HDE1','CBC1'][k % 5 + 1] END AS nursing_tier, CASE WHEN has THEN ['A','B','C','D'][k % 4 + 1] END AS nta_tier,
            CASE WHEN has THEN ['RU','RV','RH'][k % 3 + 1] END AS pt_tier, CASE WHEN has THEN ['RU','RV','RH'][(k + 1) % 3 + 1] END AS ot_tier,
            CASE WHEN has THEN ['SA','SB','SC'][(k + 2) % 3 + 1] END AS slp_tier,
            CASE WHEN has THEN [x FOR x IN ['I' || (k % 9), 'I' || ((k + 1) % 9)]][1:k % 3] END AS si,
            CASE WHEN has THEN [svc[k % 3 + 1], svc[(k + 1) % 3 + 1], svc[(k + 2) % 3 + 1]][1:k % 4] END AS so
          FROM (SELECT *, k % 29 <> 0 AS has, ['O0100 injectable meds', 'IV therapy', 'O0400 speech therapy'] AS svc FROM pat))""",
    "stg_mds_section_i": """
        SELECT 'P' || k AS patient_id, 'I' || ((k + i) % 9) AS section_i_icd10, i + 1 AS diagnosis_position, 'Section_I' AS mds_section,
          ['ES3','ES2','HDE2','HDE1','CBC1'][k % 5 + 1] AS nursing_tier, ing AS _ingested_at FROM pat, unnest(range(k % 3)) t(i) WHERE k % 29 <> 0""",
    "stg_mds_section_o": """
        SELECT 'P' || k AS patient_id, ['O0100 injectable meds', 'IV therapy', 'O0400 speech therapy'][(k + i) % 3 + 1] AS section_o_service,
          i + 1 AS service_position, 'Section_O' AS mds_section, (k + i) % 3 = 0 AS is_injectable, (k + i) % 3 = 1 AS is_iv_service, (k + i) % 3 > 0 AS is_therapy,
          [ 'O0100', NULL, 'O0400'][(k + i) % 3 + 1] AS service_code, ing AS _ingested_at FROM pat, unnest(range(k % 4)) t(i) WHERE k % 29 <> 0""",
    "stg_vitals": """
        SELECT patient_id, bp_systolic, bp_diastolic, heart_rate, temperature_f, weight_lbs, o2_saturation, pain_level,
          CASE WHEN n % 19 <> 0 AND n % 13 <> 0 THEN CAST('2001-07-30 0' || (n % 10) || ':15:00' AS TIMESTAMP) END AS recorded_at,
          CASE WHEN bp_systolic >= 180 OR bp_diastolic >= 120 THEN 'Hypertensive Crisis' WHEN bp_systolic >= 140 OR bp_diastolic >= 90 THEN 'Stage 2 HTN'
            WHEN bp_systolic >= 130 OR bp_diastolic >= 80 THEN 'Stage 1 HTN' WHEN bp_systolic >= 120 THEN 'Elevated' ELSE 'Normal' END AS bp_classification,
          CASE WHEN heart_rate < 60 THEN 'Bradycardia' WHEN heart_rate > 100 THEN 'Tachycardia' ELSE 'Normal' END AS hr_classification,
          coalesce(temperature_f > 100.4, false) AS has_fever,
          CASE WHEN o2_saturation < 90 THEN 'Critical' WHEN o2_saturation < 94 THEN 'Low' ELSE 'Normal' END AS o2_classification, _ingested_at
        FROM (SELECT *, CAST(patient_id[2:] AS BIGINT) AS n FROM stg_patients)""",
    "stg_vital_alerts": """
        SELECT 'P' || k AS patient_id, hr AS heart_rate, 100 + k % 100 AS systolic_bp, 60 + k % 70 AS diastolic_bp, 97 + (k % 20) / 4.0::DOUBLE AS temperature,
          o2 AS o2_saturation, CASE WHEN hr > 150 THEN 'CRITICAL' WHEN hr > 120 THEN 'HIGH' WHEN hr > 100 THEN 'MODERATE' WHEN hr < 50 THEN 'LOW_HR' ELSE 'NORMAL' END AS hr_alert_level,
          CASE WHEN o2 IS NULL THEN 'NOT_MEASURED' WHEN o2 < 90 THEN 'HYPOXIC' ELSE 'NORMAL' END AS o2_status,
          ['Lying Down','Seated','Upright','Unknown'][k % 4 + 1] AS patient_position, ing AS _ingested_at
        FROM (SELECT *, CASE WHEN k % 23 <> 0 THEN 45 + k % 120 - old * 7 END AS hr, CASE WHEN k % 4 <> 0 THEN 85 + k % 15 END AS o2 FROM pat) WHERE k % 19 <> 0""",
    "stg_vital_series": """
        SELECT patient_id, heart_rate, systolic_bp, temperature, o2_saturation AS o2_sat, _ingested_at AS reading_time,
          lag(heart_rate) OVER w AS prev_heart_rate, lead(heart_rate) OVER w AS next_heart_rate, heart_rate - prev_heart_rate AS hr_change,
          CASE WHEN abs(hr_change) > 20 THEN 'RAPID_CHANGE' ELSE 'STABLE' END AS hr_trend
        FROM stg_vital_alerts WHERE heart_rate IS NOT NULL WINDOW w AS (PARTITION BY patient_id ORDER BY _ingested_at, heart_rate)""",
    # -- encounters
    "stg_encounters": f"""
        SELECT 'E' || k AS encounter_id, 'P' || o_custkey AS patient_id, 'FAC0' || (o_custkey % 8) AS facility_id,
          ['Inpatient','Rehab','Observation','Emergency','Outpatient'][k % 5 + 1] AS encounter_type, adm AS admit_datetime,
          CASE WHEN o_orderstatus <> 'O' THEN adm + to_days(CAST(k % 90 AS INTEGER)) + to_hours(k % 5) END AS discharge_datetime,
          CASE WHEN k % 50 <> 49 THEN 'N' || (k % 50) END AS provider_npi, 'Dr ' || (k % 50) AS provider_name, 'Sp' || (k % 7) AS provider_specialty,
          price / 4 AS charge_room_board, price / 2 AS charge_pharmacy, CAST(k % 100 AS DOUBLE) AS charge_supplies, CAST(k % 1000 AS DOUBLE) AS charge_professional,
          price AS total_charges, 'Disp' || (k % 4) AS discharge_disposition, o_orderpriority AS payer_id, CASE WHEN k % 8 <> 0 THEN 'Au' || k END AS auth_number,
          CASE WHEN k % 8 <> 0 THEN k % 30 END AS approved_days, CASE WHEN k % 8 <> 0 THEN k % 35 END AS used_days,
          CASE WHEN k % 8 <> 0 THEN ['Approved','Denied','Pending'][k % 3 + 1] END AS auth_status,
          datediff('hour', adm, coalesce(discharge_datetime, {NOW})) AS total_hours, coalesce(approved_days, 0) - coalesce(used_days, 0) AS remaining_auth_days,
          coalesce(auth_status = 'Denied', false) AS is_auth_denied, day + {_days('coalesce(approved_days, 0)')} AS auth_expiry_date,
          (SELECT nullif(count(*), 0) FROM lineitem WHERE l_orderkey = k) AS procedure_count, k % 4 AS diagnosis_code_count,
          o_orderdate + to_days(1) + to_days(1) AS _ingested_at FROM ord""",
    "stg_procedures": f"""
        SELECT 'E' || k AS encounter_id, 'P' || o_custkey AS patient_id, {_CODE} AS procedure_code, 'part ' || l_partkey AS procedure_description,
          CAST(l_quantity AS BIGINT) AS units, chg AS charge_amount, 'S' || l_suppkey AS performed_by, CAST(l_shipdate AS DATE) AS service_date, pos + 1 AS line_number,
          CASE WHEN procedure_code[1] <> 'X' THEN procedure_code[1:2] END AS code_prefix,
          CASE procedure_code[1:2] WHEN '99' THEN 'E&M' WHEN '97' THEN 'Therapy' WHEN '98' THEN 'Procedure' ELSE 'Other' END AS procedure_category,
          price AS encounter_total_charges, chg / sum(chg) OVER (PARTITION BY k) AS charge_pct_of_encounter, CAST(day + 2 AS TIMESTAMP) AS _ingested_at FROM lin""",
    "stg_encounter_diagnoses": """
        SELECT 'E' || k AS encounter_id, 'P' || o_custkey AS patient_id, 'D' || ((k + i * 11) % 60) AS icd10_code, i + 1 AS diagnosis_rank, i = 0 AS is_primary,
          ['Inpatient','Rehab','Observation','Emergency','Outpatient'][k % 5 + 1] AS encounter_type, day AS encounter_date, CAST(day + 2 AS TIMESTAMP) AS _ingested_at
        FROM ord, unnest(range(k % 4)) t(i)""",
    "stg_care_plans": """
        SELECT 'P' || o_custkey AS patient_id, 'E' || k AS encounter_id, 'Goal' || ((k + i) % 5) AS care_goal, 'Do' || ((k * 3 + i) % 8) AS intervention, 'open' AS goal_status,
          (k + i) % 4 AS priority_rank, CASE WHEN i = 0 THEN DATE '2001-09-01' END AS target_date, i + 1 AS goal_sequence,
          string_agg('Do' || ((k * 3 + i) % 8), '; ' ORDER BY (k + i) % 4, 'E' || k, i) OVER (PARTITION BY o_custkey) AS all_interventions,
          CAST(day + 2 AS TIMESTAMP) AS _ingested_at
        FROM ord, unnest(range(k % 3)) t(i) WHERE (k + i) % 6 <> 0""",
    "stg_clinical_documents": """
        SELECT 'P' || o_custkey AS patient_id, 'E' || k AS encounter_id, 'Type' || i AS document_type, 'Title' || (k % 10) AS title, 'Sec' || j AS section_name,
          left(txt, 500) AS content_preview, length(txt) AS content_length, k % 6 = 0 AS is_urgent
        FROM (SELECT o_custkey, k, i, j, CASE WHEN k % 6 = 0 THEN 'STAT ' ELSE '' END || repeat('note ', k % 150) || j AS txt
              FROM ord, unnest(range(k % 3)) t(i), unnest(range((k + i) % 3)) s(j) WHERE (k + j) % 11 <> 0)""",
    "stg_discharge_meds": """
        SELECT 'P' || o_custkey AS patient_id, 'E' || k AS encounter_id, ['Atorvastatin','LisinoPRIL','Metoprolol','Aspirin','valsartan','Carvedilol'][(k + i) % 6 + 1] AS medication_name,
          i || 'mg' AS dose, 'QD' AS frequency, ['iv','IM','SubQ','PO','IVP'][(k + i) % 5 + 1] AS route, (k + i) % 6 = 0 AS is_statin, (k + i) % 6 IN (1, 4) AS is_ace_arb,
          (k + i) % 6 IN (2, 5) AS is_beta_blocker, (k + i) % 5 < 3 AS is_injectable, i + 1 AS medication_seq, k % 4 AS total_discharge_meds, CAST(day + 2 AS TIMESTAMP) AS _ingested_at
        FROM ord, unnest(range(k % 4)) t(i)""",
    "stg_order_history": """
        SELECT 'P' || o_custkey AS patient_id, 'E' || k AS encounter_id, l_returnflag AS order_type, 'line ' || l_linenumber AS order_description, chg AS order_charge,
          pos + 1 AS order_sequence, chg / sum(chg) OVER (PARTITION BY k) AS charge_pct_of_encounter, sum(chg) OVER (PARTITION BY k) AS encounter_total_charges,
          CAST(day + 2 AS TIMESTAMP) AS _ingested_at FROM lin WHERE l_partkey % 10 <> 0 AND chg > 0""",
    "stg_referrals": f"""
        SELECT 'P' || o_custkey AS patient_id, 'E' || k AS encounter_id, 'N' || (k % 9) AS referred_to, 'N' || (k % 11) AS referred_from, 'Sp' || (k % 7) AS referral_specialty,
          'Why' || (k % 5) AS referral_reason, 'Pr' || (k % 3) AS priority, CASE WHEN k % 21 <> 0 THEN day END AS referral_date,
          CASE WHEN k % 2 <> 0 THEN day + {_days('k % 40')} END AS completed_date, datediff('day', referral_date, coalesce(completed_date, {TODAY})) AS days_to_complete,
          row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN k % 21 <> 0 THEN day END DESC NULLS LAST, 'E' || k) AS referral_recency_rank,
          CAST(day + 2 AS TIMESTAMP) AS _ingested_at FROM ord WHERE k % 3 = 0""",
    # -- labs
    "labs": """
        SELECT *, 'An' || ((k + i) % 3) AS an, v + i * 5 AS val,
          CASE WHEN v + i * 5 < 5 THEN 'LOW' WHEN v + i * 5 > 60 THEN 'HIGH' END AS flag, CASE WHEN k % 40 <> 0 THEN 'mg' END AS unit
        FROM eve, unnest(range(k % 2 + 1)) t(i)""",
    "stg_lab_results": """
        SELECT 'P' || user_id AS patient_id, 'L' || lpad(CAST(k AS VARCHAR), 12, '0') AS order_id, event_type AS test_panel, an AS analyte_name, val AS result_value, unit,
          5.0::DOUBLE AS reference_low, 60.0::DOUBLE AS reference_high, coalesce(flag, 'NORMAL') AS result_flag,
          CASE WHEN val < 5 THEN 'Below Normal' WHEN val > 60 THEN 'Above Normal' ELSE 'Normal' END AS interpretation, ts AS collected_at,
          CASE WHEN k % 14 <> 0 THEN ts + to_hours(k % 50) END AS resulted_at, datediff('hour', collected_at, resulted_at) AS turnaround_hours,
          'N' || (k % 50) AS ordering_provider, 'st' || (k % 3) AS result_status, k % 10 = 0 AS is_critical,
          lag(val) OVER w AS previous_value, val - coalesce(previous_value, val) AS value_change, ts + to_minutes(5) AS _ingested_at
        FROM labs WINDOW w AS (PARTITION BY user_id, an ORDER BY ts, k, i)""",
    "stg_lab_panels": """
        SELECT 'P' || user_id AS patient_id, upper(event_type) AS panel_name, an AS test_name, val AS result_value, unit, 5.0::DOUBLE AS ref_low, 60.0::DOUBLE AS ref_high,
          coalesce(flag, 'NORMAL') AS result_flag, val - 5 AS deviation_from_low, val - 60 AS deviation_from_high, i + 1 AS test_sequence, k % 2 + 1 AS tests_in_panel,
          ts AS collected_at, ts + to_minutes(5) AS _ingested_at FROM labs""",
    # -- claims
    "stg_claims": f"""
        SELECT 'C' || k AS claim_id, 'P' || o_custkey AS patient_id, 'E' || k AS encounter_id, o_orderpriority AS payer_name, o_orderstatus AS claim_type,
          ['Paid','Denied','Partially Paid','Pending'][k % 4 + 1] AS claim_status, day AS service_date, CASE WHEN k % 31 <> 0 THEN day + {_days('k % 20')} END AS submit_date,
          CASE WHEN k % 5 <> 0 THEN day + {_days('k % 20 + k % 45')} END AS remit_date, CASE WHEN k % 101 = 0 THEN 0.0 ELSE price END AS total_charges,
          price * (k % 5) / 4.0::DOUBLE AS total_paid, CASE WHEN k % 2 = 0 THEN 0.0 ELSE (k % 7) * 10.0 END::DOUBLE AS total_denied,
          total_charges - total_paid - total_denied AS outstanding_amount, {_div0('total_paid', 'total_charges')} AS payment_ratio,
          datediff('day', service_date, submit_date) AS days_to_submit, datediff('day', submit_date, remit_date) AS days_to_payment,
          (SELECT nullif(count(*), 0) FROM lineitem WHERE l_orderkey = k) AS line_item_count, CASE WHEN k % 4 = 1 THEN k % 3 END AS denial_reason_count,
          k % 4 = 1 AS is_denied, k % 2 = 0 AS is_paid, CAST(day + 1 AS TIMESTAMP) AS _ingested_at FROM ord""",
    "stg_claim_lines": f"""
        SELECT 'C' || k AS claim_id, 'P' || o_custkey AS patient_id, o_orderpriority AS payer_name, l_linenumber AS line_number, {_CODE} AS cpt_code,
          CAST(l_quantity AS BIGINT) AS units, chg AS line_charge, chg / 2 AS line_paid, l_quantity AS line_adjustment,
          CASE WHEN l_returnflag = 'R' THEN 'DN' || (l_suppkey % 9) END AS denial_code, l_returnflag = 'R' AS is_line_denied,
          {_div0('chg', '(CASE WHEN k % 101 = 0 THEN 0.0 ELSE price END)')} AS pct_of_total, CAST(day + 1 AS TIMESTAMP) AS _ingested_at,
          sum(chg) OVER (PARTITION BY k ORDER BY pos ROWS UNBOUNDED PRECEDING) AS running_charge_total FROM lin""",
    "stg_denial_reasons": f"""
        SELECT 'C' || k AS claim_id, 'P' || o_custkey AS patient_id, o_orderpriority AS payer_name, ' Reason-' || i || ' #' || (k % 5) || ' ' AS denial_reason_raw,
          ' Reason' || i || ' ' || (k % 5) || ' ' AS denial_reason_clean, 'REASON-' || i || ' #' || (k % 5) AS denial_reason_normalized, i + 1 AS denial_sequence,
          CASE WHEN k % 2 <> 0 THEN (k % 7) * 10.0 END::DOUBLE AS denied_amount, CASE WHEN k % 101 = 0 THEN 0.0 ELSE price END AS total_charges,
          {_div0('denied_amount', 'total_charges')} AS denial_rate, CAST(day + 1 AS TIMESTAMP) AS _ingested_at
        FROM ord, unnest(range(k % 3)) t(i) WHERE k % 4 = 1""",
    # -- facility operations
    "stg_facility_events": """
        SELECT 'V' || lpad(CAST(k AS VARCHAR), 12, '0') AS event_id, 'FAC0' || (user_id % 7) AS facility_id,
          ['bed_sensor','nurse_call','fall_alert','med_dispense','door_access','temp_alarm','elopement_risk','equipment_check'][(k * 5 + user_id) % 8 + 1] AS event_type,
          ts AS event_timestamp, 'W' || (user_id % 3) AS wing, user_id % 4 AS floor_number, k % 30 AS room_number, CASE WHEN k % 30 <> 7 THEN 'B' || (k % 2) END AS bed_id,
          wing || '-' || floor_number || '-' || room_number || bed_id AS full_location, CASE WHEN k % 9 <> 0 THEN 'P' || user_id END AS patient_id, 'S' || (k % 40) AS staff_id,
          ['Critical','High','Medium','Low'][(k + user_id) % 4 + 1] AS severity, v AS sensor_value, 'u' AS sensor_unit, 100.0::DOUBLE AS sensor_threshold, v > 100 AS is_threshold_breach,
          CASE WHEN k % 37 <> 0 THEN k % 3 <> 0 END AS is_resolved, CASE WHEN k % 12 <> 0 THEN CAST(v AS BIGINT) END AS resolution_minutes,
          CASE WHEN coalesce(resolution_minutes, 0) >= 120 THEN 7 ELSE CAST(floor(coalesce(resolution_minutes, 0) / 20) AS BIGINT) + 1 END AS response_time_bucket,
          coalesce(['0-20min','20-40min','40-60min','60-80min','80-100min','100-120min'][response_time_bucket], '120min+') AS response_time_band, k % 3 AS tag_count,
          ts + to_minutes(1) AS _ingested_at FROM eve""",
    "stg_facility_tags": """
        SELECT e.event_id, e.facility_id, e.event_type, ['urgent','escalated','routine'][(k + i) % 3 + 1] AS tag, i + 1 AS tag_position, e.severity, (k + i) % 3 = 0 AS is_urgent,
          (k + i) % 3 = 1 AS is_escalated, e.event_timestamp, e._ingested_at
        FROM (SELECT *, CAST(event_id[2:] AS BIGINT) AS k FROM stg_facility_events) e, unnest(range(k % 3)) t(i)""",
    "sup": """
        SELECT s.*, s_suppkey AS k, floor(s_acctbal) AS bal, kind,
          TIMESTAMP '2001-07-01' + to_days(CAST(kind AS INTEGER)) + to_seconds(s_suppkey) AS ing FROM supplier s, unnest(range(6)) t(kind)""",
    "stg_facility_budgets": f"""
        SELECT 'FAC0' || (k % 8) AS facility_id, 'Dep' || (k % 6) AS department, alloc AS budget_allocated, bal AS budget_spent, 8192 - bal AS budget_remaining,
          {_div0('bal', 'alloc')} AS utilization_rate, {_div0('(8192 - bal)', 'alloc')} AS remaining_pct,
          CASE WHEN utilization_rate < 0 THEN 0 WHEN utilization_rate >= 1.5 THEN 6 ELSE CAST(floor(utilization_rate / 0.3) AS BIGINT) + 1 END AS utilization_bucket,
          CASE WHEN utilization_rate > 1.0 THEN 'OVER_BUDGET' WHEN utilization_rate > 0.9 THEN 'AT_RISK' WHEN utilization_rate > 0.7 THEN 'ON_TRACK' ELSE 'UNDER_UTILIZED' END AS budget_status,
          ing AS _ingested_at FROM (SELECT *, CASE WHEN k % 7 = 0 THEN 0.0 ELSE 8192.0 END::DOUBLE AS alloc FROM sup) WHERE kind = 0""",
    "stg_quality_measures": f"""
        SELECT 'FAC0' || (k % 8) AS facility_id, 'Q' || k AS measure_id, 'Measure ' || (k % 9) AS measure_name, bal / 64.0::DOUBLE AS score, 64.0::DOUBLE AS benchmark,
          score - 64 AS variance_from_benchmark, score / 64 AS score_to_benchmark_ratio,
          CASE WHEN score < 0 THEN 0 WHEN score >= 100 THEN 6 ELSE CAST(floor(score / 20) AS BIGINT) + 1 END AS quality_tier,
          CASE WHEN score >= 64 * 1.1 THEN 'EXCEEDS' WHEN score >= 64 THEN 'MEETS' WHEN score >= 64 * 0.8 THEN 'BELOW' ELSE 'CRITICAL' END AS performance_status,
          ing AS _ingested_at FROM sup WHERE kind = 1""",
    "stg_staff_schedules": f"""
        SELECT 'FAC0' || (k % 8) AS facility_id, s_name AS staff_id, b AS shift_start, b + to_hours(6 + k % 9) + to_minutes(k % 50) AS shift_end,
          datediff('hour', shift_start, shift_end) AS shift_hours, 'Role' || (k % 3) AS shift_role, 'Dep' || (k % 6) AS department, b + to_hours(12) AS next_eligible_start,
          CASE WHEN shift_hours > 12 THEN 'EXTENDED' ELSE 'STANDARD' END AS shift_type, dayofweek(b) AS day_of_week, dayofweek(b) IN (0, 6) AS is_weekend, ing AS _ingested_at
        FROM (SELECT *, TIMESTAMP '2001-06-01 00:30:00' + to_days({_days('k % 28')}) + to_hours(k % 24) AS b FROM sup) WHERE kind = 2""",
    "stg_provider_schedules": """
        SELECT 'N' || (k % 50) AS provider_id, s_name AS provider_name, 'Sp' || (k % 7) AS specialty,
          '{' || CASE WHEN k % 9 <> 0 THEN '"monday":"{\\"start_time\\":\\"08:50\\",\\"end_time\\":\\"' || CASE WHEN k % 5 = 0 THEN 'late' ELSE (10 + k % 9) || ':10' END || '\\"}",' ELSE '' END
            || '"tuesday":"{\\"start_time\\":\\"09:00\\"}"}' AS weekly_schedule,
          1 + (k % 9 <> 0)::INT + (k % 2 = 0)::INT AS scheduled_days_count, CASE WHEN k % 9 <> 0 THEN '08:50' END AS monday_start,
          CASE WHEN k % 9 <> 0 THEN CASE WHEN k % 5 = 0 THEN 'late' ELSE (10 + k % 9) || ':10' END END AS monday_end,
          CASE WHEN k % 9 <> 0 AND k % 5 <> 0 THEN 10 + k % 9 - 8 END AS monday_hours, CASE WHEN k % 4 <> 0 THEN 'Active' ELSE 'Inactive' END AS status, ing AS _ingested_at
        FROM sup WHERE kind = 3""",
}

_TEXT = {
    "stg_patients": "date_of_birth admit_date discharge_date",
    "stg_allergies": "reported_date",
    "stg_diagnoses": "onset_date admit_date",
    "stg_primary_diagnosis": "onset_date",
    "stg_medications": "start_date",
    "stg_medication_orders": "ordered_at administered_at",
    "stg_immunizations": "administered_date",
    "stg_insurance": "effective_date",
    "stg_patient_consents": "consent_date expiry_date",
    "stg_vitals": "recorded_at",
    "stg_vital_series": "reading_time",
    "stg_encounters": "admit_datetime discharge_datetime auth_expiry_date",
    "stg_procedures": "service_date",
    "stg_encounter_diagnoses": "encounter_date",
    "stg_care_plans": "target_date",
    "stg_referrals": "referral_date completed_date",
    "stg_lab_results": "collected_at resulted_at",
    "stg_lab_panels": "collected_at",
    "stg_claims": "service_date submit_date remit_date",
    "stg_facility_events": "event_timestamp",
    "stg_facility_tags": "event_timestamp",
    "stg_staff_schedules": "shift_start shift_end next_eligible_start",
}
_NO_INGEST = {"stg_clinical_documents", "stg_vital_series"}


def with_relations(body: str) -> str:
    """`body` preceded by the relations it needs."""
    needed: set[str] = set()
    frontier = body
    for name in reversed(RELATIONS):
        if re.search(rf"\b{name}\b", frontier):
            needed.add(name)
            frontier += RELATIONS[name]
    parts = [f"{n} AS ({RELATIONS[n]})" for n in RELATIONS if n in needed]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def as_text(body: str, columns: str) -> str:
    """`body` with date and timestamp columns as text."""
    casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns.split())
    return f"SELECT * REPLACE ({casts}) FROM ({body})" if casts else body


def staging_oracles() -> dict[str, str]:
    out = {}
    for name in RELATIONS:
        if name.startswith("stg_"):
            columns = _TEXT.get(name, "") + ("" if name in _NO_INGEST else " _ingested_at")
            out[name] = with_relations(as_text(f"SELECT * FROM {name}", columns))
    return out
