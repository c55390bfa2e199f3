"""Staging models: typed relations out of the landing documents.

Every model parses a document once, with a schema of just the fields it reads. Leaves arrive as
text: `.cast` fails on malformed text, `.try_cast` gives NULL. Ties in "latest row" and neighbour
rules are settled by further columns, so results are repeatable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions import (
    band,
    boundary_diff,
    clock_time,
    day_of_week,
    div0null,
    find_text,
    iff,
    lookup,
    mask_pii,
    plus,
    share,
    squash,
    whole,
    zero_if_null,
)
from wardflow.operators.aggregates import ordered_list
from wardflow.operators.ordered import (
    asc,
    desc,
    group_totals,
    join_facts,
    lag,
    lead,
    ordered_window,
    row_number,
    running,
)
from wardflow.operators.relational import latest_by
from wardflow.operators.semi import flatten, flatten_keep, object_keys
from wardflow.params import Params
from wardflow.session import settle
from wardflow.sources.landing import parse

# Routes of medication.
ROUTES = {
    "PO": "Oral",
    "IV": "Intravenous",
    "SubQ": "Subcutaneous",
    "IM": "Intramuscular",
    "PR": "Rectal",
    "TOP": "Topical",
}

VITALS = "vitals struct<{}>"


def _d(name: str) -> Column:
    return F.col(name).try_cast("date")


def _ts(name: str) -> Column:
    return F.col(name).try_cast("timestamp_ntz")


def _num(name: str) -> Column:
    return F.col(name).cast("double")


def _flag(condition: Column) -> Column:
    return iff(condition, True, False)


# ---- patients -----------------------------------------------------------------------------------


def stg_patients(raw_patients: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_patients,
        "patient_id string, demographics struct<first_name:string,last_name:string,dob:string,gender:string,"
        "race:string,language:string,marital_status:string,ssn:string>,"
        "address struct<street:string,city:string,state:string,zip:string>,"
        "facility_id string, admit_date string, discharge_date string,"
        "vitals struct<bp_systolic:string,bp_diastolic:string,heart_rate:string,temperature:string,"
        "weight_lbs:string,o2_saturation:string,pain_level:string>,"
        "diagnoses array<string>, medications array<string>, lab_results array<string>, notes string",
    )
    who, home = "demographics", "address"
    born = F.col(f"{who}.dob").cast("date")
    admitted, left = F.col("admit_date").cast("date"), F.col("discharge_date").cast("date")
    return doc.select(
        "patient_id",
        F.col(f"{who}.first_name"),
        F.col(f"{who}.last_name"),
        F.concat(F.col(f"{who}.first_name"), F.lit(" "), F.col(f"{who}.last_name")).alias("full_name"),
        born.alias("date_of_birth"),
        boundary_diff("year", born, params.today()).alias("age"),
        F.col(f"{who}.gender"),
        F.col(f"{who}.race"),
        F.col(f"{who}.language").alias("preferred_language"),
        F.col(f"{who}.marital_status"),
        mask_pii(F.col(f"{who}.ssn")).alias("ssn_hash"),
        F.col(f"{home}.street"),
        F.col(f"{home}.city"),
        F.col(f"{home}.state"),
        F.col(f"{home}.zip").alias("zip_code"),
        "facility_id",
        admitted.alias("admit_date"),
        left.alias("discharge_date"),
        F.col("discharge_date").isNull().alias("is_current_resident"),
        boundary_diff("day", admitted, F.coalesce(left, params.today())).alias("length_of_stay"),
        *[whole(F.col(f"vitals.{v}")).alias(v) for v in ("bp_systolic", "bp_diastolic", "heart_rate")],
        _num("vitals.temperature").alias("temperature_f"),
        _num("vitals.weight_lbs").alias("weight_lbs"),
        *[whole(F.col(f"vitals.{v}")).alias(v) for v in ("o2_saturation", "pain_level")],
        F.array_size("diagnoses").alias("diagnosis_count"),
        F.array_size("medications").alias("medication_count"),
        F.array_size("lab_results").alias("lab_result_count"),
        F.col("notes").alias("clinical_notes"),
        "_ingested_at",
        "_source_file",
        "_batch_id",
    )


def stg_allergies(raw_patients: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_patients,
        "patient_id string, allergies array<struct<allergen:string,reaction:string,severity:string,reported_date:string>>",
    )
    rows = flatten(doc, "allergies").select(
        "patient_id",
        F.col("item.allergen"),
        F.col("item.reaction").alias("reaction_type"),
        F.col("item.severity"),
        _d("item.reported_date").alias("reported_date"),
        (F.col("pos") + 1).alias("allergy_seq"),
        "_ingested_at",
    )
    return latest_by(rows, ["patient_id", "allergen"], [desc("_ingested_at"), asc("allergy_seq")])


_DIAGNOSES = (
    "patient_id string, admit_date string, diagnoses array<struct<icd10:string,description:string,"
    "is_primary:string,onset:string,severity:string>>"
)


def stg_diagnoses(raw_patients: DataFrame, params: Params) -> DataFrame:
    admitted, onset = F.col("admit_date").cast("date"), _d("item.onset")
    primary = F.col("item.is_primary").cast("boolean")
    rows = flatten(parse(raw_patients, _DIAGNOSES), "diagnoses").select(
        "patient_id",
        F.col("item.icd10").alias("icd10_code"),
        F.col("item.description").alias("diagnosis_description"),
        primary.alias("is_primary"),
        onset.alias("onset_date"),
        F.col("item.severity"),
        (F.col("pos") + 1).alias("diagnosis_sequence"),
        admitted.alias("admit_date"),
        boundary_diff("day", onset, admitted).alias("days_before_admission"),
        iff(primary, "Primary", "Secondary").alias("diagnosis_type"),
        "_ingested_at",
    )
    return latest_by(rows, ["patient_id", "icd10_code"], [desc("_ingested_at"), asc("diagnosis_sequence")])


def stg_primary_diagnosis(raw_patients: DataFrame, params: Params) -> DataFrame:
    rows = (
        flatten(parse(raw_patients, _DIAGNOSES), "diagnoses")
        .filter(F.col("item.is_primary").cast("boolean"))
        .select(
            "patient_id",
            F.col("item.icd10").alias("primary_icd10"),
            F.col("item.description").alias("primary_diagnosis_desc"),
            F.col("item.severity"),
            _d("item.onset").alias("onset_date"),
            "_ingested_at",
            F.col("pos"),
        )
    )
    # The code at the lowest position over all documents of the patient; the newest document on ties.
    first = latest_by(rows, ["patient_id"], [asc("pos"), desc("_ingested_at")]).select(
        "patient_id", F.col("primary_icd10").alias("confirmed_primary_dx")
    )
    latest = latest_by(rows, ["patient_id"], [desc("_ingested_at"), asc("pos")])
    return latest.join(first, "patient_id", "left").select(
        "patient_id", "primary_icd10", "primary_diagnosis_desc", "severity", "onset_date",
        "confirmed_primary_dx", "_ingested_at",
    )


def stg_medications(raw_patients: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_patients,
        "patient_id string, medications array<struct<name:string,dose:string,route:string,frequency:string,"
        "start_date:string,prescriber:string>>",
    )
    route = F.col("item.route")
    return flatten(doc, "medications").select(
        "patient_id",
        F.col("item.name").alias("medication_name"),
        F.col("item.dose"),
        route,
        F.col("item.frequency"),
        _d("item.start_date").alias("start_date"),
        F.col("item.prescriber").alias("prescriber_id"),
        (F.col("pos") + 1).alias("medication_sequence"),
        lookup(route, ROUTES, "Other").alias("route_description"),
        _flag(route.isin("IV", "SubQ", "IM")).alias("is_injectable"),
        band([(route == "IV", "High Risk"), (route.isin("SubQ", "IM"), "Moderate Risk")], "Standard").alias(
            "risk_category"
        ),
        "_ingested_at",
    )


def stg_medication_orders(raw_patients: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_patients,
        "patient_id string, encounter_id string, medications array<struct<drug_name:string,dose:string,"
        "route:string,frequency:string,ordered_at:string,administered_at:string>>",
    )
    ordered, given = _ts("item.ordered_at"), _ts("item.administered_at")
    return flatten_keep(doc, "medications").select(
        "patient_id",
        "encounter_id",
        F.col("item.drug_name").alias("medication_name"),
        F.col("item.dose"),
        F.col("item.route"),
        F.col("item.frequency"),
        F.array("item.drug_name", "item.dose", "item.route").alias("med_summary_array"),
        F.array_size("medications").alias("total_medications"),
        (F.col("pos") + 1).alias("order_sequence"),
        ordered.alias("ordered_at"),
        given.alias("administered_at"),
        boundary_diff("minute", ordered, given).alias("minutes_to_administer"),
        "_ingested_at",
    )


def stg_immunizations(raw_patients: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_patients,
        "patient_id string, immunizations array<struct<vaccine_name:string,vaccine_code:string,"
        "administered_date:string,dose_number:string,site:string>>",
    )
    given = _d("item.administered_date")
    return (
        flatten(doc, "immunizations")
        .filter(F.col("item.vaccine_name").isNotNull())
        .select(
            "patient_id",
            F.col("item.vaccine_name"),
            F.col("item.vaccine_code"),
            given.alias("administered_date"),
            whole(F.col("item.dose_number")).alias("dose_number"),
            F.col("item.site").alias("injection_site"),
            (F.col("pos") + 1).alias("immunization_seq"),
            boundary_diff("day", given, params.today()).alias("days_since_vaccination"),
            _flag(boundary_diff("year", given, params.today()) > 1).alias("needs_booster"),
            "_ingested_at",
        )
    )


def stg_insurance(raw_patients: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_patients,
        "patient_id string, insurance array<struct<payer:string,plan_id:string,group_id:string,type:string,"
        "effective_date:string>>",
    )
    start = _d("item.effective_date")
    return flatten(doc, "insurance").select(
        "patient_id",
        F.col("item.payer").alias("payer_name"),
        F.col("item.plan_id"),
        F.col("item.group_id"),
        F.col("item.type").alias("coverage_type"),
        start.alias("effective_date"),
        (F.col("pos") + 1).alias("insurance_rank"),
        _flag(F.col("item.type") == "Primary").alias("is_primary"),
        boundary_diff("month", start, params.today()).alias("months_enrolled"),
        "_ingested_at",
    )


def stg_patient_contacts(raw_patients: DataFrame, params: Params) -> DataFrame:
    doc = parse(raw_patients, "patient_id string, contacts array<struct<name:string,phone:string,relationship:string>>")
    return flatten(doc, "contacts").select(
        "patient_id",
        F.col("item.name").alias("contact_name"),
        F.col("item.phone").alias("contact_phone"),
        F.col("item.relationship"),
        squash(F.col("item.phone"), "0-9").alias("phone_digits_only"),
        (F.col("pos") + 1).alias("contact_priority"),
        "_ingested_at",
    )


def stg_patient_consents(raw_patients: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_patients,
        "patient_id string, consent_form_id string, version string, consent_date string, expiry_date string,"
        "consent_type string, signed_by string",
    )
    given, ends = _d("consent_date"), _d("expiry_date")
    return doc.filter(F.col("consent_date").isNotNull()).select(
        "patient_id",
        whole(F.col("consent_form_id"), safe=True).alias("consent_form_id"),
        given.alias("consent_date"),
        ends.alias("expiry_date"),
        "consent_type",
        _flag(ends >= params.today()).alias("is_active"),
        boundary_diff("day", given, F.coalesce(ends, params.today())).alias("days_since_consent"),
        F.col("version").try_cast("decimal(10,2)").alias("form_version"),
        "signed_by",
        "_ingested_at",
    )


_MDS = (
    "patient_id string, mds_assessment struct<nursing_tier:string,nta_tier:string,pt_tier:string,ot_tier:string,"
    "slp_tier:string,section_i:array<string>,section_o:array<string>>"
)


def stg_mds_assessments(raw_patients: DataFrame, params: Params) -> DataFrame:
    mds = parse(raw_patients, _MDS).select("patient_id", "mds_assessment.*", "_ingested_at")
    return mds.select(
        "patient_id",
        "nursing_tier", "nta_tier", "pt_tier", "ot_tier", "slp_tier",
        F.array_size("section_i").alias("section_i_count"),
        F.array_size("section_o").alias("section_o_count"),
        F.array_join("section_i", ", ").alias("section_i_codes"),
        F.array_join("section_o", ", ").alias("section_o_services"),
        lookup(F.col("nursing_tier"), {"ES3": 5, "ES2": 4, "HDE2": 3, "HDE1": 2}, 1).alias("nursing_score"),
        lookup(F.col("nta_tier"), {"A": 4, "B": 3, "C": 2}, 1).alias("nta_score"),
        "_ingested_at",
    )


def stg_mds_section_i(raw_patients: DataFrame, params: Params) -> DataFrame:
    mds = parse(raw_patients, _MDS).select("patient_id", "mds_assessment.*", "_ingested_at")
    return flatten(mds, "section_i").select(
        "patient_id",
        F.col("item").alias("section_i_icd10"),
        (F.col("pos") + 1).alias("diagnosis_position"),
        F.lit("Section_I").alias("mds_section"),
        "nursing_tier",
        "_ingested_at",
    )


def stg_mds_section_o(raw_patients: DataFrame, params: Params) -> DataFrame:
    mds = parse(raw_patients, _MDS).select("patient_id", "mds_assessment.*", "_ingested_at")
    service = F.col("item")
    return flatten(mds, "section_o").select(
        "patient_id",
        service.alias("section_o_service"),
        (F.col("pos") + 1).alias("service_position"),
        F.lit("Section_O").alias("mds_section"),
        _flag(service.like("%injectable%")).alias("is_injectable"),
        _flag(service.like("%iv%") | service.like("%IV%")).alias("is_iv_service"),
        _flag(service.like("%therapy%")).alias("is_therapy"),
        find_text(service, "O[0-9]{4}").alias("service_code"),
        "_ingested_at",
    )


def stg_vitals(raw_patients: DataFrame, params: Params) -> DataFrame:
    fields = "bp_systolic bp_diastolic heart_rate temperature weight_lbs o2_saturation pain_level recorded_at"
    schema = "patient_id string, " + VITALS.format(",".join(f"{f}:string" for f in fields.split()))
    v = parse(raw_patients, schema).select("patient_id", "vitals.*", "_ingested_at")
    numbers = ("bp_systolic", "bp_diastolic", "heart_rate", "o2_saturation", "pain_level")
    v = v.withColumns(
        {**{n: whole(F.col(n)) for n in numbers}, "temperature_f": _num("temperature"), "weight_lbs": _num("weight_lbs")}
    )
    top, low, pulse, o2 = (F.col(n) for n in ("bp_systolic", "bp_diastolic", "heart_rate", "o2_saturation"))
    return v.select(
        "patient_id", "bp_systolic", "bp_diastolic", "heart_rate", "temperature_f", "weight_lbs", "o2_saturation",
        "pain_level",
        _ts("recorded_at").alias("recorded_at"),
        band(
            [
                ((top >= 180) | (low >= 120), "Hypertensive Crisis"),
                ((top >= 140) | (low >= 90), "Stage 2 HTN"),
                ((top >= 130) | (low >= 80), "Stage 1 HTN"),
                (top >= 120, "Elevated"),
            ],
            "Normal",
        ).alias("bp_classification"),
        band([(pulse < 60, "Bradycardia"), (pulse > 100, "Tachycardia")], "Normal").alias("hr_classification"),
        _flag(F.col("temperature_f") > 100.4).alias("has_fever"),
        band([(o2 < 90, "Critical"), (o2 < 94, "Low")], "Normal").alias("o2_classification"),
        "_ingested_at",
    )


def stg_vital_alerts(raw_patients: DataFrame, params: Params) -> DataFrame:
    fields = "heart_rate systolic_bp diastolic_bp temperature o2_sat position"
    schema = "patient_id string, " + VITALS.format(",".join(f"{f}:string" for f in fields.split()))
    v = parse(raw_patients, schema).filter(F.col("vitals").isNotNull()).select("patient_id", "vitals.*", "_ingested_at")
    pulse, o2 = whole(F.col("heart_rate")), whole(F.col("o2_sat"))
    return v.select(
        "patient_id",
        pulse.alias("heart_rate"),
        whole(F.col("systolic_bp")).alias("systolic_bp"),
        whole(F.col("diastolic_bp")).alias("diastolic_bp"),
        _num("temperature").alias("temperature"),
        o2.alias("o2_saturation"),
        iff(
            pulse > 150, "CRITICAL",
            iff(pulse > 120, "HIGH", iff(pulse > 100, "MODERATE", iff(pulse < 50, "LOW_HR", "NORMAL"))),
        ).alias("hr_alert_level"),
        F.nvl2(F.col("o2_sat"), iff(o2 < 90, "HYPOXIC", "NORMAL"), F.lit("NOT_MEASURED")).alias("o2_status"),
        lookup(
            F.col("position"), {"supine": "Lying Down", "sitting": "Seated", "standing": "Upright"}, "Unknown"
        ).alias("patient_position"),
        "_ingested_at",
    )


def stg_vital_series(raw_patients: DataFrame, params: Params) -> DataFrame:
    schema = "patient_id string, vitals struct<heart_rate:string,systolic_bp:string,temperature:string,o2_sat:string>"
    v = parse(raw_patients, schema).filter(F.col("vitals.heart_rate").isNotNull())
    readings = v.select(
        "patient_id",
        whole(F.col("vitals.heart_rate")).alias("heart_rate"),
        whole(F.col("vitals.systolic_bp")).alias("systolic_bp"),
        _num("vitals.temperature").alias("temperature"),
        whole(F.col("vitals.o2_sat")).alias("o2_sat"),
        F.col("_ingested_at").alias("reading_time"),
    )
    pulse = F.col("heart_rate")
    ties = [asc(c) for c in ("heart_rate", "systolic_bp", "temperature", "o2_sat")]
    seen = ordered_window(
        readings, ["patient_id"], [asc("reading_time"), *ties], prev_heart_rate=lag(pulse), next_heart_rate=lead(pulse)
    )
    change = pulse - F.col("prev_heart_rate")
    return seen.withColumns({"hr_change": change, "hr_trend": iff(F.abs(change) > 20, "RAPID_CHANGE", "STABLE")})


# ---- encounters ---------------------------------------------------------------------------------


def stg_encounters(raw_encounters: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_encounters,
        "encounter_id string, patient_id string, facility_id string, encounter_type string, admit_datetime string,"
        "discharge_datetime string, attending_provider struct<npi:string,name:string,specialty:string>,"
        "charges struct<room_and_board:string,pharmacy:string,supplies:string,professional:string,total:string>,"
        "discharge_disposition string, payer_id string,"
        "authorization struct<auth_number:string,approved_days:string,used_days:string,status:string>,"
        "procedures array<string>, diagnosis_codes array<string>",
    )
    admitted, left = _ts("admit_datetime"), _ts("discharge_datetime")
    approved = whole(F.col("authorization.approved_days"))
    used = whole(F.col("authorization.used_days"))
    until = F.nvl2(F.col("discharge_datetime"), left, params.now())
    return doc.select(
        "encounter_id", "patient_id", "facility_id", "encounter_type",
        admitted.alias("admit_datetime"),
        left.alias("discharge_datetime"),
        F.col("attending_provider.npi").alias("provider_npi"),
        F.col("attending_provider.name").alias("provider_name"),
        F.col("attending_provider.specialty").alias("provider_specialty"),
        _num("charges.room_and_board").alias("charge_room_board"),
        _num("charges.pharmacy").alias("charge_pharmacy"),
        _num("charges.supplies").alias("charge_supplies"),
        _num("charges.professional").alias("charge_professional"),
        _num("charges.total").alias("total_charges"),
        "discharge_disposition", "payer_id",
        F.col("authorization.auth_number"),
        approved.alias("approved_days"),
        used.alias("used_days"),
        F.col("authorization.status").alias("auth_status"),
        boundary_diff("hour", admitted, until).alias("total_hours"),
        (zero_if_null(approved) - zero_if_null(used)).alias("remaining_auth_days"),
        _flag(F.col("authorization.status") == "Denied").alias("is_auth_denied"),
        F.to_date(plus("day", zero_if_null(approved), admitted)).alias("auth_expiry_date"),
        F.array_size("procedures").alias("procedure_count"),
        F.array_size("diagnosis_codes").alias("diagnosis_code_count"),
        "_ingested_at",
    )


def procedure_lines(raw_encounters: DataFrame) -> DataFrame:
    """The procedures of all encounters, without the totals that stand beside them in `stg_procedures`."""
    doc = parse(
        raw_encounters,
        "encounter_id string, patient_id string, charges struct<total:string>, procedures array<struct<code:string,"
        "description:string,units:string,charge:string,performed_by:string,service_date:string>>",
    )
    code = F.col("item.code")
    rows = flatten(doc, "procedures").select(
        "encounter_id", "patient_id",
        code.alias("procedure_code"),
        F.col("item.description").alias("procedure_description"),
        whole(F.col("item.units")).alias("units"),
        _num("item.charge").alias("charge_amount"),
        F.col("item.performed_by"),
        _d("item.service_date").alias("service_date"),
        (F.col("pos") + 1).alias("line_number"),
        find_text(code, "^[0-9]{2}").alias("code_prefix"),
        band(
            [
                (code.rlike("^99[0-9]{3}$"), "E&M"),
                (code.rlike("^97[0-9]{3}$"), "Therapy"),
                (code.rlike("^[0-9]{5}$"), "Procedure"),
            ],
            "Other",
        ).alias("procedure_category"),
        _num("charges.total").alias("encounter_total_charges"),
        "_ingested_at",
    )
    return rows


def stg_procedures(raw_encounters: DataFrame, params: Params) -> DataFrame:
    rows = procedure_lines(raw_encounters)
    # Totals are joined to the narrow rows, not to the documents.
    summed = group_totals(rows, ["encounter_id"], __sum=F.sum("charge_amount"))
    columns = [c for c in rows.columns if c != "_ingested_at"]
    return summed.select(*columns, share(F.col("charge_amount"), F.col("__sum")).alias("charge_pct_of_encounter"), "_ingested_at")


def stg_encounter_diagnoses(raw_encounters: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_encounters,
        "encounter_id string, patient_id string, encounter_type string, admit_datetime string,"
        "diagnosis_codes array<string>",
    )
    return flatten(doc, "diagnosis_codes").select(
        "encounter_id", "patient_id",
        F.col("item").alias("icd10_code"),
        (F.col("pos") + 1).alias("diagnosis_rank"),
        (F.col("pos") == 0).alias("is_primary"),
        "encounter_type",
        _d("admit_datetime").alias("encounter_date"),
        "_ingested_at",
    )


def stg_care_plans(raw_encounters: DataFrame, params: Params) -> DataFrame:
    """Goals with, on each row, all interventions of the patient as one text."""
    doc = parse(
        raw_encounters,
        "patient_id string, encounter_id string, care_plan array<struct<goal:string,intervention:string,"
        "status:string,priority:string,target_date:string>>",
    )
    goals = flatten(doc, "care_plan").filter(F.col("item.goal").isNotNull())
    rows = goals.select(
        "patient_id", "encounter_id",
        F.col("item.goal").alias("care_goal"),
        F.col("item.intervention"),
        F.col("item.status").alias("goal_status"),
        whole(F.col("item.priority")).alias("priority_rank"),
        _d("item.target_date").alias("target_date"),
        (F.col("pos") + 1).alias("goal_sequence"),
        "_ingested_at",
    )
    order = ["priority_rank", "encounter_id", "goal_sequence", "_ingested_at", "intervention"]
    # Listed once per patient, then joined; a patient may have a large part of all goals.
    told = settle(rows)
    lists = ordered_list(told.filter(F.col("intervention").isNotNull()), ["patient_id"], order, F.col("intervention"), "__list")
    listed = join_facts(told, lists, ["patient_id"], own_keys=True)
    text = F.coalesce(F.array_join("__list", "; "), F.lit(""))
    return listed.select(*[c for c in rows.columns if c != "_ingested_at"], text.alias("all_interventions"), "_ingested_at")



def stg_clinical_documents(raw_encounters: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_encounters,
        "patient_id string, encounter_id string, documents array<struct<doc_type:string,title:string,"
        "sections:array<struct<section_name:string,content:string>>>>",
    )
    papers = flatten(doc, "documents").select(
        "patient_id", "encounter_id", F.col("item.doc_type").alias("document_type"), "item.title", "item.sections"
    )
    text = F.col("item.content")
    return (
        flatten(papers, "sections")
        .filter(text.isNotNull())
        .select(
            "patient_id", "encounter_id", "document_type", "title",
            F.col("item.section_name"),
            F.left(text, F.lit(500)).alias("content_preview"),
            F.length(text).alias("content_length"),
            F.contains(text, F.lit("STAT")).alias("is_urgent"),
        )
    )


def stg_discharge_meds(raw_encounters: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_encounters,
        "patient_id string, encounter_id string, discharge_medications array<struct<drug_name:string,dose:string,"
        "frequency:string,route:string>>",
    )
    drug = F.col("item.drug_name")
    return flatten_keep(doc, "discharge_medications").select(
        "patient_id", "encounter_id",
        drug.alias("medication_name"),
        F.col("item.dose"), F.col("item.frequency"), F.col("item.route"),
        _flag(drug.rlike("(?i)statin")).alias("is_statin"),
        _flag(drug.rlike("(?i)pril|sartan")).alias("is_ace_arb"),
        _flag(drug.rlike("(?i)olol|dilol")).alias("is_beta_blocker"),
        _flag(F.lower("item.route").isin("iv", "im", "subq")).alias("is_injectable"),
        (F.col("pos") + 1).alias("medication_seq"),
        F.array_size("discharge_medications").alias("total_discharge_meds"),
        "_ingested_at",
    )


def stg_order_history(raw_encounters: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_encounters,
        "patient_id string, encounter_id string, orders array<struct<order_type:string,description:string,charge:string>>",
    )
    rows = flatten(doc, "orders").select(
        "patient_id", "encounter_id",
        F.col("item.order_type"),
        F.col("item.description").alias("order_description"),
        _num("item.charge").alias("order_charge"),
        (F.col("pos") + 1).alias("order_sequence"),
        "_ingested_at",
    ).filter(F.col("order_charge") > 0)
    # Totals are joined to the narrow rows, not to the documents.
    summed = group_totals(rows, ["encounter_id"], __sum=F.sum("order_charge"))
    return summed.select(
        *[c for c in rows.columns if c != "_ingested_at"],
        share(F.col("order_charge"), F.col("__sum")).alias("charge_pct_of_encounter"),
        F.col("__sum").alias("encounter_total_charges"),
        "_ingested_at",
    )


def stg_referrals(raw_encounters: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_encounters,
        "patient_id string, encounter_id string, referral struct<to_provider:string,from_provider:string,"
        "specialty:string,reason:string,priority:string,referral_date:string,completed_date:string>",
    )
    sent, done = _d("referral.referral_date"), _d("referral.completed_date")
    rows = doc.filter(F.col("referral").isNotNull()).select(
        "patient_id", "encounter_id",
        F.col("referral.to_provider").alias("referred_to"),
        F.col("referral.from_provider").alias("referred_from"),
        F.col("referral.specialty").alias("referral_specialty"),
        F.col("referral.reason").alias("referral_reason"),
        F.col("referral.priority"),
        sent.alias("referral_date"),
        done.alias("completed_date"),
        boundary_diff("day", sent, F.coalesce(done, params.today())).alias("days_to_complete"),
        "_ingested_at",
    )
    order = [desc("referral_date", nulls="last"), asc("encounter_id"), asc("_ingested_at")]
    return ordered_window(rows, ["patient_id"], order, referral_recency_rank=row_number())


# ---- labs ---------------------------------------------------------------------------------------


def stg_lab_results(raw_lab_results: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_lab_results,
        "patient_id string, order_id string, test_panel string, collected_at string, resulted_at string,"
        "ordering_provider string, status string, critical_flag string, results array<struct<analyte:string,"
        "value:string,unit:string,ref_low:string,ref_high:string,flag:string>>",
    )
    value, low, high = _num("item.value"), _num("item.ref_low"), _num("item.ref_high")
    taken, known = _ts("collected_at"), _ts("resulted_at")
    rows = flatten(doc, "results").select(
        "patient_id", "order_id", "test_panel",
        F.col("item.analyte").alias("analyte_name"),
        value.alias("result_value"),
        F.col("item.unit"),
        low.alias("reference_low"),
        high.alias("reference_high"),
        F.coalesce("item.flag", F.lit("NORMAL")).alias("result_flag"),
        band([(value < low, "Below Normal"), (value > high, "Above Normal")], "Normal").alias("interpretation"),
        taken.alias("collected_at"),
        known.alias("resulted_at"),
        boundary_diff("hour", taken, known).alias("turnaround_hours"),
        "ordering_provider",
        F.col("status").alias("result_status"),
        F.col("critical_flag").cast("boolean").alias("is_critical"),
        "_ingested_at",
        "pos",
    )
    seen = ordered_window(
        rows, ["patient_id", "analyte_name"], [asc("collected_at"), asc("order_id"), asc("pos")],
        previous_value=lag(F.col("result_value")),
    )
    change = F.col("result_value") - F.coalesce("previous_value", "result_value")
    return seen.drop("pos").withColumn("value_change", change)


def stg_lab_panels(raw_lab_results: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_lab_results,
        "patient_id string, panel_name string, collected_at string, results array<struct<test_name:string,"
        "result:string,unit:string,reference_low:string,reference_high:string>>",
    )
    value, low, high = _num("item.result"), _num("item.reference_low"), _num("item.reference_high")
    return flatten_keep(doc, "results").select(
        "patient_id", "panel_name",
        F.col("item.test_name"),
        value.alias("result_value"),
        F.col("item.unit"),
        low.alias("ref_low"),
        high.alias("ref_high"),
        iff(value < low, "LOW", iff(value > high, "HIGH", "NORMAL")).alias("result_flag"),
        (value - low).alias("deviation_from_low"),
        (value - high).alias("deviation_from_high"),
        (F.col("pos") + 1).alias("test_sequence"),
        F.array_size("results").alias("tests_in_panel"),
        _ts("collected_at").alias("collected_at"),
        "_ingested_at",
    )


# ---- claims -------------------------------------------------------------------------------------


def stg_claims(raw_claims: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_claims,
        "claim_id string, patient_id string, encounter_id string, payer string, claim_type string, status string,"
        "service_date string, submit_date string, remit_date string, total_charges string, total_paid string,"
        "total_denied string, line_items array<string>, denial_reasons array<string>",
    )
    charged, paid = _num("total_charges"), _num("total_paid")
    denied = zero_if_null(_num("total_denied"))
    served, sent, remitted = _d("service_date"), _d("submit_date"), _d("remit_date")
    return doc.select(
        "claim_id", "patient_id", "encounter_id",
        F.col("payer").alias("payer_name"),
        "claim_type",
        F.col("status").alias("claim_status"),
        served.alias("service_date"),
        sent.alias("submit_date"),
        remitted.alias("remit_date"),
        charged.alias("total_charges"),
        paid.alias("total_paid"),
        denied.alias("total_denied"),
        (charged - paid - denied).alias("outstanding_amount"),
        div0null(paid, charged).alias("payment_ratio"),
        boundary_diff("day", served, sent).alias("days_to_submit"),
        boundary_diff("day", sent, remitted).alias("days_to_payment"),
        F.array_size("line_items").alias("line_item_count"),
        F.array_size("denial_reasons").alias("denial_reason_count"),
        _flag(F.col("status") == "Denied").alias("is_denied"),
        _flag(F.col("status").isin("Paid", "Partially Paid")).alias("is_paid"),
        "_ingested_at",
    )


def stg_claim_lines(raw_claims: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_claims,
        "claim_id string, patient_id string, payer string, total_charges string, line_items array<struct<"
        "line_no:string,cpt:string,units:string,charge:string,paid:string,adjustment:string,denial_code:string>>",
    )
    rows = flatten(doc, "line_items").select(
        "claim_id", "patient_id",
        F.col("payer").alias("payer_name"),
        whole(F.col("item.line_no")).alias("line_number"),
        F.col("item.cpt").alias("cpt_code"),
        whole(F.col("item.units")).alias("units"),
        _num("item.charge").alias("line_charge"),
        _num("item.paid").alias("line_paid"),
        _num("item.adjustment").alias("line_adjustment"),
        F.col("item.denial_code"),
        F.col("item.denial_code").isNotNull().alias("is_line_denied"),
        div0null(_num("item.charge"), _num("total_charges")).alias("pct_of_total"),
        "_ingested_at",
        "pos",
    )
    order = [asc("line_number"), asc("_ingested_at"), asc("pos")]
    return ordered_window(
        rows, ["claim_id"], order, running_charge_total=running("sum", F.col("line_charge"))
    ).drop("pos")


def stg_denial_reasons(raw_claims: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_claims,
        "claim_id string, patient_id string, payer string, total_denied string, total_charges string,"
        "denial_reasons array<string>",
    )
    reason, denied, charged = F.col("item"), _num("total_denied"), _num("total_charges")
    return flatten(doc, "denial_reasons").select(
        "claim_id", "patient_id",
        F.col("payer").alias("payer_name"),
        reason.alias("denial_reason_raw"),
        squash(reason, "a-zA-Z0-9 ").alias("denial_reason_clean"),
        F.upper(F.trim(reason)).alias("denial_reason_normalized"),
        (F.col("pos") + 1).alias("denial_sequence"),
        denied.alias("denied_amount"),
        charged.alias("total_charges"),
        div0null(denied, charged).alias("denial_rate"),
        "_ingested_at",
    )


# ---- facility operations: record kinds are told apart by the fields they carry ----------------------


def stg_facility_events(raw_facility_ops: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_facility_ops,
        "event_id string, facility_id string, event_type string, timestamp string,"
        "location struct<wing:string,floor:string,room:string,bed:string>, patient_id string, staff_id string,"
        "severity string, sensor_data struct<value:string,unit:string,threshold:string,is_breach:string>,"
        "resolved string, resolution_time_minutes string, tags array<string>",
    )
    minutes = whole(F.col("resolution_time_minutes"))
    bucket = F.width_bucket(zero_if_null(minutes).cast("double"), F.lit(0.0), F.lit(120.0), F.lit(6)).cast("int")
    bands = {i: f"{20 * i - 20}-{20 * i}min" for i in range(1, 7)}
    place = "location"
    return doc.select(
        "event_id", "facility_id", "event_type",
        _ts("timestamp").alias("event_timestamp"),
        F.col(f"{place}.wing"),
        whole(F.col(f"{place}.floor")).alias("floor_number"),
        whole(F.col(f"{place}.room")).alias("room_number"),
        F.col(f"{place}.bed").alias("bed_id"),
        F.concat(
            F.col(f"{place}.wing"), F.lit("-"), F.col(f"{place}.floor"), F.lit("-"), F.col(f"{place}.room"),
            F.col(f"{place}.bed"),
        ).alias("full_location"),
        "patient_id", "staff_id", "severity",
        _num("sensor_data.value").alias("sensor_value"),
        F.col("sensor_data.unit").alias("sensor_unit"),
        _num("sensor_data.threshold").alias("sensor_threshold"),
        F.col("sensor_data.is_breach").cast("boolean").alias("is_threshold_breach"),
        F.col("resolved").cast("boolean").alias("is_resolved"),
        minutes.alias("resolution_minutes"),
        bucket.alias("response_time_bucket"),
        lookup(bucket, bands, "120min+").alias("response_time_band"),
        F.array_size("tags").alias("tag_count"),
        "_ingested_at",
    )


def stg_facility_tags(raw_facility_ops: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_facility_ops,
        "event_id string, facility_id string, event_type string, severity string, timestamp string, tags array<string>",
    )
    tag = F.col("item")
    return flatten(doc, "tags").select(
        "event_id", "facility_id", "event_type",
        tag.alias("tag"),
        (F.col("pos") + 1).alias("tag_position"),
        "severity",
        _flag(tag == "urgent").alias("is_urgent"),
        _flag(tag == "escalated").alias("is_escalated"),
        _ts("timestamp").alias("event_timestamp"),
        "_ingested_at",
    )


def stg_facility_budgets(raw_facility_ops: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_facility_ops,
        "facility_id string, department string, budget struct<allocated:string,spent:string,remaining:string>",
    )
    money = doc.filter(F.col("budget").isNotNull()).select(
        "facility_id", "department",
        *[_num(f"budget.{b}").alias(f"budget_{b}") for b in ("allocated", "spent", "remaining")],
        "_ingested_at",
    )
    used = F.col("utilization_rate")
    return money.withColumn("utilization_rate", div0null(F.col("budget_spent"), F.col("budget_allocated"))).select(
        "facility_id", "department", "budget_allocated", "budget_spent", "budget_remaining", "utilization_rate",
        div0null(F.col("budget_remaining"), F.col("budget_allocated")).alias("remaining_pct"),
        F.width_bucket(used, F.lit(0.0), F.lit(1.5), F.lit(5)).cast("int").alias("utilization_bucket"),
        band([(used > 1.0, "OVER_BUDGET"), (used > 0.9, "AT_RISK"), (used > 0.7, "ON_TRACK")], "UNDER_UTILIZED").alias(
            "budget_status"
        ),
        "_ingested_at",
    )


def stg_quality_measures(raw_facility_ops: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_facility_ops,
        "facility_id string, measure_id string, measure_name string, score string, benchmark string",
    )
    rows = doc.filter(F.col("measure_id").isNotNull()).select(
        "facility_id", "measure_id", "measure_name", _num("score").alias("score"), _num("benchmark").alias("benchmark"),
        "_ingested_at",
    )
    got, goal = F.col("score"), F.col("benchmark")
    return rows.select(
        "facility_id", "measure_id", "measure_name", "score", "benchmark",
        (got - goal).alias("variance_from_benchmark"),
        div0null(got, goal).alias("score_to_benchmark_ratio"),
        F.width_bucket(got, F.lit(0.0), F.lit(100.0), F.lit(5)).cast("int").alias("quality_tier"),
        band(
            [(got >= goal * 1.1, "EXCEEDS"), (got >= goal, "MEETS"), (got >= goal * 0.8, "BELOW")], "CRITICAL"
        ).alias("performance_status"),
        "_ingested_at",
    )


def stg_staff_schedules(raw_facility_ops: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_facility_ops,
        "facility_id string, staff_id string, shift struct<start_time:string,end_time:string,role:string,"
        "department:string>",
    )
    rows = doc.filter(F.col("shift").isNotNull()).select(
        "facility_id", "staff_id",
        F.col("shift.start_time").cast("timestamp_ntz").alias("shift_start"),
        F.col("shift.end_time").cast("timestamp_ntz").alias("shift_end"),
        F.col("shift.role").alias("shift_role"),
        F.col("shift.department"),
        "_ingested_at",
    )
    hours, weekday = boundary_diff("hour", F.col("shift_start"), F.col("shift_end")), day_of_week(F.col("shift_start"))
    return rows.select(
        "facility_id", "staff_id", "shift_start", "shift_end",
        hours.alias("shift_hours"),
        "shift_role", "department",
        plus("hour", 12, F.col("shift_start")).alias("next_eligible_start"),
        iff(hours > 12, "EXTENDED", "STANDARD").alias("shift_type"),
        weekday.alias("day_of_week"),
        _flag(weekday.isin(0, 6)).alias("is_weekend"),
        "_ingested_at",
    )


def stg_provider_schedules(raw_facility_ops: DataFrame, params: Params) -> DataFrame:
    kinds = parse(
        raw_facility_ops,
        "record_type string, provider_id string, name string, specialty string, schedule string, is_active string",
    ).filter(F.col("record_type") == "provider_schedule")
    week = F.from_json("schedule", "monday string, tuesday string, wednesday string")
    rows = kinds.withColumn("week", week)
    rows = rows.withColumn("monday", F.from_json("week.monday", "start_time string, end_time string"))
    start, end = F.col("monday.start_time"), F.col("monday.end_time")
    return rows.select(
        "provider_id",
        F.col("name").alias("provider_name"),
        "specialty",
        F.to_json("week").alias("weekly_schedule"),
        F.array_size(object_keys(F.col("schedule"))).alias("scheduled_days_count"),
        start.alias("monday_start"),
        end.alias("monday_end"),
        boundary_diff("hour", clock_time(start), clock_time(end)).alias("monday_hours"),
        iff(F.col("is_active").cast("boolean"), "Active", "Inactive").alias("status"),
        "_ingested_at",
    )
