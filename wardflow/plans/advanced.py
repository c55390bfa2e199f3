"""Advanced models: pivots, arrays, documents, flags, hashes and text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions import band, floor_day, floor_month, iff, mask_pii, md5_key, since, zero_if_null
from wardflow.operators.aggregates import (
    grouping_sets,
    joined_set,
    ordered_list,
    pivot_sum,
    sorted_set,
    unpivot,
)
from wardflow.operators.features import buckets, count_flags, encode_flags, has_flag, hash_dedup, note_features
from wardflow.operators.ordered import asc, desc, group_sizes, group_totals, moving, ntile, ordered_window, peer_ranks
from wardflow.operators.relational import top_k_per_group
from wardflow.operators.semi import build_document, completeness, flatten_product, is_array
from wardflow.params import Params
from wardflow.session import settle
from wardflow.sources.generators import calendar, recursive_series
from wardflow.sources.landing import parse

# Vocabularies and patterns the models are defined by.
EVENT_TYPES = [
    "bed_sensor", "nurse_call", "fall_alert", "med_dispense", "door_access", "temp_alarm", "elopement_risk",
    "equipment_check",
]
NOTE_TERMS = "(Metformin|Lisinopril|Enoxaparin|Furosemide|Lasix|Aspirin|Zosyn|Azithromycin)"
NOTE_VALUES = {
    "bp_from_notes": r"BP\s*([0-9]+/[0-9]+)",
    "bnp_value": r"BNP.*?([0-9]+)",
    "gfr_value": r"GFR.*?([0-9]+)",
}
NOTE_CLASSES = [
    ("(admitted|admission)", "Admission Note"),
    ("(exacerbation|acute)", "Acute Event"),
    ("(routine|rehab)", "Routine/Rehab"),
    ("(progress|declining)", "Progress Note"),
]
NOTE_SHORT = "(s/p|PMH|HTN|DM2|CHF|CKD|O2|NC|PT/OT/SLP)"


def adv_approx_functions(stg_patients: DataFrame, params: Params) -> DataFrame:
    stay = "length_of_stay"
    # One sketch gives all four percentiles.
    monthly = (
        stg_patients.filter(F.col("facility_id").isNotNull())
        .groupBy("facility_id", floor_month(F.col("admit_date")).alias("month"))
        .agg(
            F.count_distinct("patient_id").alias("exact_patient_count"),
            F.approx_count_distinct("patient_id").alias("approx_patient_count"),
            F.approx_percentile(stay, [0.25, 0.5, 0.75, 0.95]).alias("q"),
            F.avg(stay).alias("avg_los"),
            F.min(stay).alias("min_los"),
            F.max(stay).alias("max_los"),
            F.stddev_samp(stay).alias("stddev_los"),
            F.count(F.lit(1)).alias("total_admissions"),
        )
        .filter(F.col("total_admissions") >= 3)
    )
    q = F.col("q")
    return monthly.select(
        "facility_id", "month", "exact_patient_count", "approx_patient_count",
        q[1].alias("median_los"), q[0].alias("p25_los"), q[2].alias("p75_los"), q[3].alias("p95_los"),
        (q[2] - q[0]).alias("iqr_los"),
        "avg_los", "min_los", "max_los", "stddev_los", "total_admissions",
    )


def adv_array_operations(stg_diagnoses: DataFrame, stg_medications: DataFrame, params: Params) -> DataFrame:
    dx = stg_diagnoses.groupBy("patient_id").agg(
        sorted_set("icd10_code").alias("all_dx_codes"),
        sorted_set("diagnosis_description").alias("all_dx_descriptions"),
        sorted_set("severity").alias("severity_levels"),
    )
    meds = stg_medications.groupBy("patient_id").agg(
        sorted_set("medication_name").alias("all_medications"), sorted_set("route").alias("all_routes")
    )
    acute = F.array_intersect("severity_levels", F.array(F.lit("Acute"), F.lit("Critical")))
    return dx.join(meds, "patient_id", "left").select(
        *dx.columns, "all_medications", "all_routes",
        F.array_size("all_dx_codes").alias("unique_dx_count"),
        F.array_size("all_medications").alias("unique_med_count"),
        F.array_contains("all_dx_codes", "I10").alias("has_hypertension"),
        F.array_contains("all_dx_codes", "E11.65").alias("has_diabetes"),
        F.array_contains("all_routes", "IV").alias("has_iv_meds"),
        F.array_size(acute).alias("acute_severity_count"),
        F.array_join("all_dx_codes", " | ").alias("dx_codes_pipe_delimited"),
        F.array_join("all_medications", ", ").alias("medications_csv"),
    )


def adv_bitwise_flags(stg_patients: DataFrame, params: Params) -> DataFrame:
    rules = [
        F.col("diagnosis_count") > 3,
        F.col("medication_count") > 5,
        F.col("age") > 85,
        F.col("length_of_stay") > 30,
    ]
    flags = F.col("risk_flags")
    names = ["is_complex", "has_polypharmacy", "is_elderly", "is_long_stay"]
    return stg_patients.withColumn("risk_flags", encode_flags(rules)).select(
        "patient_id", "risk_flags",
        *[has_flag(flags, bit).alias(name) for bit, name in enumerate(names)],
        count_flags(flags).alias("active_risk_flags"),
        band([(flags >= 12, "CRITICAL"), (flags >= 6, "HIGH"), (flags >= 2, "MODERATE")], "LOW").alias("risk_tier"),
        "diagnosis_count", "medication_count", "age", "length_of_stay",
    )


def adv_conditional_agg(stg_claims: DataFrame, params: Params) -> DataFrame:
    kind, payer, status = columns = ["claim_type", "payer_name", "claim_status"]
    charge = F.col("total_charges")
    levels = grouping_sets(
        stg_claims, columns, [columns, [kind, payer], [kind], [payer], []],
        {
            "claim_count": ("count", None),
            "total_charges": ("sum", charge),
            "total_paid": ("sum", F.col("total_paid")),
            "avg_charge": ("avg", charge),
            "high_value_claims": ("count_if", charge > 10000),
        },
    ).filter(F.col("claim_count") > 0)
    labels = {kind: "ALL_TYPES", payer: "ALL_PAYERS", status: "ALL_STATUSES"}
    return levels.select(
        *[F.coalesce(c, F.lit(label)).alias(c) for c, label in labels.items()],
        "claim_count", "total_charges", "total_paid", "avg_charge", "high_value_claims",
        F.col("is_total_claim_type").alias("is_type_rollup"),
        F.col("is_total_payer_name").alias("is_payer_rollup"),
        F.col("is_total_claim_status").alias("is_status_rollup"),
        F.col("level").alias("grouping_level"),
    )


def adv_date_spine(spark: SparkSession, params: Params) -> DataFrame:
    return calendar(spark, "2024-01-01", 730, params.fiscal_start_month)


def adv_dynamic_pivot(stg_patients: DataFrame, params: Params) -> DataFrame:
    """Admissions land in the column of the month's rank; ranks past 3 leave all three columns NULL."""
    monthly = (
        stg_patients.filter(since(F.col("admit_date"), params.now(), 6, "month"))
        .groupBy("facility_id", floor_month(F.col("admit_date")).alias("month"))
        .agg(F.count(F.lit(1)).alias("admissions"), F.avg("length_of_stay").alias("avg_los"))
    )
    monthly = settle(monthly)
    sizes = group_sizes(monthly, ["facility_id"])
    ranked = peer_ranks(monthly, ["facility_id"], [desc("admissions")], sizes, busiest_month_rank="rank")
    ranked = peer_ranks(ranked, ["facility_id"], [desc("avg_los")], sizes, highest_los_rank="rank")
    names = {i: f"rank_{i}_admissions" for i in (1, 2, 3)}
    keys = ["facility_id", "month", "avg_los", "highest_los_rank"]
    return pivot_sum(ranked, keys, "busiest_month_rank", names, F.col("admissions"))


def adv_hash_clustering(stg_patients: DataFrame, params: Params) -> DataFrame:
    who, name, day = F.col("patient_id"), F.col("full_name"), F.col("admit_date").cast("string")
    kept = hash_dedup(stg_patients, md5_key(who, name, day), [desc("_ingested_at"), asc("_source_file")])
    cut = buckets(kept, {"partition_bucket": ("patient_id", 10), "facility_shard": ("facility_id", 4)})
    return cut.select(
        "patient_id", "full_name",
        md5_key(who, name).alias("dedup_hash"),
        mask_pii(F.concat(who, F.lit("|"), day)).alias("record_hash"),
        "partition_bucket", "facility_shard", "age", "facility_id", "admit_date",
        F.lit(False).alias("is_duplicate"),
        "_ingested_at",
    )


def adv_json_reconstruction(
    stg_patients: DataFrame, stg_diagnoses: DataFrame, stg_medications: DataFrame, params: Params
) -> DataFrame:
    """One bundle per patient, with all diagnoses and medications and their counts."""
    people = stg_patients.select(
        "patient_id", "full_name", "age", "gender", "facility_id", "diagnosis_count", "medication_count"
    )

    def listed(df: DataFrame, order: list[str], fields: dict[str, str], name: str) -> DataFrame:
        item = F.struct(*[F.col(c).alias(n) for n, c in fields.items()])
        return ordered_list(df, ["patient_id"], order, item, name)

    dx_fields = {"code": "icd10_code", "description": "diagnosis_description", "is_primary": "is_primary", "severity": "severity"}
    med_fields = {
        "name": "medication_name", "dose": "dose", "route": "route", "frequency": "frequency",
        "is_injectable": "is_injectable",
    }
    dx = listed(stg_diagnoses, ["diagnosis_sequence", "icd10_code"], dx_fields, "dx")
    meds = listed(stg_medications, ["medication_sequence", "_ingested_at"], med_fields, "meds")
    lists = dx.join(meds, "patient_id", "full_outer")
    joined = people.join(lists, "patient_id", "left")
    dx_list, med_list = F.coalesce("dx", F.array()), F.coalesce("meds", F.array())
    bundle = build_document(
        patient_id=F.col("patient_id"),
        demographics=F.struct(
            F.col("full_name").alias("name"), "age", "gender", F.col("facility_id").alias("facility")
        ),
        clinical=F.struct(
            "diagnosis_count", "medication_count", dx_list.alias("diagnoses"), med_list.alias("medications")
        ),
        metadata=F.struct(
            params.now().cast("string").alias("generated_at"), F.lit("2.0").alias("version")
        ),
    )
    return joined.select(
        "patient_id",
        bundle.alias("patient_fhir_bundle"),
        F.array_size(dx_list).alias("actual_dx_count"),
        F.array_size(med_list).alias("actual_med_count"),
    )


def adv_json_schema_validation(raw_patients: DataFrame, params: Params) -> DataFrame:
    fields = ["patient_id", "name", "dob", "gender", "diagnoses", "medications", "vitals", "insurance"]
    doc = parse(raw_patients, ", ".join(f"{f} string" for f in [*fields, "discharge_date"]))
    present, pct = completeness(fields)
    dx = F.col("diagnoses")
    filled = is_array(dx) & (F.json_array_length(dx) > 0)
    return doc.select(
        "patient_id",
        F.col("vitals").isNotNull().alias("vitals_is_present"),
        dx.isNotNull().alias("diagnoses_is_present"),
        F.col("discharge_date").isNull().alias("discharge_is_null"),
        present.alias("fields_present"),
        F.lit(8).alias("fields_expected"),
        pct.alias("completeness_pct"),
        iff(filled, "HAS_DX", "NO_DX").alias("dx_status"),
        "_ingested_at",
    )


def adv_multi_flatten(raw_patients: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_patients,
        "patient_id string, diagnoses array<struct<icd10:string,description:string,is_primary:string>>,"
        "medications array<struct<drug_name:string,dose:string>>, insurance array<struct<payer:string,plan_type:string>>",
    )
    primary = F.col("diagnoses.is_primary").cast("boolean")
    rows = flatten_product(doc, "diagnoses", ["medications", "insurance"], primary, limit=5).select(
        "patient_id",
        F.col("diagnoses.icd10").alias("diagnosis_code"),
        F.col("diagnoses.description").alias("diagnosis_desc"),
        F.col("medications.drug_name").alias("medication_name"),
        F.col("medications.dose"),
        F.col("insurance.payer").alias("insurance_payer"),
        F.col("insurance.plan_type"),
        (F.col("diagnoses_pos") + 1).alias("dx_seq"),
        (F.col("medications_pos") + 1).alias("med_seq"),
        (F.col("insurance_pos") + 1).alias("ins_seq"),
        F.concat(
            F.col("diagnoses.icd10"), F.lit("|"), F.col("medications.drug_name"), F.lit("|"), F.col("insurance.payer")
        ).alias("combination_key"),
        "_ingested_at",
    )
    order = [asc("med_seq"), asc("ins_seq"), desc("_ingested_at"), asc("dx_seq")]
    return top_k_per_group(rows, ["patient_id", "diagnosis_code"], order, 5)


def adv_object_agg(stg_diagnoses: DataFrame, params: Params) -> DataFrame:
    grouped = stg_diagnoses.groupBy("patient_id").agg(
        sorted_set("icd10_code").alias("dx_codes_sorted"),
        F.max("onset_date").alias("latest_dx_date"),
        joined_set("severity", ", ").alias("severity_list"),
    )
    codes = F.col("dx_codes_sorted")
    return grouped.filter(F.array_size(codes) >= 1).select(
        "patient_id", "dx_codes_sorted",
        F.array_size(codes).cast("bigint").alias("unique_dx_count"),
        "latest_dx_date", "severity_list",
        F.array_join(codes, "|").alias("all_codes_pipe"),
    )


def adv_pivot_census(stg_facility_events: DataFrame, params: Params) -> DataFrame:
    daily = stg_facility_events.withColumn("event_date", floor_day(F.col("event_timestamp")))
    wide = pivot_sum(daily, ["facility_id", "event_date"], "event_type", {t: t for t in EVENT_TYPES}, F.lit(1))
    counts = wide.select("facility_id", "event_date", *[zero_if_null(F.col(t)).alias(f"{t}_events") for t in EVENT_TYPES])
    names = [f"{t}_events" for t in EVENT_TYPES]
    return counts.select(
        "*",
        sum((F.col(n) for n in names), F.lit(0)).alias("total_events"),
        (F.col("fall_alert_events") + F.col("elopement_risk_events")).alias("safety_events"),
        (F.col("nurse_call_events") + F.col("bed_sensor_events")).alias("care_events"),
    )


def adv_recursive_cte(stg_facility_events: DataFrame, params: Params) -> DataFrame:
    days = recursive_series(stg_facility_events.sparkSession, params.today(), -1, params.lookback_days)
    # Counting per day first leaves one row per day and facility for the join with the series.
    daily = stg_facility_events.groupBy("facility_id", F.to_date("event_timestamp").alias("day_date")).agg(
        F.count("event_id").alias("event_count"),
        F.count_if(F.col("severity") == "Critical").alias("critical_count"),
        F.count_if(~F.col("is_resolved")).alias("unresolved_count"),
    )
    joined = days.join(daily, "day_date", "left").filter(F.col("facility_id").isNotNull())
    rolled = ordered_window(
        settle(joined), ["facility_id"], [asc("day_date")], rolling_7d_avg=moving("avg", F.col("event_count"), 6)
    )
    return rolled.select(
        "day_date", F.col("day_num").alias("days_ago"), "facility_id", "event_count", "critical_count",
        "unresolved_count", "rolling_7d_avg",
    )


def adv_regexp_extraction(stg_patients: DataFrame, params: Params) -> DataFrame:
    found = note_features(F.col("clinical_notes"), NOTE_TERMS, NOTE_VALUES, NOTE_CLASSES, NOTE_SHORT)
    notes = stg_patients.filter(F.col("clinical_notes").isNotNull())
    return notes.select("patient_id", "clinical_notes", *[c.alias(n) for n, c in found.items()])


def adv_unpivot_metrics(stg_patients: DataFrame, params: Params) -> DataFrame:
    names = ["age", "diagnosis_count", "medication_count", "length_of_stay"]
    base = stg_patients.select("patient_id", *[F.col(n).cast("bigint").alias(n) for n in names], "_ingested_at")
    return metric_profile(base, "patient_id", names, ["_ingested_at"])


def metric_profile(df: DataFrame, key: str, metrics: list[str], ties: list[str]) -> DataFrame:
    """Metrics in long form with percentile, decile, mean and deviation within each metric."""
    long = unpivot(df, [key, *ties], metrics, "metric_name", "metric_value")
    order = [asc("metric_value"), asc(key), *[asc(t) for t in ties]]
    sizes = group_sizes(long, ["metric_name"])
    tiled = ordered_window(long, ["metric_name"], order, sizes, decile=ntile(10))
    ranked = peer_ranks(tiled, ["metric_name"], [asc("metric_value")], sizes, percentile_rank="percent_rank")
    means = group_totals(ranked, ["metric_name"], sizes, population_avg=F.avg("metric_value"))
    return means.select(
        key, "metric_name", "metric_value", "percentile_rank", "decile", "population_avg",
        (F.col("metric_value") - F.col("population_avg")).alias("deviation_from_avg"),
    )
