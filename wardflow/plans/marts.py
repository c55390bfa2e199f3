"""Marts: dimensions, facts and the insurance history.

Incremental facts take an optional `table`. Without it the full result is returned; with it only
source rows past the table's mark are worked on and upserted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions import (
    boundary_diff,
    day_of_week,
    div0null,
    fiscal_quarter,
    floor_day,
    floor_hour,
    floor_month,
    floor_week,
    md5_key,
    safe_divide,
    share,
    surrogate_key,
    text_of,
    zero_if_null,
)
from wardflow.operators.aggregates import grouping_sets, pivot_sum, unpivot
from wardflow.operators.incremental import (
    current_dimension,
    merge_aggregate,
    scd2_from_log,
    scd2_snapshot,
)
from wardflow.operators.ordered import asc, desc, group_totals, join_facts
from wardflow.operators.relational import latest_by
from wardflow.params import Params
from wardflow.session import settle
from wardflow.sources.landing import parse
from wardflow.sources.tables import HistoryTable, KeyedTable


def _stay(params: Params):
    return boundary_diff("day", F.col("admit_datetime"), F.coalesce(F.col("discharge_datetime"), params.now()))


def dim_facility(facility_reference: DataFrame, stg_patients: DataFrame, params: Params) -> DataFrame:
    census = stg_patients.groupBy("facility_id").agg(
        F.count_distinct("patient_id").alias("served"),
        F.count_if("is_current_resident").alias("active"),
        F.avg("length_of_stay").alias("los"),
        F.avg("age").alias("mean_age"),
    )
    return facility_reference.join(census, "facility_id", "left").select(
        *facility_reference.columns,
        zero_if_null(F.col("served")).alias("total_patients_served"),
        zero_if_null(F.col("active")).alias("current_census"),
        safe_divide(F.col("active"), F.col("bed_count")).alias("occupancy_rate"),
        F.round(F.coalesce("los", F.lit(0.0)), 1).alias("avg_length_of_stay"),
        F.round(F.coalesce("mean_age", F.lit(0.0)), 0).alias("avg_patient_age"),
    )


def dim_patients(stg_patients: DataFrame, params: Params) -> DataFrame:
    columns = [
        "patient_id", "full_name", "age", "gender", "race", "preferred_language", "city", "state", "zip_code",
        "facility_id", "is_current_resident", "diagnosis_count", "medication_count", "ssn_hash", "_ingested_at",
    ]
    tracked = ["patient_id", "full_name", "facility_id", "city", "state"]
    return current_dimension(
        stg_patients.select(*columns), "patient_id", tracked, "_ingested_at", params.scd_valid_to
    )


def dim_providers(raw_facility_ops: DataFrame, params: Params) -> DataFrame:
    doc = parse(
        raw_facility_ops,
        "provider_id string, name string, specialty string, department string, facility_id string, hire_date string,"
        "is_active string",
    )
    log = doc.filter(F.col("provider_id").isNotNull()).select(
        "provider_id",
        F.col("name").alias("provider_name"),
        "specialty", "department", "facility_id",
        F.col("hire_date").cast("date").alias("hire_date"),
        F.col("is_active").cast("boolean").alias("is_active"),
        "_ingested_at",
    )
    versions = scd2_from_log(log, "provider_id", "_ingested_at", ["provider_name", "department", "facility_id"])
    return versions.select(
        md5_key(F.col("provider_id"), text_of(F.col("_ingested_at"))).alias("provider_key"),
        *[c for c in log.columns if c != "_ingested_at"],
        "valid_from", "valid_to", "is_current",
        boundary_diff("year", F.col("hire_date"), params.today()).alias("years_of_service"),
    )


def fct_clinical_events(int_clinical_alerts: DataFrame, params: Params, table: KeyedTable | None = None) -> DataFrame:
    def build(alerts: DataFrame) -> DataFrame:
        at = F.col("alert_timestamp")
        return alerts.select(
            surrogate_key(F.col("alert_type"), F.col("patient_id"), text_of(at)).alias("event_key"),
            "patient_id",
            F.col("alert_type").alias("event_type"),
            F.col("alert_message").alias("event_description"),
            F.col("priority").alias("severity_level"),
            at.alias("event_datetime"),
            floor_day(at).alias("event_date"),
            floor_hour(at).alias("event_hour"),
            F.hour(at).alias("hour_of_day"),
            day_of_week(at).alias("day_of_week"),
            "alert_rank", "total_patient_alerts", "most_critical_alert",
            params.now().alias("_last_updated"),
        )

    if table is None:
        return build(int_clinical_alerts)
    # A new alert moves the ranks and totals of all alerts of its patient: patients are replaced as a whole.
    return merge_aggregate(table, int_clinical_alerts, "alert_timestamp", ["patient_id"], build, params.late_days)


def fct_daily_census(stg_patients: DataFrame, params: Params, table: KeyedTable | None = None) -> DataFrame:
    def build(patients: DataFrame) -> DataFrame:
        daily = patients.groupBy("facility_id", F.col("admit_date").alias("census_date")).agg(
            F.count(F.lit(1)).alias("patient_count"),
            F.count_if("is_current_resident").alias("active_patients"),
            F.avg("length_of_stay").alias("los"),
            F.avg("age").alias("years"),
            F.avg("diagnosis_count").alias("dx"),
            F.count_if(F.col("age") > 85).alias("elderly_85_plus"),
            F.count_if(F.col("length_of_stay") > params.los_long_stay).alias("long_stay_count"),
        )
        return daily.select(
            surrogate_key(F.col("facility_id"), F.col("census_date")).alias("census_key"),
            "facility_id", "census_date", "patient_count", "active_patients",
            F.round("los", 1).alias("avg_length_of_stay"),
            F.round("years", 0).alias("avg_patient_age"),
            F.round("dx", 1).alias("avg_diagnosis_count"),
            "elderly_85_plus", "long_stay_count",
            safe_divide(F.col("active_patients"), F.col("patient_count")).alias("occupancy_rate"),
            params.now().alias("_last_updated"),
        )

    if table is None:
        return build(stg_patients)
    return merge_aggregate(table, stg_patients, "_ingested_at", ["facility_id", "admit_date"], build, params.late_days)


def fct_payer_summary(stg_claims: DataFrame, params: Params) -> DataFrame:
    payer, kind = columns = ["payer_name", "claim_type"]
    levels = grouping_sets(
        stg_claims, columns, [columns, [payer], []],
        {
            "total_claims": ("count", None),
            "sum_charges": ("sum", F.col("total_charges")),
            "sum_paid": ("sum", F.col("total_paid")),
            "sum_denied": ("sum", F.col("total_denied")),
            "avg_payment_ratio": ("avg", F.col("payment_ratio")),
            "denied_count": ("count_if", F.col("is_denied")),
        },
        {"median_days_to_pay": ("days_to_payment", 0.5), "p90_charge": ("total_charges", 0.9)},
    )
    return levels.select(
        F.coalesce(payer, F.lit("ALL PAYERS")).alias(payer),
        F.coalesce(kind, F.lit("ALL TYPES")).alias(kind),
        "total_claims", "sum_charges", "sum_paid", "sum_denied", "avg_payment_ratio", "denied_count",
        safe_divide(F.col("denied_count"), F.col("total_claims")).alias("denial_rate"),
        "median_days_to_pay", "p90_charge",
        F.col("is_total_payer_name").alias("is_payer_total"),
        F.col("is_total_claim_type").alias("is_type_total"),
    )


def fct_provider_performance(stg_encounters: DataFrame, params: Params) -> DataFrame:
    monthly = stg_encounters.groupBy(
        "facility_id", "encounter_type", floor_month(F.col("admit_datetime")).cast("timestamp_ntz").alias("month")
    ).agg(
        F.count(F.lit(1)).cast("double").alias("encounter_count"),
        F.avg(_stay(params)).alias("avg_los"),
    )
    long = unpivot(
        monthly, ["facility_id", "encounter_type", "month"], ["encounter_count", "avg_los"], "metric_name",
        "metric_value",
    )
    sums = group_totals(settle(long), ["facility_id", "metric_name"], facility_total=F.sum("metric_value"))
    return sums.withColumn("pct_of_facility", share(F.col("metric_value"), F.col("facility_total")))


def fct_quality_dashboard(stg_encounters: DataFrame, params: Params, table: KeyedTable | None = None) -> DataFrame:
    weekly = stg_encounters.withColumn("week_start", floor_week(F.col("_ingested_at")))

    def build(encounters: DataFrame) -> DataFrame:
        per_week = encounters.groupBy("facility_id", "week_start").agg(
            F.count_distinct("patient_id").alias("patients_seen"),
            F.avg(_stay(params)).alias("los"),
            F.lit(0).alias("readmissions"),
            F.count(F.lit(1)).alias("total_encounters"),
        )
        return per_week.select(
            md5_key(F.col("facility_id"), text_of(F.col("week_start"))).alias("quality_key"),
            "facility_id", "week_start", "patients_seen",
            F.round("los", 1).alias("avg_length_of_stay"),
            "readmissions", "total_encounters",
            div0null(F.col("readmissions"), F.col("total_encounters")).alias("readmission_rate"),
            params.now().alias("_last_updated"),
        )

    if table is None:
        return build(weekly)
    return merge_aggregate(table, weekly, "_ingested_at", ["facility_id", "week_start"], build, params.late_days)


def fct_revenue(
    stg_claims: DataFrame, stg_patients: DataFrame, params: Params, table: KeyedTable | None = None
) -> DataFrame:
    """Claims with their patient as last known; earlier copies of a patient would count a claim twice."""
    newest = latest_by(stg_patients, ["patient_id"], [desc("_ingested_at"), asc("facility_id")])
    people = newest.filter(F.col("patient_id").isNotNull()).select(
        "patient_id", "facility_id", F.col("age").alias("patient_age"), F.col("gender").alias("patient_gender")
    )

    kept = [
        "claim_id", "patient_id", "encounter_id", "payer_name", "claim_type", "claim_status", "service_date",
        "total_charges", "total_paid", "total_denied", "outstanding_amount", "payment_ratio", "days_to_submit",
        "days_to_payment", "is_denied", "line_item_count", "facility_id", "patient_age", "patient_gender",
    ]

    def known(claims: DataFrame) -> DataFrame:
        # One patient may have a large part of all claims.
        key = surrogate_key(F.col("claim_id"), F.col("patient_id")).alias("revenue_key")
        return join_facts(claims, people, ["patient_id"]).select(key, *kept)

    def dated(rows: DataFrame) -> DataFrame:
        served = F.col("service_date")
        return rows.select(
            "revenue_key", *kept,
            fiscal_quarter(served, params.fiscal_start_month).alias("fiscal_quarter"),
            floor_month(served).alias("service_month"),
            params.now().alias("_last_updated"),
        )

    if table is None:
        return dated(known(stg_claims))
    order = [desc("service_date"), asc("facility_id"), asc("total_charges")]

    def one_per_key(claims: DataFrame) -> DataFrame:
        # Rows are dealt out by key before columns are added that follow from others.
        return dated(latest_by(known(claims), table.keys, order))

    return merge_aggregate(table, stg_claims, "_ingested_at", ["claim_id", "patient_id"], one_per_key, params.late_days)


def fct_staffing_metrics(stg_facility_events: DataFrame, params: Params) -> DataFrame:
    daily = stg_facility_events.withColumn("event_date", floor_day(F.col("event_timestamp")))
    names = {s: f"{s.lower()}_events" for s in ("Critical", "High", "Medium", "Low")}
    return pivot_sum(daily, ["facility_id", "event_date"], "severity", names, F.lit(1))


#: Columns whose change makes a new version of a patient's insurance.
INSURANCE_CHECK = ["payer_name", "plan_id", "coverage_type"]


def snp_patient_insurance(
    stg_insurance: DataFrame, params: Params, history: DataFrame | None = None, table: HistoryTable | None = None
) -> DataFrame:
    """History of each patient's primary insurance; the newest primary row counts as the current one.

    With a `table` the history is kept there, and the run takes its state at `params.now()`.
    """
    primary = stg_insurance.filter("is_primary")
    newest = latest_by(primary, ["patient_id"], [desc("_ingested_at"), asc("insurance_rank")])
    current = newest.select(
        "patient_id", "payer_name", "plan_id", "group_id", "coverage_type", "effective_date", "is_primary",
        "months_enrolled", F.col("_ingested_at").alias("updated_at"),
    )
    if table is not None:
        table.snapshot(current, params.now())
        return table.read()
    return scd2_snapshot(history, current, "patient_id", INSURANCE_CHECK, params.now())
