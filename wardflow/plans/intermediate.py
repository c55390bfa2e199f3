"""Intermediate models: relations built from staging models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions import (
    band,
    boundary_diff,
    div0null,
    floor_hour,
    iff,
    iqr_fences,
    lookup,
    safe_divide,
    score,
    share,
    zero_if_null,
)
from wardflow.operators.aggregates import grouped, grouping_sets, histogram, joined_set, ordered_list, sorted_set
from wardflow.operators.features import rate_card, rule_points, unify_alerts, watchlist_overlap
from wardflow.operators.ordered import (
    Sizes,
    asc,
    desc,
    first_of,
    group_sizes,
    group_totals,
    join_facts,
    lag,
    last_before,
    moving,
    ntile,
    ordered_window,
    peer_ranks,
    row_number,
    running,
    sizes_within,
    total,
)
from wardflow.operators.pairs import cooccurrence_pairs, pair_rule_counts
from wardflow.operators.relational import fan_in, latest_by, share_of_total, top_k_per_group, union_all
from wardflow.operators.timeseries import (
    adherence,
    count_within,
    densify_forecast,
    detect_gaps,
    return_intervals,
    rolling_daily,
    sla,
    trend_states,
)
from wardflow.params import Params
from wardflow.plans.staging import procedure_lines
from wardflow.session import settle

# Watch lists and daily rates the models are defined by.
BLOOD_THINNERS = ["Warfarin", "Aspirin", "Heparin", "Enoxaparin"]
DIABETES_MEDS = ["Metformin", "Insulin", "Glipizide"]
CARDIAC_MEDS = ["Lisinopril", "Losartan", "Amlodipine", "Metoprolol"]
RATE_CARDS = {
    "nursing": ("nursing_tier", {"ES3": "225.50", "ES2": "198.30", "HDE2": "175.80", "HDE1": "155.20"}, "135.00"),
    "nta": ("nta_tier", {"A": "890.00", "B": "650.00", "C": "450.00"}, "280.00"),
    "pt": ("pt_tier", {"RU": "175.00", "RV": "145.00"}, "95.00"),
    "ot": ("ot_tier", {"RU": "165.00", "RV": "135.00"}, "90.00"),
    "slp": ("slp_tier", {"SA": "55.00", "SB": "45.00"}, "35.00"),
}
SLA_MINUTES = {"Critical": 30, "High": 120, "Medium": 480}


def int_acuity_scoring(stg_patients: DataFrame, params: Params) -> DataFrame:
    points = score(
        [
            rule_points(F.col("age"), [(85, 4), (75, 3), (65, 2)], 1),
            rule_points(F.col("diagnosis_count"), [(5, 4), (3, 3), (1, 2)], 1),
            rule_points(F.col("medication_count"), [(8, 4), (5, 3), (2, 2)], 1),
            rule_points(F.col("length_of_stay"), [(30, 4), (14, 3), (7, 2)], 1),
        ]
    )
    scored = stg_patients.select(
        "patient_id", F.col("full_name").alias("patient_name"), "age", "diagnosis_count", "medication_count",
        "length_of_stay", points.alias("acuity_score"), "_ingested_at",
    )
    order = [desc("acuity_score"), asc("patient_id"), asc("_ingested_at")]
    sizes = group_sizes(scored, [])
    tiled = ordered_window(scored, [], order, sizes, acuity_quintile=ntile(5))
    ranked = peer_ranks(tiled, [], [desc("acuity_score")], sizes, acuity_percentile="percent_rank")
    labels = {1: "CRITICAL", 2: "HIGH", 3: "MODERATE", 4: "LOW"}
    named = ranked.withColumn("acuity_category", lookup(F.col("acuity_quintile"), labels, "MINIMAL"))
    return latest_by(named, ["patient_id"], [desc("acuity_score"), asc("_ingested_at")]).drop("_ingested_at")


def int_census_forecast(stg_patients: DataFrame, params: Params) -> DataFrame:
    daily = stg_patients.groupBy("facility_id", "admit_date").agg(F.count(F.lit(1)).alias("patient_count"))
    return densify_forecast(daily, "facility_id", "admit_date", "patient_count", params.today())


def int_claims_revenue(stg_claims: DataFrame, params: Params) -> DataFrame:
    base = stg_claims.select(
        "claim_id", "patient_id", "encounter_id", "payer_name", "claim_type", "claim_status", "total_charges",
        "total_paid", "total_denied", "outstanding_amount", "payment_ratio", "days_to_submit", "days_to_payment",
        "is_denied", "service_date",
    ).filter(F.col("payer_name").isNotNull())
    base = settle(base)
    sizes = group_sizes(base, ["payer_name"])
    totals = group_totals(
        base, ["payer_name"], sizes,
        payer_claim_volume=F.count(F.lit(1)),
        payer_avg_ratio=F.avg("payment_ratio"),
        payer_denied_count=F.count_if("is_denied"),
        __charges=F.sum("total_charges"),
        payer_avg_charge=F.avg("total_charges"),
        payer_stddev_charge=F.stddev_samp("total_charges"),
    )
    ranked = peer_ranks(totals, ["payer_name"], [desc("total_charges")], sizes, charge_rank_in_payer="rank")
    summed = ordered_window(
        ranked, ["payer_name"], [asc("service_date"), asc("claim_id")], sizes,
        running_paid_by_payer=running("sum", F.col("total_paid")),
    )
    limit = F.col("payer_avg_charge") + F.coalesce("payer_stddev_charge", F.lit(0.0)) * 2
    ratio = F.col("payment_ratio")
    return summed.select(
        *base.columns, "payer_claim_volume", "payer_avg_ratio", "payer_denied_count",
        share(F.col("total_charges"), F.col("__charges")).alias("pct_of_payer_charges"),
        "charge_rank_in_payer", "running_paid_by_payer", "payer_avg_charge", "payer_stddev_charge",
        iff(F.col("total_charges") > limit, True, False).alias("is_charge_outlier"),
        band(
            [
                (F.col("is_denied"), "Denied"),
                (ratio >= 0.9, "Fully Paid"),
                (ratio >= 0.5, "Partially Paid"),
                (ratio > 0, "Underpaid"),
            ],
            "Unpaid",
        ).alias("payment_category"),
    )


def clinical_alert_feeds(
    stg_vitals: DataFrame, stg_lab_results: DataFrame, stg_facility_events: DataFrame
) -> list[DataFrame]:
    """The three feeds in one shape."""
    pressure = F.concat(F.col("bp_systolic").cast("string"), F.lit("/"), F.col("bp_diastolic").cast("string"))
    levels = {"Hypertensive Crisis": ("Critical: BP ", 1), "Stage 2 HTN": ("High: BP ", 2)}
    bp = F.col("bp_classification")
    vital = stg_vitals.filter(bp.isin(*levels)).select(
        "patient_id",
        F.lit("VITAL_ALERT").alias("alert_type"),
        F.concat(lookup(bp, {k: v[0] for k, v in levels.items()}), pressure).alias("alert_message"),
        lookup(bp, {k: v[1] for k, v in levels.items()}, 3).alias("priority"),
        F.col("_ingested_at").alias("alert_timestamp"),
    )
    flag = F.col("result_flag")
    lab = stg_lab_results.filter(F.col("is_critical") | flag.isin("LOW", "HIGH")).select(
        "patient_id",
        F.lit("LAB_ALERT").alias("alert_type"),
        F.concat(
            F.lit("Abnormal "), F.col("analyte_name"), F.lit(": "), F.col("result_value").cast("string"), F.lit(" "),
            F.col("unit"), F.lit(" ("), flag, F.lit(")"),
        ).alias("alert_message"),
        lookup(flag, {"LOW": 2, "HIGH": 2}, 3).alias("priority"),
        F.col("collected_at").alias("alert_timestamp"),
    )
    severity = F.col("severity")
    event = stg_facility_events.filter(severity.isin("Critical", "High") & F.col("patient_id").isNotNull()).select(
        "patient_id",
        F.lit("FACILITY_EVENT").alias("alert_type"),
        F.concat(F.col("event_type"), F.lit(" at "), F.col("full_location")).alias("alert_message"),
        lookup(severity, {"Critical": 1, "High": 2}, 3).alias("priority"),
        F.col("event_timestamp").alias("alert_timestamp"),
    )
    # Vital rows without a message (fever or low oxygen alone) are dropped by the model, so the
    # first filter keeps only the two pressure classes that have one.
    return [vital.filter(F.col("alert_message").isNotNull()), lab, event]


def int_clinical_alerts(
    stg_vitals: DataFrame, stg_lab_results: DataFrame, stg_facility_events: DataFrame, params: Params
) -> DataFrame:
    alerts = settle(union_all(*clinical_alert_feeds(stg_vitals, stg_lab_results, stg_facility_events)))
    ties = ["alert_type", "alert_message"]
    ranked = unify_alerts(alerts, "patient_id", "priority", "alert_timestamp", "alert_message", ties)
    return ranked.select(*alerts.columns, "alert_rank", "total_patient_alerts", "most_critical_alert")


def int_cost_allocation(stg_claims: DataFrame, params: Params) -> DataFrame:
    kind, payer = "claim_type", "payer_name"
    levels = grouping_sets(
        stg_claims, [kind, payer], [[kind, payer], [kind], [payer], []],
        {
            "claim_count": ("count", None),
            "total_charges": ("sum", F.col("total_charges")),
            "total_paid": ("sum", F.col("total_paid")),
            "avg_charge_per_claim": ("avg", F.col("total_charges")),
        },
    )
    # The denominators cover the subtotal rows too, as the model is defined.
    shares = share_of_total(levels, pct_of_total_charges="total_charges", pct_of_total_paid="total_paid")
    return shares.select(
        F.coalesce(kind, F.lit("ALL")).alias(kind),
        F.coalesce(payer, F.lit("ALL")).alias(payer),
        "claim_count", "total_charges", "total_paid",
        (F.col("total_charges") - F.col("total_paid")).alias("total_outstanding"),
        "pct_of_total_charges", "pct_of_total_paid", "avg_charge_per_claim",
        F.col("is_total_claim_type").alias("is_type_total"),
        F.col("is_total_payer_name").alias("is_payer_total"),
    )


def int_diagnosis_pairs(stg_diagnoses: DataFrame, params: Params) -> DataFrame:
    pairs = cooccurrence_pairs(stg_diagnoses, "patient_id", "icd10_code", "diagnosis_description", 2)
    return pairs.select(
        F.col("item_1").alias("dx_1"), F.col("item_2").alias("dx_2"),
        F.col("label_1").alias("desc_1"), F.col("label_2").alias("desc_2"),
        "pair_hash",
        F.col("support").alias("patient_count"),
        F.col("prevalence").alias("prevalence_pct"),
        F.col("entities").alias("patient_ids"),
    )


def int_discharge_planning(stg_encounters: DataFrame, params: Params) -> DataFrame:
    stay = boundary_diff("day", F.col("admit_datetime"), F.coalesce(F.col("discharge_datetime"), params.now()))
    base = stg_encounters.select(
        "patient_id", "encounter_id", "encounter_type", "admit_datetime", "discharge_datetime",
        stay.alias("length_of_stay_days"), "discharge_disposition",
    )
    base = settle(base)
    sizes = group_sizes(base, ["encounter_type"])
    everything = Sizes(sizes.rows, 1, sizes.rows)
    typed = group_totals(base, ["encounter_type"], sizes, type_avg_los=F.avg("length_of_stay_days"))
    tiled = ordered_window(typed, [], [desc("length_of_stay_days"), asc("encounter_id")], everything, los_quartile=ntile(4))
    visits = ordered_window(
        tiled, ["patient_id"], [asc("admit_datetime"), asc("encounter_id")],
        __prev=lag(F.col("discharge_datetime")),
        total_encounters_for_patient=total("count", F.lit(1)),
    )
    days, mean = F.col("length_of_stay_days"), F.col("type_avg_los")
    return visits.select(
        *base.columns, "type_avg_los",
        (days - mean).alias("days_over_avg"),
        iff(days > mean * 1.5, "OVERDUE", "ON_TRACK").alias("discharge_status"),
        "los_quartile",
        boundary_diff("day", F.col("__prev"), F.col("admit_datetime")).alias("days_since_last_discharge"),
        "total_encounters_for_patient",
    )


def int_drug_interactions(stg_medications: DataFrame, params: Params) -> DataFrame:
    meds = "current_medications"
    found = watchlist_overlap(
        stg_medications, "patient_id", {meds: "medication_name"},
        {
            "blood_thinners": (meds, BLOOD_THINNERS),
            "diabetes_meds": (meds, DIABETES_MEDS),
            "cardiac_meds": (meds, CARDIAC_MEDS),
        },
    )
    thinners = F.col("blood_thinners")
    both = F.array_contains(thinners, "Warfarin") & F.array_contains(thinners, "Aspirin")
    return found.select(
        "patient_id", meds, "blood_thinners", "diabetes_meds", "cardiac_meds",
        F.array_size(thinners).alias("blood_thinner_count"),
        F.array_size("diabetes_meds").alias("diabetes_med_count"),
        (F.array_size(thinners) > 1).alias("dual_anticoag_risk"),
        iff(both, "HIGH", "LOW").alias("bleeding_risk"),
        F.array_size(meds).alias("total_med_count"),
        iff(F.array_size(meds) >= 5, "Polypharmacy", "Standard").alias("polypharmacy_flag"),
    )


def int_encounter_summary(
    stg_encounters: DataFrame, raw_encounters: DataFrame, stg_claims: DataFrame, params: Params
) -> DataFrame:
    # Procedures without their share of the encounter, which nothing here reads.
    procedures = procedure_lines(raw_encounters).groupBy("encounter_id").agg(
        F.count(F.lit(1)).alias("p_count"),
        F.sum("charge_amount").alias("p_charges"),
        joined_set("procedure_category", ", ").alias("procedure_categories"),
    )
    claims = stg_claims.groupBy("encounter_id").agg(
        F.count(F.lit(1)).alias("c_count"),
        F.sum("total_paid").alias("c_paid"),
        F.count_if("is_denied").alias("c_denied"),
    )
    enc = stg_encounters.withColumnRenamed("total_charges", "encounter_charges").drop("procedure_count")
    joined = fan_in(enc, [procedures, claims], "encounter_id")
    reauth = (F.col("remaining_auth_days") < 3) & F.col("discharge_datetime").isNull()
    return joined.select(
        "encounter_id", "patient_id", "facility_id", "encounter_type", "admit_datetime", "discharge_datetime",
        "total_hours", "provider_name", "provider_specialty", "discharge_disposition", "encounter_charges",
        zero_if_null(F.col("p_count")).alias("procedure_count"),
        F.coalesce("p_charges", F.lit(0.0)).alias("total_procedure_charges"),
        "procedure_categories",
        zero_if_null(F.col("c_count")).alias("claim_count"),
        F.coalesce("c_paid", F.lit(0.0)).alias("total_reimbursed"),
        zero_if_null(F.col("c_denied")).alias("denied_claims"),
        safe_divide(F.col("c_paid"), F.col("encounter_charges")).alias("reimbursement_rate"),
        "auth_status", "remaining_auth_days",
        iff(reauth, True, False).alias("needs_reauth"),
    )


def int_event_response_analysis(stg_facility_events: DataFrame, params: Params) -> DataFrame:
    at, key = "event_timestamp", "event_id"
    events = stg_facility_events.select(
        key, "facility_id", "event_type", at, "severity", "is_resolved", "resolution_minutes", "wing", "floor_number",
        "room_number", "patient_id", "staff_id",
    )
    # Counted, sampled for ranges and dealt out: documents are parsed once for that.
    events = settle(events)
    order = [asc(at), asc(key)]
    sizes = sizes_within(events, ["facility_id"])
    floor = ordered_window(
        events, ["facility_id", "wing", "floor_number"], order, sizes,
        __prev=lag(F.col(at)), first_responder=first_of(F.col("staff_id")),
    )
    wing = ordered_window(
        floor, ["facility_id", "wing"], order, sizes,
        last_resolved_event_id=last_before(F.when(F.col("is_resolved"), F.col(key))),
    )
    hour = count_within(wing, ["facility_id"], at, 3600, ~F.col("is_resolved"), "unresolved_last_hour", sizes)
    typed = ordered_window(
        hour, ["facility_id", "event_type"], order, sizes,
        avg_response_last_5=moving("avg", F.col("resolution_minutes"), 5),
    )
    measured = typed.select(
        *events.columns,
        boundary_diff("minute", F.col("__prev"), F.col(at)).alias("minutes_since_last_event"),
        "first_responder", "last_resolved_event_id", "unresolved_last_hour", "avg_response_last_5",
        floor_hour(F.col(at)).alias("__hour"),
    )
    newest = [desc(at), asc(key)]
    return top_k_per_group(measured, ["facility_id", "event_type", "__hour"], newest, 10).drop("__hour")


def int_event_response_sla(stg_facility_events: DataFrame, params: Params) -> DataFrame:
    target = lookup(F.col("severity"), SLA_MINUTES, 1440)
    rated = sla(
        stg_facility_events, ["facility_id", "severity"], "event_timestamp", "event_id", "resolution_minutes", target
    )
    return rated.select(
        "facility_id", "event_id", "event_type", "severity", "event_timestamp", "resolution_minutes",
        "sla_target_minutes", "sla_met", "rolling_10_avg_resolution", "is_resolved",
    )


def int_facility_census(stg_patients: DataFrame, params: Params) -> DataFrame:
    stay = "length_of_stay"
    daily = grouped(
        stg_patients, ["facility_id", "admit_date"],
        {
            "total_patients": F.count(F.lit(1)),
            "active_count": F.count_if("is_current_resident"),
            "discharged_count": F.count_if(~F.col("is_current_resident")),
            "avg_los": F.avg(stay),
            "max_los": F.max(stay),
            "very_elderly_count": F.count_if(F.col("age") > 85),
            "complex_patient_count": F.count_if(F.col("diagnosis_count") > 3),
            "avg_bp_systolic": F.avg("bp_systolic"),
            "avg_o2_sat": F.avg("o2_saturation"),
        },
        {"median_los": (stay, 0.5), "p75_los": (stay, 0.75), "p90_los": (stay, 0.9)},
    )
    n = F.col("total_patients")
    seen = ordered_window(settle(daily), ["facility_id"], [asc("admit_date")], prev_day_total=lag(n))
    return seen.select(
        "facility_id", "admit_date", "total_patients", "active_count", "discharged_count",
        F.round("median_los", 1).alias("median_los"),
        F.round("avg_los", 1).alias("avg_los"),
        "max_los",
        F.round("p75_los", 1).alias("p75_los"),
        F.round("p90_los", 1).alias("p90_los"),
        "very_elderly_count", "complex_patient_count",
        F.round("avg_bp_systolic", 0).alias("avg_bp_systolic"),
        F.round("avg_o2_sat", 0).alias("avg_o2_sat"),
        div0null(F.col("active_count"), n).alias("active_rate"),
        div0null(F.col("complex_patient_count"), n).alias("complexity_ratio"),
        "prev_day_total",
        (n - F.coalesce("prev_day_total", "total_patients")).alias("daily_change"),
    )


def int_lab_trends(stg_lab_results: DataFrame, params: Params) -> DataFrame:
    labs = stg_lab_results.select(
        "patient_id", "analyte_name", "result_value", "reference_low", "reference_high", "result_flag", "collected_at",
        "order_id",
    )
    keys = ["patient_id", "analyte_name"]
    return trend_states(
        labs, keys, "collected_at", "order_id", "result_value", "reference_low", "reference_high"
    ).drop("order_id")


def int_los_distribution(stg_patients: DataFrame, params: Params) -> DataFrame:
    days = F.col("length_of_stay")
    category = band(
        [
            (days <= params.los_short_stay, "Short Stay (0-7d)"),
            (days <= 20, "Standard (8-20d)"),
            (days <= params.los_long_stay, "Long Stay (21-60d)"),
        ],
        "Extended (60d+)",
    )
    stays = stg_patients.filter(days > 0).withColumn("los_category", category)
    bars = histogram(
        stays, ["facility_id", "los_category"], "length_of_stay", 0, 105, 15, "los_bucket",
        patient_count=F.count(F.lit(1)),
        avg_los_in_bucket=F.avg("length_of_stay"),
        min_los=F.min("length_of_stay"),
        max_los=F.max("length_of_stay"),
        avg_age_in_bucket=F.avg("age"),
        avg_dx_count=F.avg("diagnosis_count"),
        still_active=F.count_if("is_current_resident"),
    )
    sums = group_totals(settle(bars), ["facility_id"], __all=F.sum("patient_count"))
    return sums.withColumn("pct_of_facility", share(F.col("patient_count"), F.col("__all"))).drop("__all")


def int_medication_adherence(stg_medications: DataFrame, params: Params) -> DataFrame:
    fills = stg_medications.select("patient_id", "medication_name", "start_date", "medication_sequence")
    rated = adherence(fills, "patient_id", "medication_name", "start_date", "medication_sequence")
    return rated.select(
        "patient_id", "medication_name", "start_date", "fill_number", "prev_fill_date", "days_between_fills", "is_gap",
        "is_lapse", "total_fills", "adherence_status",
    )


def int_medication_interactions(stg_medications: DataFrame, params: Params) -> DataFrame:
    name, route = F.col("medication_name"), F.col("route")
    # Pairs are in name order, so the first rule, whose left name sorts after its right one, never fits.
    rules = [
        (name == "Enoxaparin", name == "Aspirin", "HIGH"),
        (name.like("%statin"), name.like("%fibrate"), "HIGH"),
        (route == "IV", route == "IV", "MODERATE"),
    ]
    pairs = pair_rule_counts(stg_medications, "patient_id", "medication_name", rules, ["HIGH"])
    summary = stg_medications.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("total_medications"),
        F.count_if("is_injectable").alias("injectable_count"),
        joined_set("medication_name", ", ").alias("all_medications"),
        sorted_set("route").alias("routes_array"),
        F.max(iff(F.col("risk_category") == "High Risk", 1, 0)).alias("has_high_risk_med"),
    )
    return summary.join(pairs, "patient_id", "left").select(
        *summary.columns,
        zero_if_null(F.col("pair_count")).alias("interaction_pair_count"),
        zero_if_null(F.col("HIGH")).alias("high_risk_interactions"),
        (F.col("total_medications") >= 5).alias("is_polypharmacy"),
    )


def int_patient_360(
    stg_patients: DataFrame,
    stg_primary_diagnosis: DataFrame,
    stg_mds_assessments: DataFrame,
    stg_insurance: DataFrame,
    stg_vitals: DataFrame,
    params: Params,
    one_row_per_side: bool = True,
) -> DataFrame:
    """Patients with diagnosis, assessment, insurance and vitals.

    Each joined side is first cut to the newest row of a patient, so the grain stays that of
    `stg_patients`. With `one_row_per_side=False` sides with several rows multiply the output.
    """
    def side(df: DataFrame, *columns: str) -> DataFrame:
        newest = [desc("_ingested_at"), *[asc(c) for c in columns]]
        rows = latest_by(df, ["patient_id"], newest) if one_row_per_side else df
        return rows.select("patient_id", *columns)

    dx = side(stg_primary_diagnosis, "primary_icd10", "primary_diagnosis_desc", "severity").withColumnRenamed(
        "severity", "primary_dx_severity"
    )
    mds = side(
        stg_mds_assessments, "nursing_tier", "nta_tier", "pt_tier", "ot_tier", "nursing_score", "nta_score"
    )
    policies = stg_insurance.filter("is_primary").select(
        "patient_id", F.col("payer_name").alias("primary_payer"), F.col("plan_id").alias("primary_plan_id"),
        "months_enrolled", "insurance_rank", "_ingested_at",
    )
    plan = side(policies, "insurance_rank", "primary_payer", "primary_plan_id", "months_enrolled")
    vitals = side(stg_vitals, "bp_classification", "hr_classification", "o2_classification", "has_fever")
    sides = [dx, mds, plan, vitals]
    if one_row_per_side:
        joined = fan_in(stg_patients, sides, "patient_id")
    else:
        joined = stg_patients
        for other in sides:
            joined = joined.join(other, "patient_id", "left")
    acute = (F.col("age") > 85) & (F.col("diagnosis_count") > 3) & (F.col("nursing_score") >= 4)
    alert = F.col("bp_classification").isin("Stage 2 HTN", "Hypertensive Crisis") | (
        F.col("o2_classification") == "Critical"
    )
    return joined.select(
        "patient_id", "full_name", "age", "gender", "race", "facility_id", "admit_date", "discharge_date",
        "is_current_resident", "length_of_stay", "diagnosis_count", "medication_count",
        "primary_icd10", "primary_diagnosis_desc", "primary_dx_severity",
        "nursing_tier", "nta_tier", "pt_tier", "ot_tier", "nursing_score", "nta_score",
        (F.col("nursing_score") + F.col("nta_score")).alias("combined_acuity_score"),
        "primary_payer", "primary_plan_id", "months_enrolled",
        "bp_classification", "hr_classification", "o2_classification", "has_fever",
        iff(acute, True, False).alias("is_high_acuity"),
        iff(F.col("length_of_stay") > params.los_long_stay, True, False).alias("is_long_stay"),
        iff(alert, True, False).alias("has_vital_alert"),
    )


def int_patient_journey(stg_patients: DataFrame, stg_encounters: DataFrame, params: Params) -> DataFrame:
    people = stg_patients.select("patient_id", F.col("full_name").alias("patient_name"))
    seen = stg_encounters.filter(F.col("patient_id").isNotNull())
    # One patient may have a large part of all encounters.
    visits = join_facts(seen, people, ["patient_id"], how="inner").select(
        "patient_id", "patient_name", "encounter_id", "encounter_type", "admit_datetime", "discharge_datetime"
    )
    numbered = ordered_window(
        visits, ["patient_id"], [asc("admit_datetime"), asc("encounter_id"), asc("patient_name")],
        visit_number=row_number(),
        prev_discharge=lag(F.col("discharge_datetime")),
        total_visits=total("count", F.lit(1)),
        first_visit_type=first_of(F.col("encounter_type")),
    )
    until = F.coalesce(F.col("discharge_datetime"), params.now())
    return numbered.select(
        *visits.columns,
        boundary_diff("day", F.col("admit_datetime"), until).alias("length_of_stay_days"),
        "visit_number", "prev_discharge",
        boundary_diff("day", F.col("prev_discharge"), F.col("admit_datetime")).alias("days_between_visits"),
        "total_visits", "first_visit_type",
    )


def int_patient_risk_score(stg_patients: DataFrame, params: Params) -> DataFrame:
    age, dx, meds = F.col("age"), F.col("diagnosis_count"), F.col("medication_count")
    low_o2 = band([(F.col("o2_saturation") < 90, 3), (F.col("o2_saturation") < 94, 2)], 0)
    raw = score(
        [
            rule_points(age, [(85, 3), (75, 2)], 1),
            rule_points(dx, [(4, 3), (2, 2)], 1),
            rule_points(meds, [(5, 3), (3, 2)], 1),
            rule_points(F.col("bp_systolic"), [(160, 3), (140, 2)], 0),
            low_o2,
            rule_points(F.col("pain_level"), [(7, 2), (4, 1)], 0),
        ]
    )
    base = stg_patients.select(
        "patient_id", "age", "diagnosis_count", "medication_count", "length_of_stay", raw.alias("raw_risk_score"),
        (rule_points(age, [(85, 3), (75, 2)], 1) + dx + meds).alias("__load"),
        (rule_points(age, [(85, 3)], 1) + dx + meds).alias("__rank_load"),
        "_ingested_at",
    )
    ties = [asc("patient_id"), asc("_ingested_at")]
    sizes = group_sizes(base, [])
    tiled = ordered_window(base, [], [asc("__load"), *ties], sizes, risk_quartile=ntile(4))
    ranked = ordered_window(tiled, [], [desc("__rank_load"), *ties], sizes, risk_rank=row_number())
    spread = peer_ranks(ranked, [], [asc("length_of_stay")], sizes, los_percentile="percent_rank")
    spread = peer_ranks(spread, [], [asc("diagnosis_count")], sizes, dx_cumulative_dist="cume_dist")
    return spread.select(
        "patient_id", "age", "diagnosis_count", "medication_count", "length_of_stay", "raw_risk_score",
        "risk_quartile", "los_percentile", "dx_cumulative_dist", "risk_rank",
        lookup(F.col("risk_quartile"), {4: "Critical", 3: "High", 2: "Moderate"}, "Low").alias("risk_category"),
    )


def int_payer_performance(stg_claims: DataFrame, params: Params) -> DataFrame:
    charge = "total_charges"
    metrics = grouped(
        stg_claims, ["payer_name", "claim_type"],
        {
            "total_claims": F.count(F.lit(1)),
            "sum_charges": F.sum(charge),
            "sum_paid": F.sum("total_paid"),
            "sum_denied": F.sum("total_denied"),
            "sum_outstanding": F.sum("outstanding_amount"),
            "avg_payment_ratio": F.avg("payment_ratio"),
            "denied_count": F.count_if("is_denied"),
            "paid_count": F.count_if("is_paid"),
            "charge_stddev": F.stddev_samp(charge),
            "charge_variance": F.var_samp(charge),
        },
        {
            "median_days_to_submit": ("days_to_submit", 0.5),
            "median_days_to_pay": ("days_to_payment", 0.5),
            **{f"p{p}_charge": (charge, p / 100) for p in (25, 50, 75, 95)},
        },
    )
    spread, low, high = iqr_fences(F.col("p25_charge"), F.col("p75_charge"))
    rated = settle(metrics).withColumns(
        {
            "denial_rate": div0null(F.col("denied_count"), F.col("total_claims")),
            "iqr": spread,
            "outlier_low_threshold": low,
            "outlier_high_threshold": high,
        }
    )
    sizes = group_sizes(rated, [])
    ranked = peer_ranks(rated, [], [desc("sum_charges")], sizes, charge_rank="rank")
    ranked = peer_ranks(ranked, [], [asc("denial_rate")], sizes, denial_rank="rank")
    rate = F.col("denial_rate")
    return ranked.withColumn(
        "payer_grade", band([(rate > 0.20, "Poor"), (rate > 0.10, "Below Average"), (rate > 0.05, "Average")], "Excellent")
    )


def int_pdpm_revenue(stg_mds_assessments: DataFrame, params: Params) -> DataFrame:
    tiers = ["nursing_tier", "nta_tier", "pt_tier", "ot_tier", "slp_tier"]
    return rate_card(stg_mds_assessments.select("patient_id", *tiers), RATE_CARDS, 30)


def int_provider_panels(stg_encounters: DataFrame, params: Params) -> DataFrame:
    stay = boundary_diff("day", F.col("admit_datetime"), F.coalesce(F.col("discharge_datetime"), params.now()))
    seen = stg_encounters.filter(F.col("provider_npi").isNotNull()).withColumnRenamed("provider_npi", "provider_id")
    panels = seen.groupBy("provider_id").agg(
        F.count_distinct("patient_id").alias("panel_size"),
        F.count(F.lit(1)).alias("total_encounters"),
        F.avg(stay).alias("avg_los"),
        F.count_if(F.col("encounter_type") == "Emergency").alias("emergency_visits"),
        F.lit(0).alias("readmissions"),
        F.lit(0.0).alias("readmission_rate"),
        F.min("admit_datetime").alias("first_encounter"),
        F.max("admit_datetime").alias("last_encounter"),
    ).filter(F.col("panel_size") >= 1)
    people = seen.filter(F.col("patient_id").isNotNull()).select("provider_id", "patient_id").distinct()
    lists = ordered_list(people, ["provider_id"], ["patient_id"], F.col("patient_id"), "patient_list")
    return panels.join(lists, "provider_id").select(
        "provider_id", "panel_size", "patient_list", "total_encounters", "avg_los", "emergency_visits", "readmissions",
        "readmission_rate", "first_encounter", "last_encounter",
    )


def int_readmission_risk(stg_encounters: DataFrame, params: Params) -> DataFrame:
    stays = stg_encounters.filter(F.col("encounter_type").isin("Inpatient", "Rehab", "Observation")).select(
        "patient_id", "encounter_id", "encounter_type", "admit_datetime", "discharge_datetime",
        "discharge_disposition", "total_hours",
    )
    carried = {"prev_encounter_id": "encounter_id", "prev_disposition": "discharge_disposition"}
    return return_intervals(stays, "patient_id", "admit_datetime", "discharge_datetime", "encounter_id", carried)


def int_sliding_window(stg_facility_events: DataFrame, params: Params) -> DataFrame:
    return rolling_daily(
        stg_facility_events, "facility_id", "event_timestamp", F.col("severity") == "Critical", "resolution_minutes"
    )


def int_time_series_gaps(stg_vitals: DataFrame, params: Params) -> DataFrame:
    return detect_gaps(stg_vitals, "patient_id", "_ingested_at", "heart_rate", params.now())
