"""Gold facts: one row per hospital, and one row per patient, policy and age."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.functions import features
from carelake.functions.dates import age_in_365_days, parse_day
from carelake.operators.summaries import (
    copies,
    ratio,
    rows,
    steady_round,
    times,
    visits,
    whole,
)
from carelake.tables import CareTables


def hospital_facts(t: CareTables) -> DataFrame:
    """Admissions, stays, mortality, beds and diseases per hospital.

    Means the aggregate of admissions x patient rows x history rows x hospital
    rows: theatres and ventilators therefore count once per admission.
    """
    stays = visits(
        t.new_admissions,
        admissions=rows(),
        ids=F.count("admission_id"),
        icu=F.sum(features.icu_admission()),
        deaths=F.sum(features.died()),
        icu_days=F.sum("duration_of_intensive_unit_stay"),
        icu_known=F.count("duration_of_intensive_unit_stay"),
        days=F.sum("duration_of_stay"),
        days_known=F.count("duration_of_stay"),
    )
    history = t.patient_history.groupBy("patient_id").agg(
        rows().alias("histories"),
        F.sum(features.heart_disease()).alias("heart"),
        F.sum(features.lung_disease()).alias("lung"),
    )
    per_patient = copies(t.patients, "patient_id", "persons").join(history, "patient_id")
    per_stay = ("admissions", "ids", "icu", "deaths", "icu_days", "icu_known", "days",
                "days_known")
    per_hospital = (
        stays.join(per_patient, "patient_id")
        .groupBy("hospital_id")
        .agg(
            *(F.sum(times(c, "persons", "histories")).alias(c) for c in per_stay),
            *(F.sum(times("admissions", "persons", c)).alias(c) for c in ("heart", "lung")),
        )
    )
    beds = t.hospitals.groupBy(F.col("hosp_id").alias("hospital_id")).agg(
        rows().alias("hospital_rows"),
        *(
            F.sum(c).alias(c)
            for c in ("surgery_theatres", "ventilators_available", "num_staffed_beds",
                      "num_licensed_beds", "num_icu_beds")
        ),
    )
    return per_hospital.join(beds, "hospital_id").select(
        "hospital_id",
        whole(F.col("ids") * F.col("hospital_rows")).alias("total_admission"),
        whole(F.col("icu") * F.col("hospital_rows")).alias("total_icu_admission"),
        F.round(ratio("deaths", "ids"), 2).alias("mortality_rate"),
        F.round(ratio("icu_days", "icu_known")).alias("avg_day_in_icu"),
        whole(F.col("admissions") * F.col("surgery_theatres")).alias("no_of_surgical_theatre"),
        F.round(ratio("days", "days_known")).alias("avg_day_of_stay"),
        whole(F.col("admissions") * F.col("ventilators_available")).alias("no_of_vantilators"),
        F.round(ratio("num_staffed_beds", "num_licensed_beds"), 2).alias(
            "staffed_bed_to_normal_bed_ratio"
        ),
        F.round(ratio("num_icu_beds", "num_licensed_beds"), 2).alias("icu_bed_to_normal_bed_ratio"),
        F.round(ratio("heart", "admissions") * 100, 2).alias("patient_with_heart_disease"),
        F.round(ratio("lung", "admissions") * 100, 2).alias("patient_with_lung_disease"),
    )


def reading_summary(readings: DataFrame) -> DataFrame:
    """Device readings per patient: how many, how many with a rate, and the rates' sum."""
    return readings.filter(F.col("patient_id").isNotNull()).groupBy("patient_id").agg(
        rows().alias("readings"),
        F.count("heart_rate_per_minute").alias("rated"),
        F.sum("heart_rate_per_minute").alias("rate_sum"),
    )


def _history_summary(history: DataFrame) -> DataFrame:
    levels = {level: f"n_{level}" for level in features.RISK_LEVELS}
    per_patient = (
        with_risk(history.filter(F.col("patient_id").isNotNull()))
        .groupBy("patient_id")
        .agg(
            rows().alias("histories"),
            F.avg("tot").alias("conditions"),
            *(F.count_if(F.col("risk") == level).alias(name) for level, name in levels.items()),
        )
    )
    return per_patient.select(
        "patient_id",
        "histories",
        "conditions",
        features.mode_of({level: F.col(f"`{name}`") for level, name in levels.items()}).alias(
            "patient_risk"
        ),
    )


def with_risk(history: DataFrame) -> DataFrame:
    """Histories reduced to patient, number of conditions (``tot``) and ``risk``."""
    counted = history.select(
        "patient_id", "smoking_", "alcohol", features.condition_total().alias("tot")
    )
    return counted.select("patient_id", "tot", features.risk(F.col("tot")).alias("risk"))


def policy_calendar(t: CareTables) -> DataFrame:
    """Per patient and policy end date, the admissions before it and the totals.

    A policy is active for the admissions dated before its end.  Counting them
    needs no pairing of policies with admissions: admissions and policy ends
    are reduced to one row per patient and day, and a running sum over a
    patient's days says how many admissions lie before each end.
    """
    hospitals = t.hospitals.filter(F.col("hosp_id").isNotNull()).select("hosp_id", "location")
    admitted = (
        t.new_admissions.filter(F.col("patient_id").isNotNull())
        .join(hospitals, F.col("hospital_id") == F.col("hosp_id"))
        .groupBy("patient_id", parse_day(F.col("d_o_a")).alias("day"))
        .agg(
            rows().alias("admissions"),
            F.count("admission_id").alias("ids"),
            F.sum("duration_of_stay").alias("days"),
            F.count("location").alias("places"),
        )
    )
    ends = (
        t.policies_new.filter(F.col("patient_id").isNotNull())
        .select("patient_id", F.col("policy_end_date").alias("day"))
        .distinct()
    )
    return calendar_of(admitted, ends)


def calendar_of(admitted: DataFrame, ends: DataFrame) -> DataFrame:
    """The running count over days: ``admitted`` has one row per patient and day, ``ends`` per patient and end."""
    measures = ("admissions", "ids", "days", "places")
    admitted = admitted.withColumns(
        {"is_end": F.lit(False), "dated": F.when(F.col("day").isNotNull(), F.col("admissions"))}
    )
    ends = ends.withColumn("is_end", F.lit(True))
    # Ends come before the admissions of the same day, which they do not cover,
    # and undated rows before everything else.
    calendar = Window.partitionBy("patient_id").orderBy("day", F.desc("is_end"))
    so_far = calendar.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    always = calendar.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        admitted.unionByName(ends, allowMissingColumns=True)
        .select(
            "patient_id",
            F.col("day").alias("policy_end_date"),
            "is_end",
            F.coalesce(F.sum("dated").over(so_far), F.lit(0)).alias("active"),
            *(F.sum(c).over(always).alias(c) for c in measures),
        )
        .filter(F.col("is_end") & (F.col("admissions") > 0))
        .drop("is_end")
    )


def patient_facts(
    t: CareTables,
    *,
    as_of: dt.date | None = None,
    per_reading: bool = True,
    readings: DataFrame | None = None,
) -> DataFrame:
    """Policy activity, conditions, risk, stays, coverage and heart rate per policy.

    Means the aggregate of policies x patient rows x history rows x admissions x
    device readings, so admissions and hospital days count once per reading.
    ``per_reading=False`` leaves that factor out.  ``readings`` may bring a
    ready :func:`reading_summary`, such as the one a stream maintains.
    """
    if readings is None:
        readings = reading_summary(t.patient_device_stream)
    people = (
        t.patients.filter(F.col("patient_id").isNotNull())
        .groupBy("patient_id", age_in_365_days(F.col("dob"), as_of).alias("age_of_patient"))
        .agg(rows().alias("persons"))
    )
    known = people.join(_history_summary(t.patient_history), "patient_id").join(
        readings, "patient_id"
    )
    covers = t.plans.select("plan_id", features.full_coverage().alias("covered"))
    covers = covers.withColumn("covered_known", F.when(F.col("covered").isNotNull(), 1))
    sold = t.policies_new.select(
        "patient_id", "policy_number", "plan_id", "policy_end_date"
    ).join(covers, "plan_id")
    factors = ["persons", "histories"]
    if per_reading:
        factors.append("readings")
    grouped = policy_facts(policy_calendar(t), known, sold, by="age_of_patient", factors=factors)
    return grouped.select(*FACTS)


FACTS = (
    "patient_id", "policy_number", "age_of_patient", "active_policy_holder",
    "total_medical_condition_of_patient", "number_of_hospital_admissions", "patient_risk",
    "total_hospital_days_of_patient", "insurance_coverage", "no_of_cross_city_admissions",
    "avg_heart_rate",
)


def policy_facts(
    calendar: DataFrame,
    known: DataFrame,
    sold: DataFrame,
    *,
    by: str,
    factors: list[str],
    copies: tuple[str, ...] = (),
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """Facts per patient, policy and the patient column ``by``, put together from summaries.

    ``calendar`` comes from :func:`calendar_of`.  ``known`` has what is known of
    a patient (``conditions``, ``patient_risk``, ``rate_sum``, ``rated``), a row
    for each ``by``, with the counts that multiply totals (``factors``).  A row
    of ``sold`` stands for the product of ``copies`` policies; its ``covered``
    and ``covered_known`` are sums over them.
    """
    about = (
        calendar.join(known, "patient_id")
        .withColumnRenamed("patient_id", "holder")
        .withColumnRenamed("policy_end_date", "ends")
    )

    def counted(measure: str) -> Column:
        return whole(F.sum(times(measure, *factors, *copies)))

    same_end = F.col("policy_end_date").eqNullSafe(F.col("ends"))
    grouped = (
        sold.join(about, (F.col("patient_id") == F.col("holder")) & same_end)
        .groupBy("patient_id", "policy_number", by)
        .agg(
            F.sum(times("active", *copies)).alias("active"),
            F.sum(times(F.col("admissions") - F.col("active"), *copies)).alias("inactive"),
            F.any_value("conditions").alias("total_medical_condition_of_patient"),
            counted("ids").alias("number_of_hospital_admissions"),
            F.any_value("patient_risk").alias("patient_risk"),
            counted("days").alias("total_hospital_days_of_patient"),
            ratio(F.sum("covered"), F.sum("covered_known")).alias("insurance_coverage"),
            counted("places").alias("no_of_cross_city_admissions"),
            steady_round(ratio(F.any_value("rate_sum"), F.any_value("rated"))).alias(
                "avg_heart_rate"
            ),
            *(F.any_value(c).alias(c) for c in carried),
        )
    )
    activity = {"True": F.col("active"), "False": F.col("inactive")}
    return grouped.withColumn("active_policy_holder", features.mode_of(activity)).drop("active", "inactive")


def policy_holders(t: CareTables, *, as_of: dt.date | None = None) -> DataFrame:
    """Every patient with age and policies; patients without a policy keep NULLs.

    The outer join is put together from an inner join, whose frequent patients
    can be split over tasks, and the patients that have no policy at all.
    """
    people = t.patients.withColumn("age_of_patient", age_in_365_days(F.col("dob"), as_of))
    columns = ("patient_id", "full_name", "age_of_patient", "policy_number", "plan_id")
    insured = t.policies_new.join(people, "patient_id").select(*columns)
    holders = t.policies_new.select("patient_id").distinct()
    uninsured = people.join(holders, "patient_id", "left_anti")
    return insured.unionByName(
        uninsured.select(*columns[:3]), allowMissingColumns=True
    ).select(*columns)
