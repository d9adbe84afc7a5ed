"""Business questions on premiums, plans, branches and conditions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.functions import features
from carelake.functions.dates import age_by_calendar_year, age_in_full_years, parse_day
from carelake.operators.summaries import (
    copies,
    ratio,
    rows,
    times,
    visits,
    whole,
)
from carelake.tables import CareTables


def above_average_premium(t: CareTables) -> DataFrame:
    """How many patients pay more than the mean daily premium."""
    mean = t.policies_new.agg(F.avg("daily_premium")).scalar()
    return t.policies_new.filter(F.col("daily_premium") > mean).agg(
        F.count_distinct("patient_id").alias("count_of_patients")
    )


# Output names of the six cover shares.
COVER_NAMES = dict(
    zip(
        features.COVERS,
        ("Inpatient_AvgCoverage", "Outpatient_AvgCoverage", "Prescription_AvgCoverage",
         "MentalHealth_AvgCoverage", "Dental_AvgCoverage", "Vision_AvgCoverage"),
        strict=True,
    )
)


def cover_share(t: CareTables) -> DataFrame:
    """Share of the plans that include each cover."""
    return t.plans.agg(
        *(F.avg(F.col(cover).cast("int")).alias(name) for cover, name in COVER_NAMES.items())
    )


def plan_premium(t: CareTables) -> DataFrame:
    """Mean daily premium and the premiums paid over the span a plan was sold for.

    One is added per policy to the paid amount, not to its days.
    """
    term = F.datediff("policy_end_date", "policy_start_date")
    per_plan = t.policies_new.groupBy("plan_id").agg(
        F.avg("daily_premium").alias("mean"),
        F.sum(F.col("daily_premium") * term + 1).alias("paid"),
        F.datediff(F.max("policy_end_date"), F.min("policy_start_date")).alias("span"),
    )
    return per_plan.join(copies(t.plans, "plan_id", "plan_rows"), "plan_id").select(
        F.col("plan_id").alias("plan_type"),
        F.col("mean").alias("DailyPremium_Avg"),
        ratio(F.col("paid") * F.col("plan_rows"), "span").alias("AverageAnnualPremium"),
    )


def branch_conditions(t: CareTables) -> DataFrame:
    """Admissions with diabetes, hypertension, both and neither per branch."""
    diabetes, hypertension = F.col("dm"), F.col("htn")
    history = t.patient_history.groupBy("patient_id").agg(
        F.sum("dm").alias("dm_true"),
        F.sum("htn").alias("htn_true"),
        F.count_if((diabetes == 1) & (hypertension == 1)).alias("both"),
        F.count_if((diabetes == 0) & (hypertension == 0)).alias("neither"),
    )
    measures = ("dm_true", "htn_true", "both", "neither")
    known = copies(t.patients, "patient_id", "persons").join(history, "patient_id")
    per_hospital = (
        visits(t.new_admissions, admissions=rows())
        .join(known, "patient_id")
        .groupBy("hospital_id")
        .agg(
            *(
                F.sum(times(c, "admissions", "persons")).alias(c) for c in measures
            )
        )
    )
    return (
        per_hospital.join(t.hospitals, F.col("hospital_id") == F.col("hosp_id"))
        .groupBy(
            features.branch_id(F.col("hosp_id")).alias("branch_id"),
            F.col("name").alias("hospital_name"),
        )
        .agg(*(whole(F.sum(c)).alias(c) for c in measures))
    )


def branch_tier(
    t: CareTables, *, as_of: dt.date | None = None, **thresholds: int
) -> DataFrame:
    """Mean patient age, admissions and tier of every hospital, also without admissions.

    ``thresholds`` are those of :func:`carelake.functions.features.branch_tier`.
    """
    age = age_by_calendar_year(F.col("dob"), as_of)
    per_hospital = (
        t.new_admissions.filter(F.col("hospital_id").isNotNull())
        .select("patient_id", "hospital_id", "admission_id")
        .join(t.patients.select("patient_id", age.alias("age")), "patient_id", "left")
        .groupBy("hospital_id")
        .agg(F.avg("age").alias("age"), F.count("admission_id").alias("ids"))
    )
    branches = t.hospitals.groupBy("hosp_id", "name").agg(rows().alias("hospital_rows"))
    return (
        branches.join(per_hospital, F.col("hosp_id") == F.col("hospital_id"), "left")
        .select(
            F.col("hosp_id").alias("branch_id"),
            F.col("name").alias("hospital_name"),
            F.coalesce("age", F.lit(0.0)).alias("avg_patient_age"),
            whole(F.coalesce(times("ids", "hospital_rows"), F.lit(0))).alias(
                "total_admissions"
            ),
        )
        .withColumn(
            "branch_tier",
            features.branch_tier(
                F.col("avg_patient_age"), F.col("total_admissions"), **thresholds
            ),
        )
    )


def plan_month_admissions(t: CareTables) -> DataFrame:
    """Admissions of each plan's holders per year and month.

    Within a patient at most the distinct plans meet the distinct months.
    """
    held = t.policies_new.groupBy("patient_id", "plan_id").agg(rows().alias("policies"))
    day = parse_day(F.col("d_o_a"))
    admitted = t.new_admissions.groupBy(
        "patient_id", F.year(day).alias("year"), F.month(day).alias("month")
    ).agg(F.count("admission_id").alias("ids"))
    per_plan = (
        held.join(copies(t.patients, "patient_id", "persons"), "patient_id")
        .join(admitted, "patient_id")
        .groupBy("plan_id", "year", "month")
        .agg(F.sum(times("policies", "persons", "ids")).alias("ids"))
    )
    return per_plan.join(copies(t.plans, "plan_id", "plan_rows"), "plan_id").select(
        "plan_id",
        "year",
        "month",
        whole(F.col("ids") * F.col("plan_rows")).alias("admission_count"),
    )


def plan_changes(t: CareTables) -> DataFrame:
    """Consecutive policies of a patient with different plans, old and new plan.

    Policies run in order of their start date and, on equal dates, of the plan.
    Several policies of one plan on one day are then neighbours without a
    change, so each patient needs one row per day and plan only, which bounds
    what a single patient can bring into the window.
    """
    steps = (
        t.policies_new.filter(F.col("patient_id").isNotNull())
        .select("patient_id", "policy_start_date", "plan_id")
        .distinct()
    )
    in_order = Window.partitionBy("patient_id").orderBy("policy_start_date", "plan_id")
    return (
        steps.select(
            "patient_id",
            F.lag("policy_start_date").over(in_order).alias("since"),
            F.lag("plan_id").over(in_order).alias("Previous_Policy"),
            F.col("plan_id").alias("Current_Policy"),
        )
        .filter(F.col("Previous_Policy") != F.col("Current_Policy"))
        .orderBy("patient_id", "since")
        .select("patient_id", "Previous_Policy", "Current_Policy")
    )


def age_conditions(t: CareTables, *, as_of: dt.date | None = None) -> DataFrame:
    """The most common of three conditions per age group."""
    conditions = {"diabetes": "dm", "hypertension": "htn", "cad": "cad"}
    history = t.patient_history.groupBy("patient_id").agg(
        *(F.count_if(F.col(flag) == 1).alias(name) for name, flag in conditions.items())
    )
    group = features.age_group(age_in_full_years(F.col("dob"), as_of))
    people = t.patients.groupBy("patient_id", group.alias("age_group")).agg(
        rows().alias("persons")
    )
    counts = (
        people.join(history, "patient_id")
        .groupBy("age_group")
        .agg(*(F.sum(times(name, "persons")).alias(name) for name in conditions))
    )
    return counts.select(
        "age_group",
        features.most_common_condition(*(F.col(name) for name in conditions)).alias(
            "most_common_condition"
        ),
    )
