"""The catalogue of insights over the clean tables.

Results that rank carry a tie-break on their keys, so that they repeat.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions.dates import age_by_calendar_year, parse_day
from carelake.operators.summaries import modes, rows, times, weighted_mean, whole
from carelake.tables import CareTables

EMERGENCY = "E"
DEATH = "EXPIRY"
DISCHARGE = "DISCHARGE"
PUBLIC_SECTOR = "Public/Government"


def _emergency(admission_type: str) -> Column:
    return F.col("type_of_admission_emergency_or_opd") == admission_type


def _percentage(condition: Column) -> Column:
    return F.try_divide(F.count_if(condition) * F.lit(100.0), rows())


def hospitals_per_sector(t: CareTables) -> DataFrame:
    return t.hospitals.groupBy("sector").agg(rows().alias("hospital_count"))


def beds_per_state(t: CareTables) -> DataFrame:
    return t.hospitals.groupBy("state").agg(F.avg("num_licensed_beds").alias("avg_licensed_beds"))


def smokers(t: CareTables) -> DataFrame:
    return t.patient_history.agg(_percentage(F.col("smoking_") == 1).alias("percentage_smokers"))


def busiest_hospitals(t: CareTables, *, top: int = 5) -> DataFrame:
    """Hospitals with the most admissions; those without a hospital count as one group."""
    counts = t.new_admissions.groupBy("hospital_id").agg(rows().alias("admission_count"))
    return counts.orderBy(F.desc("admission_count"), "hospital_id").limit(top)


def diabetes_and_hypertension(t: CareTables) -> DataFrame:
    both = (F.col("dm") == 1) & (F.col("htn") == 1)
    return t.patient_history.agg(_percentage(both).alias("percentage_diabetes_and_hypertension"))


def premium_per_plan(t: CareTables) -> DataFrame:
    return t.policies_new.groupBy("plan_id").agg(F.avg("daily_premium").alias("avg_daily_premium"))


def heart_failure(t: CareTables) -> DataFrame:
    return t.patient_history.agg(
        _percentage(F.col("heart_failure") == 1).alias("percentage_heart_failure")
    )


def coverage_per_plan(t: CareTables) -> DataFrame:
    return t.policies_new.groupBy("plan_id").agg(
        F.sum("insurance_coverage").alias("total_coverage")
    )


def plan_outcomes(t: CareTables) -> DataFrame:
    """Admissions and mean stay of each plan's holders, once per policy held."""
    stays = t.new_admissions.groupBy("patient_id").agg(
        F.count("admission_id").alias("ids"),
        F.sum("duration_of_stay").alias("days"),
        F.count("duration_of_stay").alias("known"),
    )
    held = t.policies_new.groupBy("patient_id", "plan_id").agg(rows().alias("policies"))
    return (
        held.join(stays, "patient_id")
        .groupBy("plan_id")
        .agg(
            whole(F.sum(times("ids", "policies"))).alias("total_admissions"),
            weighted_mean(times("days", "policies"), times("known", "policies")).alias(
                "avg_duration_of_stay"
            ),
        )
    )


def resource_use(t: CareTables) -> DataFrame:
    """Admissions per ICU bed and per ventilator; NULL where a hospital has none.

    Hospitals enter once more with no admission, so that those without any
    stay in; the distinct count passes over the NULL.
    """
    group = ("name", "num_icu_beds", "ventilators_available")
    admitted = t.hospitals.join(t.new_admissions, F.col("hosp_id") == F.col("hospital_id"))
    empty = t.hospitals.select(*group, F.lit(None).cast("bigint").alias("admission_id"))
    counts = (
        admitted.select(*group, "admission_id")
        .unionByName(empty)
        .groupBy(*group)
        .agg(F.count_distinct("admission_id").alias("admissions"))
    )
    return counts.select(
        F.col("name").alias("hospital_name"),
        F.try_divide("admissions", "num_icu_beds").alias("icu_bed_utilization_rate"),
        F.try_divide("admissions", "ventilators_available").alias("ventilator_utilization_rate"),
    )


def _per_hospital(admissions: DataFrame, patients: DataFrame, **keys: Column) -> DataFrame:
    """Admissions of known patients per hospital, with the sum and number of stays.

    Rows are joined as they are: a summary per patient and hospital would shuffle
    all admissions once more and hardly shrink them, and adaptive execution
    splits a frequent patient, since the counting behind the join shuffles anew.
    """
    return (
        admissions.filter(F.col("hospital_id").isNotNull())
        .select("patient_id", "hospital_id", "duration_of_stay", *(key.alias(name) for name, key in keys.items()))
        .join(patients.select("patient_id"), "patient_id")
        .drop("patient_id")
        .groupBy("hospital_id", *keys)
        .agg(
            rows().alias("admissions"),
            F.sum("duration_of_stay").alias("days"),
            F.count("duration_of_stay").alias("known"),
        )
    )


def _at_hospitals(t: CareTables, per_hospital: DataFrame) -> DataFrame:
    return per_hospital.join(t.hospitals, F.col("hospital_id") == F.col("hosp_id"))


def sector_demographics(t: CareTables, *, as_of: dt.date | None = None) -> DataFrame:
    """Mean age and number of admitted patients per sector, once per admission."""
    age = age_by_calendar_year(F.col("dob"), as_of)
    per_hospital = (
        t.new_admissions.filter(F.col("hospital_id").isNotNull())
        .select("patient_id", "hospital_id")
        .join(t.patients.select("patient_id", age.alias("age")), "patient_id")
        .groupBy("hospital_id")
        .agg(
            rows().alias("persons"), F.sum("age").alias("years"), F.count("age").alias("aged")
        )
    )
    return (
        _at_hospitals(t, per_hospital)
        .groupBy("sector")
        .agg(
            weighted_mean("years", "aged").alias("avg_age"),
            whole(F.sum("persons")).alias("total_patients"),
        )
    )


def plan_popularity(t: CareTables) -> DataFrame:
    """Policies per payment type, and as a fraction of all policies.

    Plans enter once more without a policy, so that unsold ones stay in.
    """
    unsold = t.plans.select("payment_type", F.lit(None).cast("string").alias("policy_number"))
    total = t.policies_new.agg(F.count_distinct("policy_number")).scalar()
    return (
        t.policies_new.join(t.plans, "plan_id")
        .select("payment_type", "policy_number")
        .unionByName(unsold)
        .groupBy("payment_type")
        .agg(F.count_distinct("policy_number").alias("policy_count"))
        .withColumn("percentage_of_total", F.try_divide("policy_count", total))
    )


def long_term_patients(t: CareTables) -> DataFrame:
    """Admissions and mean stay per hospital name and patient name.

    Distinct admissions cannot be added up over ids that share a name, so the
    rows are joined as they are; adaptive execution splits frequent keys, since
    the counting behind the joins shuffles anew.
    """
    names = t.hospitals.select("hosp_id", F.col("name").alias("hospital_name"))
    people = t.patients.select("patient_id", F.col("full_name").alias("provider_name"))
    return (
        t.new_admissions.select("patient_id", "hospital_id", "admission_id", "duration_of_stay")
        .join(names, F.col("hospital_id") == F.col("hosp_id"))
        .join(people, "patient_id")
        .groupBy("hospital_name", "provider_name")
        .agg(
            F.count_distinct("admission_id").alias("total_admissions"),
            F.avg("duration_of_stay").alias("avg_duration_of_stay"),
        )
    )


def patients_per_hospital(t: CareTables) -> DataFrame:
    return (
        _at_hospitals(t, _per_hospital(t.new_admissions, t.patients))
        .groupBy(F.col("name").alias("hospital_name"))
        .agg(whole(F.sum("admissions")).alias("count_of_patients"))
        .orderBy(F.desc("count_of_patients"), "hospital_name")
    )


def emergencies_per_day(t: CareTables, *, admission_type: str = EMERGENCY) -> DataFrame:
    return (
        t.new_admissions.filter(_emergency(admission_type))
        .groupBy(F.col("d_o_a").alias("date"))
        .agg(F.count("patient_id").alias("no_of_patients"))
        .orderBy(F.desc("no_of_patients"), "date")
    )


def patients_per_place(t: CareTables) -> DataFrame:
    return (
        _at_hospitals(t, _per_hospital(t.new_admissions, t.patients))
        .groupBy("state", "location")
        .agg(whole(F.sum("admissions")).alias("count_of_patients"))
        .orderBy(F.desc("count_of_patients"), "state", "location")
    )


def emergency_outcomes_per_month(
    t: CareTables, *, outcome: str = DEATH, admission_type: str = EMERGENCY
) -> DataFrame:
    """Emergency cases with the given outcome per year and month of admission."""
    cases = t.new_admissions.filter(_emergency(admission_type) & (F.col("outcome") == outcome))
    day = parse_day(F.col("d_o_a"))
    return (
        _at_hospitals(t, _per_hospital(cases, t.patients, year=F.year(day), month=F.month(day)))
        .groupBy("year", "month")
        .agg(whole(F.sum("admissions")).alias("count_of_caes"))
    )


def stay_to_discharge(t: CareTables, *, admission_type: str = EMERGENCY) -> DataFrame:
    """Mean stay of discharged emergency patients per hospital, shortest first."""
    cases = t.new_admissions.filter(_emergency(admission_type) & (F.col("outcome") == DISCHARGE))
    return (
        _at_hospitals(t, _per_hospital(cases, t.patients))
        .groupBy(F.col("name").alias("hospital_name"))
        .agg(weighted_mean("days", "known").alias("avg_stay"))
        .orderBy("avg_stay", "hospital_name")
    )


def beds_per_place(t: CareTables) -> DataFrame:
    return (
        t.hospitals.groupBy("state", "location")
        .agg(F.sum("num_licensed_beds").alias("total_beds"))
        .orderBy(F.desc("total_beds"), "state", "location")
    )


def sector_hospitals_per_place(t: CareTables, *, sector: str = PUBLIC_SECTOR) -> DataFrame:
    return (
        t.hospitals.filter(F.col("sector") == sector)
        .groupBy("state", "location")
        .agg(F.count("sector").alias("no_of_gov_hospitals"))
        .orderBy(F.desc("no_of_gov_hospitals"), "state", "location")
    )


def hospitals_per_place(t: CareTables) -> DataFrame:
    return (
        t.hospitals.groupBy("location", "state")
        .agg(F.count("hosp_id").alias("count_of_hospitals"))
        .orderBy(F.desc("count_of_hospitals"), "location", "state")
    )


def usual_hospitals(t: CareTables) -> DataFrame:
    """The hospital that each patient is admitted to most, and the usual stay of their admissions."""
    hospitals = modes(t.new_admissions, ["patient_id"], "hospital_id", "usual_hospital")
    stays = modes(t.new_admissions, ["patient_id"], "duration_of_stay", "usual_stay")
    stays = stays.withColumnRenamed("patient_id", "_patient")
    same = F.col("patient_id").eqNullSafe(F.col("_patient"))
    return hospitals.join(stays, same).drop("_patient")
