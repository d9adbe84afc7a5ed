"""Questions that count distinct admissions and policies, answered from kept bitmaps.

New admissions and policies are reduced to bitmaps and sums and appended to a
layer of their own; a question merges those instead of reading all rows again.
What belongs together becomes current in one version, and a run that finds the
layer changed since it began fails instead of counting rows twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.operators import distinct
from carelake.sources import layers
from carelake.tables import CareTables

LAYER = "distinct"
ADMISSIONS, STAYS, POLICIES, NUMBERS = "admission_bitmaps", "stay_sums", "policy_bitmaps", "policy_numbers"
PLACE = ["hospital_id", "patient_id"]
ABOUT = {
    ADMISSIONS: layers.About("Bitmaps of admission_id per hospital and patient"),
    STAYS: layers.About("Sum and number of known stays per hospital and patient"),
    POLICIES: layers.About("Bitmaps of numbered policies per plan"),
    NUMBERS: layers.About("The number of each policy_number"),
}


def add(
    spark: SparkSession, root: str, *, admissions: DataFrame | None = None, policies: DataFrame | None = None
) -> layers.Layer:
    """Take in rows that no earlier call has had; either all of them count or none."""
    present = layers.opened(spark, root, LAYER)
    frames, stored = {}, {}
    if admissions is not None:
        frames[ADMISSIONS] = distinct.bitmaps(admissions, PLACE, "admission_id")
        frames[STAYS] = admissions.groupBy(*PLACE).agg(
            F.sum("duration_of_stay").alias("days"), F.count("duration_of_stay").alias("known")
        )
    if policies is not None:
        known = spark.createDataFrame([], "value string, number bigint")
        if NUMBERS in present.datasets:
            known = present.read(NUMBERS)
        values = policies.select(F.col("policy_number").alias("value"))
        stored = layers.store_all({NUMBERS: distinct.unnumbered(values, known)}, root, LAYER, ABOUT)
        (folder,) = stored[NUMBERS].folders
        new = spark.read.schema(known.schema).parquet(f"{layers.location(root, LAYER, NUMBERS)}/{folder}")
        numbered = policies.join(known.union(new), F.col("policy_number") == F.col("value"))
        frames[POLICIES] = distinct.bitmaps(numbered, ["plan_id"], "number")
    stored |= layers.store_all(frames, root, LAYER, ABOUT)
    return layers.publish(spark, root, LAYER, {}, appended=stored, expected=present.version)


def fold(spark: SparkSession, root: str) -> layers.Layer:
    """Merge what has been appended, so that a key has each word once."""
    present = layers.opened(spark, root, LAYER)
    frames = {
        name: distinct.merged(present.read(name), by)
        for name, by in ((ADMISSIONS, PLACE), (POLICIES, ["plan_id"])) if name in present.datasets
    }
    if STAYS in present.datasets:
        sums = present.read(STAYS).groupBy(*PLACE)
        frames[STAYS] = sums.agg(F.sum("days").alias("days"), F.sum("known").alias("known"))
    stored = layers.store_all(frames, root, LAYER, ABOUT)
    return layers.publish(spark, root, LAYER, stored, expected=present.version)


def resource_use(kept: layers.Layer, t: CareTables) -> DataFrame:
    """Admissions per ICU bed and per ventilator; NULL where a hospital has none."""
    group = ["name", "num_icu_beds", "ventilators_available"]
    words = distinct.merged(kept.read(ADMISSIONS), ["hospital_id"])
    at = t.hospitals.select("hosp_id", *group).join(words, F.col("hosp_id") == F.col("hospital_id"), "left")
    return distinct.counted(at, group, "admissions").select(
        F.col("name").alias("hospital_name"),
        F.try_divide("admissions", "num_icu_beds").alias("icu_bed_utilization_rate"),
        F.try_divide("admissions", "ventilators_available").alias("ventilator_utilization_rate"),
    )


def plan_popularity(kept: layers.Layer, t: CareTables) -> DataFrame:
    """Policies per payment type, and as a fraction of all policies."""
    words = distinct.merged(kept.read(POLICIES), ["plan_id"])
    total = distinct.merged(words, []).agg(distinct.size()).scalar()
    plans = t.plans.select("plan_id", "payment_type").distinct()
    counts = distinct.counted(plans.join(words, "plan_id", "left"), ["payment_type"], "policy_count")
    return counts.withColumn("percentage_of_total", F.try_divide("policy_count", total))


def long_term_patients(kept: layers.Layer, t: CareTables) -> DataFrame:
    """Admissions and mean stay per hospital name and patient name."""
    names = t.hospitals.select("hosp_id", F.col("name").alias("hospital_name"))
    people = t.patients.select("patient_id", F.col("full_name").alias("provider_name"))
    group = ["hospital_name", "provider_name"]

    def named(df: DataFrame) -> DataFrame:
        return df.join(names, F.col("hospital_id") == F.col("hosp_id")).join(people, "patient_id")

    counts = distinct.counted(named(kept.read(ADMISSIONS)), group, "admissions")
    stays = named(kept.read(STAYS)).groupBy(*group).agg(F.sum("days").alias("days"), F.sum("known").alias("known"))
    # Every group has sums; one whose admissions have no id has no bitmap.
    return (
        stays.unionByName(counts, allowMissingColumns=True)
        .groupBy(*group)
        .agg(
            F.coalesce(F.sum("admissions"), F.lit(0)).alias("total_admissions"),
            F.try_divide(F.sum("days"), F.sum("known")).alias("avg_duration_of_stay"),
        )
    )
