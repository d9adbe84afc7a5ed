"""The layered batch run: CSV files to bronze, silver and gold Parquet tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession

from carelake import schemas
from carelake.functions import naming
from carelake.operators import cleaning, history
from carelake.operators.quality import (
    ADMISSION_DATE_READABLE,
    BIRTH_DATE_READABLE,
    HOSPITAL_HAS_ID,
    counted,
    enforce,
)
from carelake.plans.facts import hospital_facts, patient_facts
from carelake.sources import inference, layers, scratch
from carelake.sources.files import read_csv
from carelake.streaming.readings import CLEAN
from carelake.tables import CareTables

# Which naming rule a file's header needs; the others are stored as read.
HEADER_RULES = {
    "new_admissions": naming.admissions,
    "patient_history": naming.basic,
    "patients": naming.basic,
}

COMMENTS = {
    "hospitals": "Hospitals with place, sector, beds and equipment",
    "new_admissions": "Admissions of patients to hospitals, with stays and outcome",
    "patients": "Patients with name and date of birth",
    "patient_history": "Conditions and habits of each patient as flags",
    "plans": "Insurance plans and what they cover",
    "policies_new": "Policies that patients hold under a plan",
    "hospital_agg_facts": "Admissions, stays, mortality, beds and diseases per hospital",
    "patients_agg_facts": "Policy activity, conditions, stays and heart rate per patient and policy",
}
#: Tables that jobs join by patient.
PER_PATIENT = ("new_admissions", "patients", "patient_history", "policies_new")
STATES = {layers.BRONZE: ", as ingested", layers.SILVER: ", cleaned", layers.GOLD: ""}


def about(layer: str, datasets: Iterable[str]) -> dict[str, layers.About]:
    """Comment and properties of a layer's datasets."""

    def of(name: str) -> layers.About:
        subject = COMMENTS[name.removesuffix("_raw").removesuffix("_clean")]
        return layers.About(f"{subject}{STATES[layer]}", {"quality": layer})

    return {name: of(name) for name in datasets}


def ingest(
    spark: SparkSession, in_dir: str, out_dir: str, *, infer: bool = False
) -> dict[str, DataFrame]:
    """Bronze: the six CSV inputs (``in_dir/<table>.csv``) as Parquet tables.

    Types come from the documented schemas; ``infer=True`` finds them in the pass
    that lands the text, which is then read from where it was landed.
    """
    raw = {}
    for name, schema in schemas.BATCH.items():
        path, rule = f"{in_dir}/{name}.csv", HEADER_RULES.get(name)
        if infer:
            text = spark.read.csv(path, header=True)
            text = text if rule is None else naming.rename(text, rule)
            raw[f"{name}_raw"], _ = inference.land(text, scratch.new_folder(spark, f"text-{name}"))
        else:
            raw[f"{name}_raw"] = read_csv(spark, path, rule=rule, schema=schema)
    bronze = layers.materialise_all(raw, out_dir, layers.BRONZE, about(layers.BRONZE, raw))
    return {name: bronze.read(f"{name}_raw") for name in schemas.BATCH}


def refine(
    raw: dict[str, DataFrame],
    out_dir: str,
    *,
    exclude: tuple[str, str] | None = None,
    mode: str = "either",
    buckets: int | None = None,
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Silver tables from bronze, and how many rows failed each expectation.

    Dates that are present but cannot be read are counted; the rows stay.  With
    ``buckets`` the tables that jobs join by patient are laid out in as many
    files by patient, which saves those joins their shuffles; a table of which
    one patient has too much for one file is not.
    """
    checks = {
        "hospitals": HOSPITAL_HAS_ID, "new_admissions": ADMISSION_DATE_READABLE, "patients": BIRTH_DATE_READABLE,
    }
    seen = {name: Observation(f"checked {name}") for name in checks}

    def checked(name: str, df: DataFrame) -> DataFrame:
        return enforce(df, checks[name], observe_as=seen[name])

    clean = dict(raw)
    clean["hospitals"] = cleaning.repair_beds(checked("hospitals", raw["hospitals"]))
    clean["new_admissions"] = checked("new_admissions", cleaning.clean_admissions(raw["new_admissions"]))
    clean["patients"] = checked("patients", cleaning.clean_patients(raw["patients"], exclude, mode))
    frames = {f"{name}_clean": df for name, df in clean.items()}
    by_patient = layers.Buckets("patient_id", buckets) if buckets else None
    laid_out = {
        f"{name}_clean": by_patient for name in PER_PATIENT if by_patient and layers.is_even(raw[name], by_patient)
    }
    stored = layers.store_all(frames, out_dir, layers.SILVER, about(layers.SILVER, frames), laid_out)
    results = {name: counted(seen[name], checks[name]) for name in checks}
    spark = raw["hospitals"].sparkSession
    # In one step with the tables: what a run that fails has counted is never seen.
    silver = layers.publish(
        spark, out_dir, layers.SILVER, stored, appended=history.of_run(spark, out_dir, layers.SILVER, results)
    )
    counts = {"rows": results["hospitals"][0][3]}
    counts |= {name: failed for rows in results.values() for name, _, failed, _ in rows}
    return {name: silver.read(f"{name}_clean") for name in clean}, counts


def run_batch(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    *,
    as_of: dt.date | None = None,
    exclude: tuple[str, str] | None = None,
    mode: str = "either",
    infer: bool = False,
    buckets: int | None = None,
) -> dict[str, int]:
    """Rebuild all layers; returns the hospital rows and the expectations' failures.

    The device readings must have been landed by
    :func:`carelake.streaming.readings.run_stream` with the same ``out_dir``.
    """
    raw = ingest(spark, in_dir, out_dir, infer=infer)
    clean, counts = refine(raw, out_dir, exclude=exclude, mode=mode, buckets=buckets)
    t = CareTables(
        **clean, patient_device_stream=layers.landed(spark, out_dir, layers.SILVER, CLEAN)
    )
    gold = {
        "hospital_agg_facts": hospital_facts(t),
        "patients_agg_facts": patient_facts(t, as_of=as_of),
    }
    layers.materialise_all(gold, out_dir, layers.GOLD, about(layers.GOLD, gold))
    return counts


def silver_tables(spark: SparkSession, out_dir: str, version: int | None = None) -> CareTables:
    """The clean tables of one run (the latest if none is named), and the readings landed so far."""
    silver = layers.opened(spark, out_dir, layers.SILVER, version)
    return CareTables(
        **{name: (lambda name=name: silver.read(f"{name}_clean")) for name in schemas.BATCH},
        patient_device_stream=lambda: layers.landed(spark, out_dir, layers.SILVER, CLEAN),
    )
