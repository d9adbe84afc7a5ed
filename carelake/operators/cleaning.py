"""Row and value repairs that turn raw tables into clean ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions.dates import day_first_text
from carelake.operators.quality import HOSPITAL_HAS_ID, enforce
from carelake.tables import CareTables


def harmonise_date(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, day_first_text(F.col(column)))


def repair_beds(hospitals: DataFrame) -> DataFrame:
    """Children's ICU beds to 0 where the ICU sum is off; staffed beds at most licensed.

    A comparison with NULL is no finding and leaves the value alone.
    """
    icu_off = F.col("adult_icu_beds") + F.col("pedi_icu_beds") != F.col("num_icu_beds")
    over = F.col("num_staffed_beds") > F.col("num_licensed_beds")
    return hospitals.withColumns(
        {
            "pedi_icu_beds": F.when(icu_off, 0).otherwise(F.col("pedi_icu_beds")),
            "num_staffed_beds": F.when(over, F.col("num_licensed_beds")).otherwise(
                F.col("num_staffed_beds")
            ),
        }
    )


def exclude_patient(
    patients: DataFrame, full_name: str, patient_id: str, mode: str = "either"
) -> DataFrame:
    """Leave out a patient known to be wrong.

    ``either`` drops rows where the name or the id matches, and rows where that
    cannot be told because one is NULL.  ``pair`` drops rows where both match.
    """
    name, key = F.col("full_name"), F.col("patient_id")
    if mode == "either":
        return patients.filter((name != full_name) & (key != patient_id))
    if mode == "pair":
        both = name.eqNullSafe(full_name) & key.eqNullSafe(patient_id)
        return patients.filter(~both)
    raise ValueError(f"mode must be 'either' or 'pair', not {mode!r}")


def clean_hospitals(raw: DataFrame) -> DataFrame:
    return repair_beds(enforce(raw, HOSPITAL_HAS_ID))


def clean_admissions(raw: DataFrame) -> DataFrame:
    return harmonise_date(raw, "d_o_a")


def clean_patients(
    raw: DataFrame, exclude: tuple[str, str] | None = None, mode: str = "either"
) -> DataFrame:
    """Dates in one spelling, exact duplicate rows once, optionally without one patient."""
    df = harmonise_date(raw, "dob")
    if exclude is not None:
        df = exclude_patient(df, *exclude, mode=mode)
    return df.dropDuplicates()


def clean_tables(
    raw: CareTables, exclude: tuple[str, str] | None = None, mode: str = "either"
) -> CareTables:
    """Silver from bronze; histories, plans, policies and readings pass unchanged."""
    return raw.derive(
        hospitals=lambda: clean_hospitals(raw.hospitals),
        new_admissions=lambda: clean_admissions(raw.new_admissions),
        patients=lambda: clean_patients(raw.patients, exclude, mode),
    )
