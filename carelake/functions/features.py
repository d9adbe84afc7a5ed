"""Named features of admissions, histories, policies and branches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Column lists of the patient history and of the plans.
CONDITIONS = (
    "dm", "htn", "cad", "prior_cmp", "ckd", "severe_anaemia", "stable_angina",
    "acs", "stemi", "atypical_chest_pain", "heart_failure", "hfref", "hfnef",
    "valvular", "chb", "sss", "aki", "cva_infract", "cva_bleed", "af", "vt",
)
HEART_CONDITIONS = (
    "cad", "prior_cmp", "heart_failure", "hfref", "hfnef", "valvular", "chb", "sss", "af",
)
LUNG_CONDITIONS = ("smoking_", "alcohol", "chest_infection", "pulmonary_embolism")
COVERS = (
    "inpatient_care", "outpatient_care", "prescription_drugs",
    "mental_health_care", "dental_care", "vision_care",
)
RISK_LEVELS = ("Critical", "High", "Low", "Medium", "Unknown", "Very High")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.when(condition, 1).otherwise(0)


def any_positive(columns: tuple[str, ...]) -> Column:
    return flag(F.expr(" OR ".join(f"{c} > 0" for c in columns)))


def icu_admission() -> Column:
    return flag(F.col("duration_of_intensive_unit_stay") > 0)


def died() -> Column:
    return flag(F.col("outcome") == "EXPIRY")


def heart_disease() -> Column:
    return any_positive(HEART_CONDITIONS)


def lung_disease() -> Column:
    return any_positive(LUNG_CONDITIONS)


def condition_total() -> Column:
    """Number of conditions a patient has; NULL if any of the flags is NULL."""
    return F.expr(" + ".join(CONDITIONS))


def risk(total: Column) -> Column:
    """Level by number of conditions, smoking and alcohol.

    The first matching level counts; what none claims (missing flags) is
    ``Unknown``.  ``total`` is a column that holds :func:`condition_total`.
    """
    smokes, drinks = F.col("smoking_") == 1, F.col("alcohol") == 1
    clean = (F.col("smoking_") == 0) & (F.col("alcohol") == 0) & (total == 0)
    return (
        F.when(smokes & drinks & (total >= 2), "Critical")
        .when((smokes | drinks) & (total >= 2), "Very High")
        .when(total > 2, "High")
        .when(smokes | drinks | (total > 0), "Medium")
        .when(clean, "Low")
        .otherwise("Unknown")
    )


def full_coverage() -> Column:
    """1 if a plan has all six covers, else 0."""
    return F.expr(" AND ".join(COVERS)).cast("int")


def branch_id(hosp_id: Column) -> Column:
    """``BR-0`` and the last four characters of the hospital id."""
    return F.concat(F.lit("BR-0"), F.right(hosp_id, F.lit(4)))


def branch_tier(
    age: Column,
    admissions: Column,
    *,
    top_age: int = 50,
    top_admissions: int = 1000,
    mid_age: int = 40,
    mid_admissions: int = 500,
) -> Column:
    """Tier by mean age or admissions; bands are whole numbers, so 49.5 is in neither."""
    return (
        F.when((age >= top_age) | (admissions >= top_admissions), "Tier 1")
        .when(
            age.between(mid_age, top_age - 1)
            | admissions.between(mid_admissions, top_admissions - 1),
            "Tier 2",
        )
        .otherwise("Tier 3")
    )


def age_group(age: Column) -> Column:
    """``Under30``, then bands of five years up to 59; NULL from 60 and for unknown ages."""
    bands = F.when(age < 30, "Under30")
    for low in range(30, 60, 5):
        bands = bands.when((age >= low) & (age < low + 5), f"{low}-{low + 5}")
    return bands


def most_common_condition(diabetes: Column, hypertension: Column, cad: Column) -> Column:
    """Largest count; ties go to diabetes, then cad, then hypertension."""
    top = F.greatest(diabetes, hypertension, cad)
    return F.when(diabetes == top, "diabetes").when(cad == top, "cad").otherwise("hypertension")


def mode_of(counts: dict[str, Column]) -> Column:
    """Most frequent of a fixed set of values given their counts.

    Equal counts are settled by the smaller value; NULL if nothing was counted.
    """
    best, label = None, None
    for value in sorted(counts):
        count = F.coalesce(counts[value], F.lit(0))
        if best is None:
            best, label = count, F.when(count > 0, value)
        else:
            label = F.when(count > best, value).otherwise(label)
            best = F.greatest(best, count)
    return label
