"""Documented columns of the seven inputs, by normalised name.

Only the columns the jobs use are listed.  ``typed`` casts those it finds by
name, so column order and further columns of a file do not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from carelake.functions.features import CONDITIONS, COVERS, LUNG_CONDITIONS


def _schema(*columns: tuple[str, DataType]) -> StructType:
    """One field per name; a name text lists several columns of one type."""
    return StructType(
        [StructField(name, kind) for names, kind in columns for name in names.split()]
    )


TEXT, INT, LONG, DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()

HOSPITALS = _schema(
    ("hosp_id name sector state location", TEXT),
    ("num_licensed_beds num_staffed_beds num_icu_beds adult_icu_beds pedi_icu_beds", INT),
    ("ventilators_available surgery_theatres", INT),
)
NEW_ADMISSIONS = _schema(
    ("admission_id", LONG),
    ("patient_id hospital_id d_o_a", TEXT),
    ("duration_of_stay duration_of_intensive_unit_stay", INT),
    ("type_of_admission_emergency_or_opd outcome", TEXT),
)
PATIENTS = _schema(("patient_id full_name dob", TEXT))
PATIENT_HISTORY = _schema(
    ("patient_id", TEXT), (" ".join(CONDITIONS + LUNG_CONDITIONS), INT)
)
PLANS = _schema(("plan_id payment_type", TEXT), (" ".join(COVERS), BooleanType()))
POLICIES_NEW = _schema(
    ("policy_number patient_id plan_id", TEXT),
    ("policy_start_date policy_end_date", DateType()),
    ("daily_premium insurance_coverage", DOUBLE),
)
READINGS = _schema(("patient_id", TEXT), ("heart_rate_per_minute", DOUBLE))

BATCH = {
    "hospitals": HOSPITALS,
    "new_admissions": NEW_ADMISSIONS,
    "patients": PATIENTS,
    "patient_history": PATIENT_HISTORY,
    "plans": PLANS,
    "policies_new": POLICIES_NEW,
}


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast the columns named in ``schema``; a value that does not fit raises under ANSI."""
    wanted = {field.name: field.dataType for field in schema}
    missing = [name for name in wanted if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df.select(
        *(F.col(c).cast(wanted[c]).alias(c) if c in wanted else F.col(c) for c in df.columns)
    )
