"""Expectations: named SQL predicates that warn or drop, with counted failures.

A predicate that is NULL for a row counts as failed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    drop: bool = False

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


HOSPITAL_HAS_ID = Expectation("valid hosp_id", "hosp_id IS NOT NULL", drop=True)
ADMISSION_DATE_READABLE = Expectation(
    "readable d_o_a", "d_o_a IS NULL OR try_to_date(d_o_a, 'dd-MM-yyyy') IS NOT NULL"
)
BIRTH_DATE_READABLE = Expectation(
    "readable dob", "dob IS NULL OR try_to_date(dob, 'dd-MM-yyyy') IS NOT NULL"
)
HEART_RATE_VALID = Expectation("heart_rate_valid", "heart_rate_per_minute < 190")


def _failed_counts(expectations: tuple[Expectation, ...]) -> list[Column]:
    return [F.count_if(~e.holds()).alias(e.name) for e in expectations]


def observed(df: DataFrame, *expectations: Expectation, observe_as: Observation | str) -> DataFrame:
    """The same rows; how many there are and fail each expectation is counted on the way."""
    return df.observe(observe_as, F.count(F.lit(1)).alias("rows"), *_failed_counts(expectations))


def enforce(
    df: DataFrame, *expectations: Expectation, observe_as: Observation | str | None = None
) -> DataFrame:
    """Drop the rows that fail a dropping expectation.

    With ``observe_as`` the failures are counted on the way, in the same pass:
    an ``Observation`` for a batch job, a name for a stream's progress report.
    """
    if observe_as is not None:
        df = observed(df, *expectations, observe_as=observe_as)
    for expectation in expectations:
        if expectation.drop:
            df = df.filter(expectation.holds())
    return df


def counted(observation: Observation, *expectations: Expectation) -> list[tuple[str, str, int, int]]:
    """``expectation, action, failed, total`` of a pass that :func:`enforce` has observed."""
    seen = observation.get
    return [
        (e.name, "drop" if e.drop else "warn", seen.get(e.name, 0), seen.get("rows", 0)) for e in expectations
    ]


def violations(df: DataFrame, *expectations: Expectation) -> DataFrame:
    """One row per expectation: name, action, rows failed and rows seen, in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *_failed_counts(expectations))
    report = F.array(
        *(
            F.struct(
                F.lit(e.name).alias("expectation"),
                F.lit("drop" if e.drop else "warn").alias("action"),
                F.col(f"`{e.name}`").alias("failed"),
                F.col("rows").alias("total"),
            )
            for e in expectations
        )
    )
    return counts.select(F.inline(report))
