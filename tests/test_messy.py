"""Every job over the clean tables against the direct joins, on tables with copies and NULLs."""

import pytest

from carelake import catalog, oracle
from carelake.operators.cleaning import clean_tables
from tests.compare import compare
from tests.messy import duck_tables, messy_rows, spark_tables

JOBS = [
    name
    for name in catalog.QUERIES
    if name.startswith(("q1", "q2", "q3", "q4", "q5", "q6", "q7", "mode_", "i0", "i1", "i2", "feature_", "hospital_facts", "patient_facts",
                        "policy_holders"))
]


@pytest.mark.parametrize("seed", [1, 2])
def test_jobs_equal_direct_joins(spark, monkeypatch, seed):
    rows = messy_rows(seed)
    con, given = duck_tables(rows)
    raw = spark_tables(spark, rows)
    monkeypatch.setattr(catalog.Star, "tables", lambda *_, **__: raw)
    wrong = {}
    for name in JOBS:
        df = catalog.QUERIES[name](spark, "")
        _, problems = compare(df, con, oracle.with_tables(oracle.BODIES[name], given))
        if problems:
            wrong[name] = problems
    assert not wrong, "\n".join(f"{name}: {problems}" for name, problems in wrong.items())


def test_clean_tables_keep_the_other_tables(spark):
    raw = spark_tables(spark, messy_rows(4))
    clean = clean_tables(raw)
    assert clean.plans is raw.plans and clean.policies_new is raw.policies_new
    assert clean.patients.count() == raw.patients.distinct().count()
