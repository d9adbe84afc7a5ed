"""Names, dates, ages and features, row by row."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from carelake.functions import dates, features, naming


@pytest.mark.parametrize(
    ("rule", "header", "name"),
    [
        (naming.basic, "SMOKING ", "smoking_"),
        (naming.basic, "Patient ID", "patient_id"),
        (naming.admissions, "TYPE OF ADMISSION-EMERGENCY/OPD", "type_of_admission_emergency_or_opd"),
        (naming.admissions, "D.O.A", "d_o_a"),
        (naming.device, " Heart Rate (per minute) ", "heart_rate_per_minute"),
        (naming.device, "a___b", "a__b"),
        (naming.device, "x (y), z", "x_y__z"),
        (naming.device, "rate__", "rate"),
    ],
)
def test_naming_rules(rule, header, name):
    assert rule(header) == name


def test_rename_refuses_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a_B` int")
    with pytest.raises(ValueError, match="a_b"):
        naming.rename(df, naming.basic)


def column(spark, values, build, kind="string"):
    """The built column for each value, in the order given."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_day_first_text(spark):
    cases = {
        "4/1/2017": "01-04-2017",
        "04/01/2017": "01-04-2017",
        "12/25/2017": "25-12-2017",
        "13-04-2017": "13-04-2017",
        "12/25/17": "25-12-17",
        "12/25": None,
        None: None,
    }
    texts = column(spark, cases, dates.day_first_text)
    assert texts == list(cases.values())
    parsed = column(spark, cases, lambda v: dates.parse_day(dates.day_first_text(v)))
    april, christmas = dt.date(2017, 4, 1), dt.date(2017, 12, 25)
    assert parsed == [april, april, christmas, dt.date(2017, 4, 13), None, None, None]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.dates(dt.date(1000, 1, 1), dt.date(9999, 12, 31)), min_size=50, max_size=80))
def test_every_spelling_parses(spark, days):
    spellings = [
        text
        for d in days
        for text in (
            f"{d.month}/{d.day}/{d.year}",
            f"{d.month:02}/{d.day:02}/{d.year}",
            f"{d.day:02}-{d.month:02}-{d.year}",
        )
    ]
    parsed = column(spark, spellings, lambda v: dates.parse_day(dates.day_first_text(v)))
    assert parsed == [d for d in days for _ in range(3)]


def test_three_ages(spark):
    as_of = dt.date(2020, 1, 1)
    born = ["31-12-1990", None, "31-02-1990"]
    assert column(spark, born, lambda v: dates.age_by_calendar_year(v, as_of)) == [30, None, None]
    assert column(spark, born, lambda v: dates.age_in_full_years(v, as_of)) == [29, None, None]
    assert column(spark, born, lambda v: dates.age_in_365_days(v, as_of)) == [29, None, None]


def test_age_defaults_to_today(spark):
    today = column(spark, ["01-01-2000"], dates.age_by_calendar_year)[0]
    assert today in (dt.date.today().year - 2000, dt.date.today().year - 2001)


def test_branch_id(spark):
    ids = {"HSP-00123": "BR-00123", "H12": "BR-0H12", None: None}
    assert column(spark, ids, features.branch_id) == list(ids.values())


def test_age_groups(spark):
    ages = {29: "Under30", 30: "30-35", 34: "30-35", 35: "35-40", 59: "55-60", 60: None, None: None}
    assert column(spark, ages, features.age_group, "int") == list(ages.values())


def test_branch_tier(spark):
    cases = [(50.0, 0, 1), (0.0, 1000, 1), (40.0, 0, 2), (49.0, 0, 2), (49.5, 10, 3),
             (0.0, 500, 2), (49.5, 999, 2), (0.0, 499, 3)]
    df = spark.createDataFrame(cases, "age double, n bigint, tier int")
    tiers = df.select("tier", features.branch_tier(F.col("age"), F.col("n")).alias("got")).collect()
    assert [row.got for row in tiers] == [f"Tier {row.tier}" for row in tiers]


@pytest.mark.parametrize(
    ("tot", "smoking", "alcohol", "level"),
    [
        (2, 1, 1, "Critical"), (2, 1, 0, "Very High"), (5, 0, 1, "Very High"), (3, 0, 0, "High"),
        (2, 0, 0, "Medium"), (0, 1, 1, "Medium"), (1, 0, 0, "Medium"), (0, 0, 0, "Low"),
        (None, 0, 0, "Unknown"), (0, None, 0, "Unknown"), (None, 1, 0, "Medium"),
        (3, None, None, "High"), (2, None, 1, "Very High"),
    ],
)
def test_risk(spark, tot, smoking, alcohol, level):
    df = spark.createDataFrame([(tot, smoking, alcohol)], "tot int, smoking_ int, alcohol int")
    assert df.select(features.risk(F.col("tot"))).first()[0] == level


def test_risk_is_total(spark):
    values = [None, 0, 1, 2, 3]
    rows = [(t, s, a) for t in values for s in (None, 0, 1) for a in (None, 0, 1)]
    df = spark.createDataFrame(rows, "tot int, smoking_ int, alcohol int")
    levels = {row[0] for row in df.select(features.risk(F.col("tot"))).collect()}
    assert levels == set(features.RISK_LEVELS)


def test_disease_flags_pass_over_null(spark):
    names = features.HEART_CONDITIONS
    schema = ", ".join(f"{n} int" for n in names)
    rows = [(None,) * len(names), (0,) * len(names), (None,) * (len(names) - 1) + (1,)]
    df = spark.createDataFrame(rows, schema)
    assert [row[0] for row in df.select(features.heart_disease()).collect()] == [0, 0, 1]


def test_condition_total_and_coverage_keep_null(spark):
    flags = features.CONDITIONS
    df = spark.createDataFrame(
        [(1,) * len(flags), (None,) + (1,) * (len(flags) - 1)], ", ".join(f"{f} int" for f in flags)
    )
    assert [r[0] for r in df.select(features.condition_total()).collect()] == [21, None]
    plans = spark.createDataFrame(
        [(True,) * 6, (True,) * 5 + (False,), (None,) + (True,) * 5, (None, False) + (True,) * 4],
        ", ".join(f"{c} boolean" for c in features.COVERS),
    )
    assert [r[0] for r in plans.select(features.full_coverage()).collect()] == [1, 0, None, 0]


def test_most_common_condition_ties(spark):
    rows = [(1, 1, 1), (0, 1, 1), (0, 2, 1), (0, 0, 0)]
    df = spark.createDataFrame(rows, "d int, h int, c int")
    got = df.select(features.most_common_condition(F.col("d"), F.col("h"), F.col("c"))).collect()
    assert [row[0] for row in got] == ["diabetes", "cad", "hypertension", "diabetes"]


def test_mode_of_ties_and_nothing(spark):
    df = spark.createDataFrame([(2, 2), (1, 2), (2, 1), (0, 0), (None, 1)], "b int, a int")
    got = df.select(features.mode_of({"b": F.col("b"), "a": F.col("a")})).collect()
    assert [row[0] for row in got] == ["a", "a", "b", None, "a"]
