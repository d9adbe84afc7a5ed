"""Small random tables with what real ones bring along: NULLs, copies, shared names."""

from __future__ import annotations

import datetime as dt
import random

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from carelake import schemas
from carelake.tables import CareTables

SCHEMAS = {**schemas.BATCH, "patient_device_stream": schemas.READINGS}


def _maybe(rng: random.Random, value, chance: float = 0.1):
    return None if rng.random() < chance else value


def _date_text(rng: random.Random, first: int, last: int) -> str:
    day = dt.date(rng.randint(first, last), rng.randint(1, 12), rng.randint(1, 28))
    return rng.choice(
        [f"{day.month}/{day.day}/{day.year}", day.strftime("%m/%d/%Y"), day.strftime("%d-%m-%Y")]
    )


def _with_copies(rng: random.Random, rows: list[tuple]) -> list[tuple]:
    return rows + [row for row in rows if rng.random() < 0.15]


def messy_rows(seed: int) -> dict[str, list[tuple]]:
    rng = random.Random(seed)
    patients = [f"P{i:03d}" for i in range(12)]
    # The first patient and the first hospital hold about a third of everything.
    hot = lambda keys: keys[0] if rng.random() < 0.33 else rng.choice(keys)
    hospital_ids = [f"H{i:06d}" for i in range(6)]
    plan_ids = [f"PLAN-{i}" for i in range(5)]
    beds = lambda: _maybe(rng, rng.randint(0, 6))
    hospitals = [
        (
            _maybe(rng, h), rng.choice(["North", "South", "West"]),
            _maybe(rng, rng.choice(["Public/Government", "Private"])), rng.choice("AB"),
            rng.choice(["x", "y", None]), rng.randint(1, 50), beds(), beds(), beds(), beds(),
            beds(), beds(),
        )
        for h in hospital_ids + hospital_ids[:2]
    ]
    admissions = [
        (
            _maybe(rng, rng.randint(1, 60)), _maybe(rng, hot(patients + ["P999"])),
            _maybe(rng, hot(hospital_ids + ["H999999"])), _maybe(rng, _date_text(rng, 1995, 1997)),
            _maybe(rng, rng.randint(0, 9)), _maybe(rng, rng.randint(0, 5)),
            rng.choice(["E", "O", None]), rng.choice(["DISCHARGE", "EXPIRY", "OTHER", None]),
        )
        for _ in range(80)
    ]
    people = [
        (_maybe(rng, p, 0.05), rng.choice(["Ann", "Bo", "Cy", "Di"]),
         _maybe(rng, _date_text(rng, 1935, 1990)))
        for p in patients + patients[:3]
    ]
    flags = len(schemas.PATIENT_HISTORY) - 1
    history = [
        (p, *(_maybe(rng, int(rng.random() < 0.2), 0.01) for _ in range(flags)))
        for p in patients[:-1] + patients[:2]
    ]
    plans = [
        (_maybe(rng, p, 0.05), rng.choice(["Gold", "Silver", None]),
         *(_maybe(rng, rng.random() < 0.9, 0.03) for _ in range(6)))
        for p in plan_ids + plan_ids[:1]
    ]
    start = lambda: dt.date(1995, rng.randint(1, 12), rng.randint(1, 6))
    policies = [
        (
            f"POL{rng.randint(1, 30)}", _maybe(rng, hot(patients)),
            _maybe(rng, hot([*plan_ids, "PLAN-9"]), 0.05), start(),
            _maybe(rng, start() + dt.timedelta(days=rng.choice([90, 300, 700]))),
            rng.randint(100, 999) / 4, float(rng.randint(1, 9) * 1000),
        )
        for _ in range(45)
    ]
    readings = [
        (_maybe(rng, hot(patients)), _maybe(rng, float(rng.randint(50, 220)))) for _ in range(60)
    ]
    tables = dict(
        zip(SCHEMAS, (hospitals, admissions, people, history, plans, policies, readings),
            strict=True)
    )
    return {name: _with_copies(rng, rows) for name, rows in tables.items()}


def spark_tables(spark: SparkSession, rows: dict[str, list[tuple]]) -> CareTables:
    def frame(name: str) -> DataFrame:
        return spark.createDataFrame(rows[name], SCHEMAS[name])

    return CareTables(**{name: frame(name) for name in SCHEMAS})


def duck_tables(rows: dict[str, list[tuple]]) -> tuple[duckdb.DuckDBPyConnection, frozenset[str]]:
    """The raw tables under the names the statements use, and those names."""
    con = duckdb.connect()
    kinds = {"string": "VARCHAR"}
    names = []
    for name, schema in SCHEMAS.items():
        target = "readings" if name == "patient_device_stream" else f"{name}_raw"
        columns = ", ".join(
            f"{f.name} {kinds.get(f.dataType.simpleString(), f.dataType.simpleString())}"
            for f in schema
        )
        con.execute(f"CREATE TABLE {target} ({columns})")
        frame = pd.DataFrame(rows[name], columns=schema.names, dtype=object)
        marks = ", ".join("?" for _ in schema)
        con.executemany(f"INSERT INTO {target} VALUES ({marks})", frame.values.tolist())
        names.append(target)
    return con, frozenset(names)
