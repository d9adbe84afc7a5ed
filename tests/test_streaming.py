"""Streams against the batch result, and restarts."""

import datetime as dt
import os

from carelake import schemas
from carelake.functions import naming
from carelake.operators.cleaning import clean_tables
from carelake.plans import facts
from carelake.sources import files, layers
from carelake.streaming import readings
from carelake.streaming.sums import Sums
from tests.messy import messy_rows, spark_tables

HEADERS = ("Patient ID", " Heart Rate (per minute) ")
AS_OF = dt.date(2002, 1, 1)


def write_readings(spark, folder, rows):
    df = spark.createDataFrame(rows, schemas.READINGS).toDF(*HEADERS)
    df.coalesce(1).write.mode("append").parquet(str(folder))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


FIRST = [("P1", 70.0), ("P1", 201.0), ("P2", None), (None, 80.0)]
SECOND = [("P2", 90.0), ("P1", 71.5)]


def test_run_stream_lands_each_file_once(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    write_readings(spark, source, FIRST)
    write_readings(spark, source, SECOND)
    query = readings.run_stream(spark, str(source), out, files_per_batch=1)
    seen = [p.observedMetrics["readings"] for p in query.recentProgress if p.observedMetrics]
    assert sum(row.rows for row in seen) == 6
    assert sum(row.heart_rate_valid for row in seen) == 2
    landed = layers.landed(spark, out, layers.SILVER, readings.CLEAN)
    assert landed.columns == ["patient_id", "heart_rate_per_minute"]
    assert rows_of(landed) == sorted(FIRST + SECOND, key=repr)

    readings.run_stream(spark, str(source), out)
    landed = layers.landed(spark, out, layers.SILVER, readings.CLEAN)
    assert landed.count() == len(FIRST + SECOND)

    write_readings(spark, source, [("P3", 60.0)])
    readings.run_stream(spark, str(source), out)
    landed = layers.landed(spark, out, layers.SILVER, readings.CLEAN)
    assert rows_of(landed) == sorted([*FIRST, *SECOND, ("P3", 60.0)], key=repr)


def test_schema_is_remembered(spark, tmp_path):
    source, kept = tmp_path / "in", str(tmp_path / "kept")
    write_readings(spark, source, FIRST)
    schema = files.remembered_schema(spark, str(source), kept)
    assert schema.names == list(HEADERS)
    (tmp_path / "empty").mkdir()
    assert files.remembered_schema(spark, str(tmp_path / "empty"), kept) == schema
    assert files.remembered_schema(spark, str(tmp_path / "never"), kept) == schema


def stream_of(spark, source, files_per_batch=None):
    schema = spark.read.parquet(str(source)).schema
    raw = files.stream_parquet(spark, str(source), schema, files_per_batch=files_per_batch)
    return naming.rename(raw, naming.device)


def test_violations_accumulate_over_runs(spark, tmp_path):
    source, kept, check = tmp_path / "in", str(tmp_path / "counts"), str(tmp_path / "check")
    assert rows_of(readings.violation_counts(spark, kept)) == [("heart_rate_valid", "warn", 0, 0)]
    write_readings(spark, source, FIRST)

    def run():
        stream = stream_of(spark, source, files_per_batch=1)
        return rows_of(readings.count_violations(stream, kept, check))

    assert run() == [("heart_rate_valid", "warn", 2, 4)]
    assert run() == [("heart_rate_valid", "warn", 2, 4)]
    write_readings(spark, source, SECOND)
    write_readings(spark, source, FIRST)
    assert run() == [("heart_rate_valid", "warn", 4, 10)]


PATIENTS = [("P1", "Ann", "01-01-1990"), ("P2", "Bo", None), ("P9", "Di", "01-01-1980")]


def people(spark, rows=PATIENTS):
    return spark.createDataFrame(rows, schemas.PATIENTS)


def maintain(spark, source, tmp_path, **options):
    stream = stream_of(spark, source, files_per_batch=1)
    readings.maintain_heart_rates(stream, str(tmp_path / "sums"), str(tmp_path / "check"), **options)
    return readings.live_summary(spark, str(tmp_path / "sums"))


def test_live_heart_rates_equal_batch(spark, tmp_path):
    source = tmp_path / "in"
    assert readings.live_summary(spark, str(tmp_path / "sums")).collect() == []
    write_readings(spark, source, FIRST)
    write_readings(spark, source, SECOND)

    def run():
        summary = maintain(spark, source, tmp_path)
        return rows_of(readings.heart_rates(summary, people(spark), as_of=AS_OF))

    expected = [("P1", 12, 3, 114.0), ("P2", None, 2, 90.0)]
    assert run() == expected
    assert run() == expected
    write_readings(spark, source, [("P1", 0.5)] * 3)
    assert run() == [("P1", 12, 6, 57.0), ("P2", None, 2, 90.0)]


def test_birthdays_and_patients_known_later_lose_no_reading(spark, tmp_path):
    source = tmp_path / "in"
    write_readings(spark, source, [("P1", 60.0), ("P1", 120.0), ("P7", 50.0)])
    summary = maintain(spark, source, tmp_path)
    early = readings.heart_rates(summary, people(spark), as_of=dt.date(2001, 6, 1))
    assert rows_of(early) == [("P1", 11, 2, 90.0)]
    write_readings(spark, source, [("P1", 100.0)] * 3 + [("P7", 70.0)])
    summary = maintain(spark, source, tmp_path)
    later = people(spark, [*PATIENTS, ("P7", "Ed", "01-01-2000")])
    rates = readings.heart_rates(summary, later, as_of=dt.date(2002, 6, 1))
    assert rows_of(rates) == [("P1", 12, 5, 96.0), ("P7", 2, 2, 60.0)]


def test_a_crash_between_write_and_publish_changes_nothing(spark, tmp_path):
    schema = "k string, n bigint"
    sums = Sums(spark, str(tmp_path / "sums"), schema, ["k"])
    for i in range(3):
        sums.store(spark.createDataFrame([("a", 1), ("b", i)], schema), i)
    expected = [("a", 3), ("b", 3)]
    assert rows_of(sums.read()) == expected
    # A merge that wrote its folder but was stopped before it was finished.
    spark.createDataFrame([("a", 99)], schema).write.parquet(f"{tmp_path}/sums/upto=2")
    os.remove(f"{tmp_path}/sums/upto=2/_SUCCESS")
    assert rows_of(sums.read()) == expected
    # A batch that was written in part, and is then repeated.
    spark.createDataFrame([("a", 50)], schema).write.parquet(f"{tmp_path}/sums/batch=3")
    os.remove(f"{tmp_path}/sums/batch=3/_SUCCESS")
    assert rows_of(sums.read()) == expected
    sums.store(spark.createDataFrame([("a", 1)], schema), 3)
    assert rows_of(sums.read()) == [("a", 4), ("b", 3)]
    # A merge that was finished, but stopped before it removed the batches.
    kept = {f"{tmp_path}/sums/batch={i}" for i in range(4)}
    copies = {f: spark.read.parquet(f).collect() for f in kept}
    sums.merge()
    for folder, rows in copies.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(folder)
    assert rows_of(sums.read()) == [("a", 4), ("b", 3)]
    # The last batch is repeated after a restart: it is covered, so it counts once.
    sums.store(spark.createDataFrame([("a", 1)], schema), 3)
    assert rows_of(sums.read()) == [("a", 4), ("b", 3)]


def test_the_number_of_folders_is_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("carelake.streaming.sums.BATCHES", 3)
    sums = Sums(spark, str(tmp_path / "sums"), "k string, n bigint", ["k"])
    for i in range(9):
        sums.store(spark.createDataFrame([("a", 1)], "k string, n bigint"), i)
        assert len(os.listdir(tmp_path / "sums")) <= 5
    assert rows_of(sums.read()) == [("a", 9)]


def test_joined_readings_are_landed_once(spark, tmp_path):
    source, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    write_readings(spark, source, FIRST)

    def run():
        joined = readings.with_patients(stream_of(spark, source), people(spark))
        readings.land(joined, out, check)
        return rows_of(spark.read.parquet(out).select("patient_id", "heart_rate_per_minute", "full_name"))

    expected = [("P1", 201.0, "Ann"), ("P1", 70.0, "Ann"), ("P2", None, "Bo")]
    assert run() == sorted(expected, key=repr)
    write_readings(spark, source, [("P9", 61.0), ("P8", 1.0)])
    assert run() == sorted([*expected, ("P9", 61.0, "Di")], key=repr)
    assert len(run()) == 4


def test_a_running_query_may_keep_running(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    write_readings(spark, source, FIRST)
    query = readings.land(
        stream_of(spark, source), out, str(tmp_path / "check"), trigger={"processingTime": "1 second"}
    )
    assert query.isActive
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(out).count() == len(FIRST)


def test_live_summary_feeds_patient_facts(spark, tmp_path):
    rows = messy_rows(5)
    t = clean_tables(spark_tables(spark, rows))
    source = tmp_path / "in"
    write_readings(spark, source, rows["patient_device_stream"][:20])
    write_readings(spark, source, rows["patient_device_stream"][20:])
    live = maintain(spark, source, tmp_path)
    direct = facts.patient_facts(t, as_of=AS_OF)
    from_stream = facts.patient_facts(t, as_of=AS_OF, readings=live)
    assert direct.count() > 0
    assert rows_of(from_stream) == rows_of(direct)
