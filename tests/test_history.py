"""Results of expectations over runs, repeats and crashes."""

import pytest

from carelake import schemas
from carelake.functions import naming
from carelake.operators import history
from carelake.operators.quality import HEART_RATE_VALID, Expectation
from carelake.plans import medallion
from carelake.sources import layers
from carelake.sources.files import stream_parquet
from carelake.streaming import readings
from tests.messy import messy_rows, spark_tables


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def raw_tables(spark, seed):
    return {n: t for n, t in spark_tables(spark, messy_rows(seed)).items() if n in schemas.BATCH}


def test_each_batch_run_adds_its_results(spark, tmp_path, monkeypatch):
    root, raw = str(tmp_path), raw_tables(spark, 6)
    assert history.history(spark, root, layers.SILVER).collect() == []
    expected = []
    for run in (1, 2):
        if run == 2:
            raw["hospitals"] = raw["hospitals"].limit(0)
        _, counts = medallion.refine(raw, root)
        expected.append((run, "valid hosp_id", "drop", counts["valid hosp_id"], counts["rows"]))
        # A run that does not get to its end leaves nothing behind.
        with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="crash"):
            patch.setattr(layers, "publish", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("crash")))
            medallion.refine(raw, root)
    found = history.history(spark, root, layers.SILVER)
    assert found.groupBy("dataset", "run").count().count() == 6
    hospitals = rows_of(found.where("dataset = 'hospitals'").select("run", "expectation", "action", "failed", "total"))
    assert hospitals == expected and expected[1][3:] == (0, 0)
    assert [r.failed_share for r in found.where("dataset = 'hospitals'").orderBy("run").collect()][1] is None


def write_readings(spark, folder, rows):
    df = spark.createDataFrame(rows, schemas.READINGS).toDF("Patient ID", " Heart Rate (per minute) ")
    df.coalesce(1).write.mode("append").parquet(str(folder))


POSITIVE = Expectation("positive", "heart_rate_per_minute > 0", drop=True)


def test_a_streams_results_are_exact_after_a_crash(spark, tmp_path, monkeypatch):
    source, root = tmp_path / "in", str(tmp_path / "out")
    write_readings(spark, source, [("P1", 70.0), ("P1", 201.0), ("P2", None)])
    write_readings(spark, source, [("P1", -1.0), ("P1", 300.0)])

    def land():
        stream = stream_parquet(spark, str(source), spark.read.parquet(str(source)).schema, files_per_batch=1)
        return readings.land_checked(
            naming.rename(stream, naming.device), root, layers.SILVER, readings.CLEAN, str(tmp_path / "check"),
            HEART_RATE_VALID, POSITIVE,
        )

    plain, calls = history.keep_batch, []

    def crashes(*args):
        calls.append(args)
        if len(calls) in (1, 3):
            if len(calls) == 3:
                plain(*args)  # kept, but the stream does not know
            raise RuntimeError("crash")
        plain(*args)

    monkeypatch.setattr(history, "keep_batch", crashes)
    for _ in range(2):
        with pytest.raises(Exception, match="crash"):
            land()
    land()
    found = rows_of(history.history(spark, root, layers.SILVER, [readings.CLEAN]).drop("dataset"))
    assert found == sorted([
        (1, "heart_rate_valid", "warn", 2, 3, 0.6667), (1, "positive", "drop", 1, 3, 0.3333),
        (2, "heart_rate_valid", "warn", 1, 2, 0.5), (2, "positive", "drop", 1, 2, 0.5),
    ])
    landed = layers.landed(spark, root, layers.SILVER, readings.CLEAN)
    assert rows_of(landed) == [("P1", 201.0), ("P1", 300.0), ("P1", 70.0)]
