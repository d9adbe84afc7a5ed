"""Device readings: landing, joining, counting violations and live heart rates.

By default all jobs work off what has arrived and stop (``availableNow``); run
again with the same checkpoint they take up only new files.  ``trigger`` takes
the keywords of ``DataStreamWriter.trigger`` for a job that keeps running; then
the started query is returned and not waited for.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from carelake.functions import naming
from carelake.functions.dates import age_in_365_days
from carelake.operators import history
from carelake.operators.quality import (
    HEART_RATE_VALID,
    Expectation,
    counted,
    enforce,
    observed,
    violations,
)
from carelake.operators.summaries import ratio, steady_round
from carelake.plans.facts import reading_summary
from carelake.sources import growing, layers
from carelake.streaming.sums import Sums

Trigger = dict[str, object]


def _run(writer: DataStreamWriter, trigger: Trigger | None) -> StreamingQuery:
    query = writer.trigger(**(trigger or {"availableNow": True})).start()
    if trigger is None or "availableNow" in trigger or "once" in trigger:
        query.awaitTermination()
    return query


def land(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    *,
    quality: bool = False,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Append the stream to a Parquet table, each input file exactly once.

    With ``quality`` the expectation's failures appear in the progress reports
    of the returned query under ``readings``; the rows stay.
    """
    if quality:
        stream = enforce(stream, HEART_RATE_VALID, observe_as="readings")
    writer = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return _run(writer, trigger)


def with_patients(stream: DataFrame, patients: DataFrame) -> DataFrame:
    """Each reading with its patient's name and date of birth; unknown patients' are left out.

    The join keeps no state: a micro-batch meets the patients as they are then.
    """
    return stream.join(patients.select("patient_id", "full_name", "dob"), "patient_id")


def _violation_sums(spark: SparkSession, target: str) -> Sums:
    schema = "expectation string, action string, failed bigint, total bigint"
    return Sums(spark, target, schema, ["expectation", "action"])


def _store(stream: DataFrame, sums: Sums, reduce, checkpoint: str, trigger: Trigger | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(
        lambda batch, batch_id: sums.store(reduce(batch), batch_id)
    ).option("checkpointLocation", checkpoint)
    query = _run(writer, trigger)
    if not query.isActive:
        sums.merge()
    return query


def count_violations(
    stream: DataFrame, target: str, checkpoint: str, *, trigger: Trigger | None = None
) -> DataFrame:
    """Violation counts over all that has ever arrived; they are kept below ``target``."""
    sums = _violation_sums(stream.sparkSession, target)
    _store(stream, sums, lambda batch: violations(batch, HEART_RATE_VALID), checkpoint, trigger)
    return violation_counts(stream.sparkSession, target)


def violation_counts(spark: SparkSession, target: str) -> DataFrame:
    """The counts kept so far; an expectation that nothing has met yet has zeros."""
    sums = _violation_sums(spark, target)
    nothing = [(HEART_RATE_VALID.name, "drop" if HEART_RATE_VALID.drop else "warn", 0, 0)]
    rows = sums.read().union(spark.createDataFrame(nothing, sums.schema))
    return rows.groupBy("expectation", "action").agg(
        F.sum("failed").alias("failed"), F.sum("total").alias("total")
    )


def _rate_sums(spark: SparkSession, target: str) -> Sums:
    schema = "patient_id string, readings bigint, rated bigint, rate_sum double"
    return Sums(spark, target, schema, ["patient_id"])


def maintain_heart_rates(
    stream: DataFrame, target: str, checkpoint: str, *, trigger: Trigger | None = None
) -> StreamingQuery:
    """Reduce each micro-batch to one row per patient and keep the sums below ``target``.

    Nothing of the patients enters the sums, so readings of a patient who becomes
    known later count, and an age is that of the day the sums are read.
    """
    sums = _rate_sums(stream.sparkSession, target)
    return _store(stream, sums, reading_summary, checkpoint, trigger)


def live_summary(spark: SparkSession, target: str) -> DataFrame:
    """The kept sums per patient: a reading summary that ``patient_facts`` takes."""
    return _rate_sums(spark, target).read()


def heart_rates(
    summary: DataFrame, patients: DataFrame, *, as_of: dt.date | None = None
) -> DataFrame:
    """Readings and mean heart rate of the patients known now, at their age now."""
    people = patients.select(
        "patient_id", age_in_365_days(F.col("dob"), as_of).alias("age_of_patient")
    ).distinct()
    return summary.join(people, "patient_id").select(
        "patient_id",
        "age_of_patient",
        "readings",
        steady_round(ratio("rate_sum", "rated")).alias("avg_heart_rate"),
    )


RAW, CLEAN = "patient_device_stream_raw", "patient_device_stream_clean"
#: Files that one micro-batch takes at most, where nothing else is said.
FILES = 1000


def land_growing(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    layer: str,
    name: str,
    checkpoint: str,
    *,
    rule: naming.Rule,
    files_per_batch: int = FILES,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Append the files below ``in_dir`` to a dataset whose schema grows with them.

    The stream is one of files: each micro-batch takes some, groups them by
    layout, names their columns by ``rule``, merges the layouts into the
    dataset's schema, and writes the rows to a folder of its own.  A micro-batch
    that is repeated writes the same folder again, so each file counts once.
    """
    target = layers.location(out_dir, layer, name)
    log = layers.schema_log(spark, out_dir, layer, name)

    def append(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.orderBy("modificationTime", "path").collect()]
        groups = [
            naming.rename(spark.read.schema(schema).parquet(*files), rule)
            for schema, files in growing.layouts(spark, paths, rule)
        ]
        for rows in groups:
            schema = log.grow(rows.schema)
        merged = reduce(DataFrame.unionAll, (growing.fitted(rows, schema) for rows in groups))
        merged.write.mode("overwrite").parquet(f"{target}/batch-{batch_id:09d}")

    # Of the files, only names and times are read here.
    listed = (
        spark.readStream.format("binaryFile").option("maxFilesPerTrigger", files_per_batch)
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.parquet").load(in_dir).select("path", "modificationTime")
    )
    writer = listed.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return _run(writer, trigger)


def land_checked(
    stream: DataFrame,
    out_dir: str,
    layer: str,
    name: str,
    checkpoint: str,
    *expectations: Expectation,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Append the stream to a dataset and keep what each micro-batch failed, counted in the same pass.

    A micro-batch writes its rows and then its results to folders of its own, so
    one that is repeated counts once.
    """
    spark, target = stream.sparkSession, layers.location(out_dir, layer, name)

    def append(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        rows = enforce(batch, *expectations, observe_as=seen)
        rows.write.mode("overwrite").parquet(f"{target}/batch-{batch_id:09d}")
        history.keep_batch(spark, out_dir, layer, name, batch_id, counted(seen, *expectations))

    # Observed here as well, for the progress reports.
    writer = observed(stream, *expectations, observe_as="readings").writeStream.foreachBatch(append)
    return _run(writer.option("checkpointLocation", checkpoint), trigger)


def run_stream(
    spark: SparkSession, in_dir: str, out_dir: str, *, files_per_batch: int = FILES
) -> StreamingQuery:
    """Take new device files into bronze (names normalised) and on into silver.

    Both tables take on columns and wider types as files bring them.  Returns
    the finished silver query, whose progress holds the violation counts.
    """
    work = f"{out_dir}/_stream"
    land_growing(
        spark, in_dir, out_dir, layers.BRONZE, RAW, f"{work}/{RAW}",
        rule=naming.device, files_per_batch=files_per_batch,
    )
    raw = layers.stream_dataset(spark, out_dir, layers.BRONZE, RAW)
    layers.schema_log(spark, out_dir, layers.SILVER, CLEAN).grow(raw.schema)
    query = land_checked(raw, out_dir, layers.SILVER, CLEAN, f"{work}/{CLEAN}", HEART_RATE_VALID)
    layers.compact(spark, out_dir, layers.SILVER, CLEAN)
    return query
