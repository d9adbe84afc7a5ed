"""Batch inputs taken file by file: a run reads the files that no earlier run has read.

The bronze layer keeps a ledger of the files it was made from.  A run lists the
inputs, leaves out by an anti-join what the ledger has, reads the rest, and
publishes the new rows and the new ledger entries in one version.  A run that
fails anywhere before that has taken nothing, one that finds nothing new changes
nothing, and a file is never counted twice.

Inputs are folders of CSV files, each file complete when it appears and never
changed: one whose size or time is not as in the ledger is an error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake import schemas
from carelake.plans.medallion import HEADER_RULES, about
from carelake.sources import layers
from carelake.sources.files import input_manifest, read_csv_files
from carelake.sources.filesystem import FileSystem

LEDGER = "input_files"
ABOUT_LEDGER = layers.About("Input files that the bronze tables were made from", {"quality": layers.BRONZE})
#: Files of one table that a run takes at most; the oldest first, the rest is left to the next.
FILES = 100_000
_ENTRY = "dataset string, path string, length bigint, modificationTime timestamp"


def listed(spark: SparkSession, in_dir: str, names: tuple[str, ...]) -> DataFrame:
    """``dataset, path, length, modificationTime`` of the files there now; their contents are not read."""
    there = {e.name for e in FileSystem(spark).entries(in_dir)}
    found = [
        input_manifest(spark, f"{in_dir}/{name}.csv").select(F.lit(name).alias("dataset"), "*")
        for name in names
        if f"{name}.csv" in there
    ]
    return reduce(DataFrame.unionAll, found, spark.createDataFrame([], _ENTRY)).where(F.col("length") > 0)


def ledger(bronze: layers.Layer) -> DataFrame:
    """The files that the layer's tables were made from."""
    if LEDGER in bronze.datasets:
        return bronze.read(LEDGER)
    return bronze.spark.createDataFrame([], _ENTRY)


def untaken(files: DataFrame, taken: DataFrame) -> DataFrame:
    """The files that are not in the ledger; ``known_length`` is not null for those that were there otherwise."""
    new = files.join(taken, files.columns, "left_anti")
    known = taken.select("dataset", "path", F.col("length").alias("known_length"))
    return new.join(known, ["dataset", "path"], "left")


def ingest_new(
    spark: SparkSession, in_dir: str, out_dir: str, *, names: tuple[str, ...] = tuple(schemas.BATCH), files: int = FILES
) -> tuple[layers.Layer, int]:
    """Bronze with the rows of files that have arrived since the last run, and how many those are."""
    bronze = layers.opened(spark, out_dir, layers.BRONZE)
    new = untaken(listed(spark, in_dir, names), ledger(bronze))
    paths: dict[str, list] = {}
    for name in names:
        # At most ``files`` names; Spark's reader takes them from the driver.
        mine = new.where(F.col("dataset") == name).orderBy("modificationTime", "path").limit(files).collect()
        if mine:
            paths[name] = mine
    changed = [r["path"] for rows in paths.values() for r in rows if r["known_length"] is not None]
    if changed:
        raise ValueError(f"input files have changed since they were read: {changed[:10]}")
    if not paths:
        return bronze, 0
    frames = {
        f"{name}_raw": read_csv_files(
            spark, [r["path"] for r in rows], rule=HEADER_RULES.get(name), schema=schemas.BATCH[name]
        )
        for name, rows in paths.items()
    }
    entries = [(r["dataset"], r["path"], r["length"], r["modificationTime"]) for rows in paths.values() for r in rows]
    frames[LEDGER] = spark.createDataFrame(entries, _ENTRY)
    told = {**about(layers.BRONZE, [n for n in frames if n != LEDGER]), LEDGER: ABOUT_LEDGER}
    stored = layers.store_all(frames, out_dir, layers.BRONZE, told)
    # Another run that took the same files at the same time must not count as well.
    layer = layers.publish(spark, out_dir, layers.BRONZE, {}, appended=stored, expected=bronze.version)
    return layer, len(entries)
