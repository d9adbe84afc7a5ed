"""Reading CSV, Parquet and file streams; registering views; listing inputs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from carelake.functions.naming import Rule, rename
from carelake.schemas import typed
from carelake.sources.filesystem import FileSystem
from carelake.tables import NAMES, CareTables


def read_csv(
    spark: SparkSession,
    path: str,
    *,
    rule: Rule | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """CSV with a header line, names normalised by ``rule``.

    Without a schema the types are inferred, which reads the whole input an
    extra time.  With one, values are read as text and the schema's columns are
    cast by their normalised names, so only the header is read ahead.
    """
    df = spark.read.csv(path, header=True, inferSchema=schema is None)
    if rule is not None:
        df = rename(df, rule)
    return df if schema is None else typed(df, schema)


def read_csv_files(spark: SparkSession, paths: list[str], *, rule: Rule | None = None, schema: StructType) -> DataFrame:
    """Several CSV files as one table, typed by ``schema``; files whose headers differ are an error.

    Read together, Spark would take the other files' columns by their places.
    """
    header = spark.read.csv(paths[0], header=True).schema
    df = spark.read.schema(header).csv(paths, header=True, enforceSchema=False)
    return typed(df if rule is None else rename(df, rule), schema)


def remembered_schema(spark: SparkSession, path: str, location: str) -> StructType:
    """Schema of the Parquet files under ``path``, kept at ``location`` once inferred.

    The first run decides: later ones read the stream with the same schema and
    neither list nor open the directory for it, also when it has become empty since.
    """
    found = FileSystem(spark).entries(location)
    stored = spark.read.text(location).filter("value <> ''").first() if found else None
    if stored is None:
        schema = spark.read.parquet(path).schema
        spark.createDataFrame([(schema.json(),)], "value string").write.mode("overwrite").text(location)
        return schema
    return StructType.fromJson(json.loads(stored["value"]))


def stream_parquet(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Unbounded table over a directory; every file is taken once.

    ``files_per_batch`` bounds a micro-batch where a backlog has to be worked off.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def register_views(tables: CareTables, *names: str) -> None:
    """Make the tables (or those named) available to ``spark.sql`` under their own names."""
    for name in names or NAMES:
        getattr(tables, name).createOrReplaceTempView(name)


def input_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per file below ``path``; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", "modificationTime")
    )
