"""Lasting results of expectations: one row per dataset, run and expectation.

The counts come from the pass that writes the rows.  A batch run publishes them
in the manifest of its tables, so a run that fails leaves no result and one that
is repeated is a run of its own.  A stream's micro-batch writes them to a folder
named after it, after its rows: a repeat writes the same folder again.  So
counts are exact over repeats and crashes.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.operators.summaries import ratio, steady_round
from carelake.sources import layers
from carelake.sources.filesystem import FileSystem

LEDGER = "expectation_results"
ABOUT = layers.About("Rows that failed each expectation, run by run", {"quality": layers.SILVER})
#: ``sequence`` orders a dataset's runs.
_RESULT = "dataset string, sequence bigint, expectation string, action string, failed bigint, total bigint"

Results = list[tuple[str, str, int, int]]


def _frame(spark: SparkSession, results: dict[str, Results], sequence: int) -> DataFrame:
    rows = [(dataset, sequence, *result) for dataset, found in results.items() for result in found]
    return spark.createDataFrame(rows, _RESULT).coalesce(1)


def of_run(spark: SparkSession, root: str, layer: str, results: dict[str, Results]) -> dict[str, layers.Stored]:
    """A batch run's results, stored and still to be published (``appended``) with its tables."""
    frame = _frame(spark, results, time.time_ns())
    return layers.store_all({LEDGER: frame}, root, layer, {LEDGER: ABOUT})


def _folder(root: str, layer: str, name: str) -> str:
    return f"{layers.location(root, layer, name)}/_results"


def keep_batch(spark: SparkSession, root: str, layer: str, name: str, batch_id: int, results: Results) -> None:
    """The results of a stream's micro-batch."""
    frame = _frame(spark, {name: results}, batch_id)
    frame.write.mode("overwrite").parquet(f"{_folder(root, layer, name)}/batch-{batch_id:09d}")


def history(spark: SparkSession, root: str, layer: str, streamed: list[str] | None = None) -> DataFrame:
    """``dataset, run, expectation, action, failed, total, failed_share``; runs are numbered from 1."""
    now = layers.opened(spark, root, layer)
    rows = now.read(LEDGER) if LEDGER in now.datasets else spark.createDataFrame([], _RESULT)
    for name in streamed or []:
        folder, files = _folder(root, layer, name), FileSystem(spark)
        batches = [f"{folder}/{e.name}" for e in files.entries(folder) if files.entries(f"{folder}/{e.name}/_SUCCESS")]
        if batches:
            rows = rows.unionAll(spark.read.schema(_RESULT).parquet(*batches))
    run = F.dense_rank().over(Window.partitionBy("dataset").orderBy("sequence"))
    share = steady_round(ratio("failed", "total"), 4)
    return rows.select("dataset", run.alias("run"), "expectation", "action", "failed", "total", share.alias("failed_share"))
