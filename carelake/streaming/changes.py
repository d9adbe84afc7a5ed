"""Changes of tables: rows that come (+1) or are taken back (-1).

A changed row is the old one with -1 and the new one with +1.  Anything that is
added up over rows then follows a change by adding the signed rows, in any order
and however they are split into batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.sources.layers import Layer

CHANGE = "change"


def as_changes(rows: DataFrame) -> DataFrame:
    """Rows without a ``change`` are new ones."""
    return rows if CHANGE in rows.columns else rows.withColumn(CHANGE, F.lit(1))


def difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """The signed rows that lead from one state of a table to another.

    A row that both have equally often is left out; one that is n times more
    often in ``after`` has the change n.
    """
    signed = after.withColumn(CHANGE, F.lit(1)).unionByName(before.withColumn(CHANGE, F.lit(-1)))
    return signed.groupBy(*before.columns).agg(F.sum(CHANGE).cast("int").alias(CHANGE)).where(F.col(CHANGE) != 0)


def between(older: Layer, newer: Layer, dataset: str) -> DataFrame:
    """What a dataset's versions differ in; nothing is read if both name the same files."""
    if dataset in older.datasets and older.datasets[dataset] == newer.datasets[dataset]:
        return older.read(dataset).limit(0).withColumn(CHANGE, F.lit(1))
    after = newer.read(dataset)
    before = older.read(dataset) if dataset in older.datasets else after.limit(0)
    return difference(before, after)
