"""What several operators use: words, written tables, ranks within large groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.sources import scratch

#: ASCII white space: blank, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
BEFORE = (Window.unboundedPreceding, -1)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str, options: dict | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and nothing behind it is kept."""
    spark = df.sparkSession
    folder = scratch.new_folder(spark, purpose)
    df.write.options(**options or {}).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def lower_ascii(text: Column) -> Column:
    """A-Z become a-z; letters outside ASCII stay as they are."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def sample(df: DataFrame, most: int, *key: str) -> DataFrame:
    """At most ``most`` rows: those with the smallest hash of ``key``, then by all columns.

    Rows are counted first, and those whose hash is beyond reach go before the
    sort, so what one task sorts does not grow with the table.
    """
    rows = df.withColumn("_hash", hashed(F.lit("sample"), *key))
    near = 2.0 * most / max(1, df.count())
    kept = rows if near >= 1 else rows.where(F.col("_hash") < near)
    return kept.orderBy("_hash", *df.columns).limit(most).drop("_hash")


def hashed(*columns: Column | str) -> Column:
    """A number in [0, 1) that mixes the columns."""
    return F.xxhash64(*columns).cast("double") / float(2**64) + 0.5


def ranked(
    df: DataFrame, group: list[str], order: list[Column], piece: Column, *,
    weight: Column | None = None, name: str = "rank",
) -> DataFrame:
    """Number the rows of each group from 0 by ``order``, however large the group is.

    ``piece`` cuts a group into bounded pieces and must not fall along
    ``order``.  Each window holds one piece; between pieces only totals move.
    With ``weight`` the rank counts the weights before the row instead of the
    rows.  ``group`` may hold nulls.
    """
    weight = F.lit(1) if weight is None else weight
    rows = df.withColumns({"_weight": weight.cast("bigint"), "_piece": piece.cast("bigint")})
    totals = rows.groupBy(*group, "_piece").agg(F.sum("_weight").alias("_total"))
    earlier = Window.partitionBy(*group).orderBy("_piece").rowsBetween(*BEFORE)
    starts = totals.select(
        *(F.col(c).alias(f"_g{i}") for i, c in enumerate(group)),
        F.col("_piece").alias("_p"),
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_start"),
    )
    within = Window.partitionBy(*group, "_piece").orderBy(*order).rowsBetween(*BEFORE)
    rows = rows.withColumn("_before", F.coalesce(F.sum("_weight").over(within), F.lit(0)))
    same = F.col("_piece") == F.col("_p")
    for i, c in enumerate(group):
        same &= F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return rows.join(starts, same).select(
        *df.columns, (F.col("_start") + F.col("_before")).cast("bigint").alias(name)
    )
