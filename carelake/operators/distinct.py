"""Distinct counts that merge: exact bitmaps of numbered values, kept per key.

A bitmap is a set of rows ``word, bits``: the values from 64 x ``word`` on, one
bit each.  A key with few values has few rows, never more than it has values.
Bitmaps are merged by OR, which begins before the shuffle and to which repeated
rows are nothing; a count is the number of bits set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A text's number is its rank within one of so many groups of hashes, and that group.
GROUPS = 4096


def bitmaps(rows: DataFrame, by: list[str], number: str) -> DataFrame:
    """``by``, ``word, bits`` over the whole numbers in ``number``; NULLs are in no set."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.col(number), F.lit(64)).cast("int"))
    word = F.shiftright(F.col(number).cast("bigint"), 6)
    return (
        rows.where(F.col(number).isNotNull())
        .groupBy(*by, word.alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
    )


def merged(words: DataFrame, by: list[str]) -> DataFrame:
    """Bitmaps of coarser keys, or of the same ones after rows were added."""
    return words.groupBy(*by, "word").agg(F.bit_or("bits").alias("bits"))


def counted(words: DataFrame, by: list[str], name: str) -> DataFrame:
    """How many values each key has.  A key with NULL bits only has none."""
    return merged(words, by).groupBy(*by).agg(size().alias(name))


def size() -> Column:
    return F.coalesce(F.sum(F.bit_count("bits")), F.lit(0))


def unnumbered(values: DataFrame, known: DataFrame) -> DataFrame:
    """``value, number`` for those of ``values`` that ``known`` has no number for yet.

    Both have a column ``value``; numbers go on within each group of hashes from
    what is known, so they depend on the values alone and no task numbers them all.
    """
    group = F.pmod(F.xxhash64("value"), F.lit(GROUPS))
    new = values.where(F.col("value").isNotNull()).select("value").distinct().join(known, "value", "left_anti")
    taken = known.groupBy(group.alias("group")).agg(F.count(F.lit(1)).alias("taken"))
    place = F.row_number().over(Window.partitionBy("group").orderBy("value")) - 1
    return (
        new.select("value", group.alias("group"))
        .withColumn("place", place)
        .join(taken, "group", "left")
        .select("value", ((F.coalesce("taken", F.lit(0)) + F.col("place")) * GROUPS + F.col("group")).alias("number"))
    )
