"""Join summaries: what a table contributes to a join, reduced to the join key.

The jobs count and average over many-to-many joins (admissions x patient rows x
history rows x readings).  Joining first would send all rows of a frequent
patient or hospital to one task and multiply them there.  Instead every table
is reduced to one row per key, with how many rows it stands for, and the
summaries are multiplied after the join.  The reduction starts before its
shuffle, so a key that holds a large part of a table arrives as a few rows.
"""

from __future__ import annotations

from functools import reduce
from operator import mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows() -> Column:
    return F.count(F.lit(1))


def copies(df: DataFrame, key: str, alias: str) -> DataFrame:
    """Number of rows per key; NULL keys never join and are left out."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(rows().alias(alias))


def visits(df: DataFrame, *further_keys: Column, **measures: Column) -> DataFrame:
    """Admissions to a hospital per patient (and further keys) with summed measures.

    A patient has at most one row per hospital and further key, however many
    admissions they have.
    """
    return (
        df.filter(F.col("hospital_id").isNotNull())
        .groupBy("patient_id", "hospital_id", *further_keys)
        .agg(*(measure.alias(name) for name, measure in measures.items()))
    )


def times(*counts: str | Column) -> Column:
    """Product of counts, in decimals: that of a frequent key can exceed a bigint."""
    return reduce(mul, (_column(c).cast("decimal(19,0)") for c in counts))


def whole(total: Column) -> Column:
    """A total of counts, exact however large; one that needs 39 digits is an error."""
    return total.cast("decimal(38,0)")


def ratio(part: str | Column, total: str | Column) -> Column:
    """Quotient as a double; NULL where the total is 0 or missing."""
    return F.try_divide(_column(part).cast("double"), _column(total).cast("double"))


def weighted_mean(total: str | Column, count: str | Column) -> Column:
    """Mean from partial sums; NULL where nothing was counted."""
    return ratio(F.sum(total), F.sum(count))


def modes(df: DataFrame, keys: list[str], column: str, alias: str = "mode") -> DataFrame:
    """The most frequent value of a column per key, whatever its values, and how often it occurs.

    Equal counts are settled by the smaller value; NULLs are not counted, and a
    key without any value has none.  Values are counted first, where they lie, so
    a frequent value or key travels as one row per task; what remains of a key
    is one row per distinct value, again reduced before it moves.
    """
    counted = df.groupBy(*keys, column).agg(F.count(column).alias("_n"))
    # The smallest of (-count, value) is the mode.
    ranked = F.struct((-F.col("_n")).alias("n"), F.col(column).alias("value"))
    best = counted.groupBy(*keys).agg(F.min(F.when(F.col("_n") > 0, ranked)).alias("_best"))
    times_found = F.coalesce(-F.col("_best.n"), F.lit(0)).alias(f"{alias}_count")
    return best.select(*keys, F.col("_best.value").alias(alias), times_found)


def steady_round(value: Column, digits: int = 0) -> Column:
    """Half up, without the noise of summing doubles in changing order.

    The inner rounding puts a value such as 112.49999999999997 back to 112.5.
    """
    return F.round(F.round(value, 8), digits)


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
