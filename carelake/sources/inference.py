"""Column types found in the pass that lands a table of text.

A value's kind is the narrowest type that it can be read as.  The kinds that a
column has, as bits, are one aggregate (``bit_or``) that is merged from task to
task and says the column's type: so text is read once, written once with the
kinds counted on the way, and cast when it is read from there.  Inferring types
while reading would read the input twice.

Types are int, bigint, double, boolean, date (``yyyy-MM-dd``), timestamp, or
string; whole numbers mix into the wider one and with fractions into double,
dates and timestamps into timestamp, and any other mixture is a string, as is a
column without values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    TimestampType,
)

_INT, _LONG, _DOUBLE, _BOOLEAN, _DATE, _TIMESTAMP, _OTHER = (1 << i for i in range(7))
#: The kinds that a type takes in, narrow types first.
_TYPES: tuple[tuple[int, DataType], ...] = (
    (_INT, IntegerType()), (_INT | _LONG, LongType()), (_INT | _LONG | _DOUBLE, DoubleType()),
    (_BOOLEAN, BooleanType()), (_DATE, DateType()), (_DATE | _TIMESTAMP, TimestampType()),
)


def kind(value: Column) -> Column:
    """The bit of the narrowest type that the text can be read as; NULL for NULL."""
    text = F.trim(value)
    day = text.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(text, "yyyy-MM-dd").isNotNull()
    moment = text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d") & F.try_to_timestamp(text).isNotNull()
    found = (
        # The form is looked at before the value, which spares most texts the conversions.
        F.when(text.rlike(r"^[+-]?\d+$"), F.when(text.try_cast("int").isNotNull(), _INT)
               .when(text.try_cast("bigint").isNotNull(), _LONG).otherwise(_DOUBLE))
        .when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^([+-]?Infinity|NaN)$"), _DOUBLE)
        .when(F.lower(text).isin("true", "false"), _BOOLEAN)
        .when(day, _DATE)
        .when(moment, _TIMESTAMP)
        .otherwise(_OTHER)
    )
    return F.when(value.isNotNull(), found)


def type_of(kinds: int | None) -> DataType:
    """The narrowest type that takes in all kinds a column has."""
    if not kinds:
        return StringType()
    return next((kind for taken, kind in _TYPES if kinds | taken == taken), StringType())


def kinds(df: DataFrame) -> list[Column]:
    """One aggregate per column: the bits of the kinds it has."""
    return [F.bit_or(kind(F.col(f"`{c}`"))).alias(c) for c in df.columns]


def merged(*found: dict[str, int | None]) -> dict[str, int | None]:
    """The kinds of several parts of a table as those of the whole."""
    names = dict.fromkeys(name for part in found for name in part)
    return {n: reduce(lambda a, b: (a or 0) | (b or 0), (part.get(n) for part in found)) for n in names}


def land(text: DataFrame, folder: str) -> tuple[DataFrame, dict[str, int | None]]:
    """Write a table of text and return it typed as read from there, with the kinds found on the way."""
    seen = Observation()
    text.observe(seen, *kinds(text)).write.parquet(folder)
    found = {c: seen.get.get(c) for c in text.columns}
    return typed(text.sparkSession.read.schema(text.schema).parquet(folder), found), found


def typed(text: DataFrame, found: dict[str, int | None]) -> DataFrame:
    """Text columns cast to the types that their kinds come to."""

    def cast(name: str) -> Column:
        kind, value = type_of(found.get(name)), F.col(f"`{name}`")
        return (value if isinstance(kind, StringType) else F.trim(value).cast(kind)).alias(name)

    return text.select(*(cast(c) for c in text.columns))
