"""Schemas that grow with the files that arrive.

A table's schema is the merge of the layouts of all files taken so far.  A new
column is added.  A column whose type changes takes the wider one if every value
of both fits it; otherwise the type stays, values that fit it are converted, and
what does not fit is kept as text in the column ``_rescued``, a JSON object of
column names and values.  Nothing is lost without a word.

Merged schemas are kept as numbered files.  Files written earlier are read with
the schema of now: Parquet readers fill in missing columns and widen types.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NumericType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from carelake.sources.filesystem import AlreadyThere, FileSystem

RESCUED = "_rescued"
#: Whole numbers, narrow first, with the digits that hold all their values.
_WHOLE = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 20}
_IN_DOUBLE = (ByteType(), ShortType(), IntegerType(), FloatType())


def _digits(kind: DataType) -> tuple[int, int] | None:
    """Digits before and after the point."""
    if kind in _WHOLE:
        return _WHOLE[kind], 0
    if isinstance(kind, DecimalType):
        return kind.precision - kind.scale, kind.scale
    return None


def wider(a: DataType, b: DataType) -> DataType | None:
    """The narrower of the types that hold all values of both; None if there is none."""
    if a == b:
        return a
    if a in _WHOLE and b in _WHOLE:
        return a if _WHOLE[a] > _WHOLE[b] else b
    if DoubleType() in (a, b) or FloatType() in (a, b):
        return DoubleType() if {a, b} <= {DoubleType(), *_IN_DOUBLE} else None
    if {a, b} == {DateType(), TimestampNTZType()}:
        return TimestampNTZType()
    sizes = [_digits(a), _digits(b)]
    if None not in sizes:
        before, after = (max(s[i] for s in sizes) for i in (0, 1))
        return DecimalType(before + after, after) if before + after <= 38 else None
    return None


def grown(known: StructType | None, new: StructType) -> StructType:
    """``known`` with the columns and types that ``new`` adds, in that order."""
    fields = {f.name: f.dataType for f in (known or StructType())}
    rescued = fields.pop(RESCUED, None) is not None
    for f in new:
        if f.name == RESCUED:
            rescued = True
            continue
        kind = wider(fields.setdefault(f.name, f.dataType), f.dataType)
        rescued |= kind is None
        fields[f.name] = kind or fields[f.name]
    if rescued:
        fields[RESCUED] = StringType()
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def _as_text(name: str, kind: DataType) -> Column:
    if isinstance(kind, StringType):
        return F.col(name)
    plain = isinstance(kind, NumericType) or kind.typeName() in ("date", "boolean", "timestamp", "timestamp_ntz")
    return F.col(name).cast("string") if plain else F.to_json(F.struct(F.col(name).alias("value")))


def fitted(df: DataFrame, schema: StructType) -> DataFrame:
    """Rows of an earlier or other layout as rows of ``schema``; what does not fit goes to ``_rescued``."""
    have = {f.name: f.dataType for f in df.schema}
    columns, left = [], []
    for f in schema:
        kind = have.get(f.name)
        if f.name == RESCUED:
            continue
        if kind is None:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif kind == f.dataType or wider(kind, f.dataType) == f.dataType:
            columns.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            comparable = not {kind.typeName(), f.dataType.typeName()} & {"array", "map", "struct", "binary", "variant"}
            value = F.col(f.name).try_cast(f.dataType) if comparable else F.lit(None).cast(f.dataType)
            fits = value.isNotNull()
            if isinstance(kind, NumericType) and comparable:
                # A conversion that drops digits is no fit.
                fits &= value.try_cast(kind).eqNullSafe(F.col(f.name))
            columns.append(F.when(fits, value).alias(f.name))
            left.append(F.when(F.col(f.name).isNotNull() & ~fits, _as_text(f.name, kind)).alias(f.name))
    if RESCUED in schema.names:
        before = F.col(RESCUED) if RESCUED in have else F.lit(None).cast("string")
        rescued = F.to_json(F.struct(*left)) if left else F.lit("{}")
        columns.append(F.when(rescued != "{}", rescued).otherwise(before).alias(RESCUED))
    return df.select(*columns)


class SchemaLog:
    """The schemas a table has had, as numbered files below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.files, self.folder = FileSystem(spark), folder.rstrip("/")

    def _latest(self) -> tuple[int, StructType | None]:
        names = [e.name for e in self.files.entries(self.folder) if e.name.endswith(".json") and e.name[0] != "."]
        if not names:
            return 0, None
        text = self.files.read(f"{self.folder}/{max(names)}")
        return int(max(names).removesuffix(".json")), StructType.fromJson(json.loads(text))

    def latest(self) -> StructType | None:
        return self._latest()[1]

    def grow(self, new: StructType) -> StructType:
        """The schema with ``new`` merged in, kept if that changed it."""
        while True:
            number, known = self._latest()
            merged = grown(known, new)
            if merged == known:
                return merged
            try:
                self.files.create(f"{self.folder}/{number + 1:09d}.json", merged.json())
                return merged
            except AlreadyThere:
                continue  # another writer grew it first


def layouts(
    spark: SparkSession, paths: list[str], rule: Callable[[str], str] = str
) -> list[tuple[StructType, list[str]]]:
    """Parquet files by layout: groups of neighbours whose columns agree, with their joint schema.

    Columns agree if those of one name have one type, and no two names become
    one by ``rule``.  The footers of a group are read and merged by one job.
    Where they disagree the files are halved, so a change of layout costs a job
    for each halving and not one for each file.
    """
    if not paths:
        return []
    try:
        schema = spark.read.option("mergeSchema", "true").parquet(*paths).schema
        if len(paths) == 1 or len({rule(name) for name in schema.names}) == len(schema):
            return [(schema, paths)]
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error) or len(paths) == 1:
            raise
    middle = len(paths) // 2
    groups = layouts(spark, paths[:middle], rule)
    for schema, files in layouts(spark, paths[middle:], rule):
        if groups and groups[-1][0] == schema:
            groups[-1][1].extend(files)
        else:
            groups.append((schema, files))
    return groups
