"""Schemas that grow: types, rows that do not fit, and streams over changing layouts."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    ByteType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from carelake.functions import naming
from carelake.sources import filesystem, growing, layers
from carelake.streaming import readings


def schema(text):
    return StructType.fromDDL(text)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("a, b, expected", [
    (IntegerType(), LongType(), LongType()),
    (ByteType(), IntegerType(), IntegerType()),
    (IntegerType(), DoubleType(), DoubleType()),
    (FloatType(), DoubleType(), DoubleType()),
    (FloatType(), IntegerType(), DoubleType()),
    (LongType(), DoubleType(), None),  # a double does not hold all of them
    (LongType(), FloatType(), None),
    (IntegerType(), DecimalType(5, 2), DecimalType(12, 2)),
    (LongType(), DecimalType(38, 20), None),
    (DecimalType(10, 2), DecimalType(8, 4), DecimalType(12, 4)),
    (DateType(), TimestampNTZType(), TimestampNTZType()),
    (DateType(), TimestampType(), None),
    (StringType(), IntegerType(), None),
    (BooleanType(), IntegerType(), None),
    (ArrayType(IntegerType()), ArrayType(IntegerType()), ArrayType(IntegerType())),
    (ArrayType(IntegerType()), ArrayType(LongType()), None),
])
def test_wider_type_holds_all_values(a, b, expected):
    assert growing.wider(a, b) == growing.wider(b, a) == expected


def test_schemas_grow_and_never_shrink(spark):
    known = schema("a int, b string")
    assert growing.grown(None, known) == known
    assert growing.grown(known, schema("a long, c date")) == schema("a long, b string, c date")
    assert growing.grown(known, schema("b string")) == known
    assert growing.grown(known, schema("b int")) == schema("a int, b string, _rescued string")
    again = growing.grown(schema("a int, _rescued string"), schema("z int"))
    assert again == schema("a int, z int, _rescued string")


def test_rows_that_do_not_fit_are_kept_as_text(spark):
    target = schema("n bigint, d date, x double, tags array<int>, _rescued string")
    rows = spark.createDataFrame(
        [(1.0, "2020-01-02", Decimal("1.5"), ["a"]), (1.5, "no date", None, None), (None, None, Decimal("1e30"), []),
         (float("nan"), "2020-01-32", Decimal("2"), None)],
        "n double, d string, x decimal(38,6), tags array<string>",
    )
    found = [tuple(r) for r in growing.fitted(rows, target).collect()]
    day = dt.date(2020, 1, 2)
    assert found == [
        (1, day, 1.5, None, '{"tags":"{\\"value\\":[\\"a\\"]}"}'),
        (None, None, None, None, '{"n":"1.5","d":"no date"}'),
        (None, None, 1e30, None, '{"tags":"{\\"value\\":[]}"}'),
        (None, None, 2.0, None, '{"n":"NaN","d":"2020-01-32"}'),
    ]
    # Rows that were rescued before keep that when they are read and fitted again.
    kept = growing.fitted(growing.fitted(rows, target), target)
    assert [tuple(r) for r in kept.collect()] == found
    narrow = spark.createDataFrame([(7,)], "n int")
    assert growing.fitted(narrow, target).collect()[0] == (7, None, None, None, None)


def test_files_are_grouped_by_layout(spark, tmp_path):
    for i, ddl in enumerate(["a int", "a int, b string", "a string", "a string", "a int"]):
        spark.createDataFrame([], ddl).coalesce(1).write.parquet(f"{tmp_path}/{i}")
    paths = [f"{tmp_path}/{i}" for i in range(5)]
    found = growing.layouts(spark, paths)
    assert [files for _, files in found] == [paths[:2], paths[2:4], paths[4:]]
    assert [s for s, _ in found] == [schema("a int, b string"), schema("a string"), schema("a int")]
    assert growing.layouts(spark, []) == []


def test_two_writers_both_grow_the_schema(spark, tmp_path, monkeypatch):
    log, other = (growing.SchemaLog(spark, f"{tmp_path}/log") for _ in range(2))
    assert log.latest() is None
    log.grow(schema("a int"))
    plain, raced = filesystem.FileSystem.create, []

    def overtaken(self, file, text):
        if not raced:
            raced.append(True)
            other.grow(schema("b int"))
        plain(self, file, text)

    monkeypatch.setattr(filesystem.FileSystem, "create", overtaken)
    assert log.grow(schema("c int")) == schema("a int, b int, c int") == other.latest()


LAYOUTS = [
    ("`Patient ID` string, ` Heart Rate (per minute) ` int", [("P1", 70), ("P2", 201)]),
    ("`patient id` string, `Heart Rate (per minute)` double, Kind string", [("P3", 71.5, "band")]),
    ("patient_id string, heart_rate_per_minute string", [("P4", "72"), ("P5", "n/a"), ("P6", None)]),
    ("patient_id int, heart_rate_per_minute float", [(7, 0.5)]),
]
EXPECTED = [
    ("P1", 70.0, None, None), ("P2", 201.0, None, None), ("P3", 71.5, "band", None), ("P4", 72.0, None, None),
    ("P5", None, None, '{"heart_rate_per_minute":"n/a"}'), ("P6", None, None, None), ("7", 0.5, None, None),
]


def deliver(spark, folder, *numbers):
    for i in numbers:
        ddl, rows = LAYOUTS[i]
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(f"{folder}")


@pytest.mark.parametrize("files_per_batch, at_once", [(1, True), (100, True), (100, False)])
def test_a_stream_follows_changing_layouts(spark, tmp_path, files_per_batch, at_once):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for numbers in [(0, 1, 2, 3)] if at_once else [(0,), (1, 2), (), (3,)]:
        deliver(spark, source, *numbers)
        query = readings.run_stream(spark, source, out, files_per_batch=files_per_batch)
    for layer, name in ((layers.BRONZE, readings.RAW), (layers.SILVER, readings.CLEAN)):
        landed = layers.landed(spark, out, layer, name)
        assert landed.columns == ["patient_id", "heart_rate_per_minute", "kind", growing.RESCUED]
        assert dict(landed.dtypes)["heart_rate_per_minute"] == "double"
        assert rows_of(landed) == sorted(EXPECTED, key=repr)
    assert query.exception() is None


def test_a_repeated_micro_batch_counts_once(spark, tmp_path, monkeypatch):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    deliver(spark, source, 0, 2)
    crashed = []

    def land():
        readings.land_growing(
            spark, source, out, layers.BRONZE, "t", str(tmp_path / "check"), rule=naming.device
        )

    # The micro-batch is written, and the stream stops before it knows.
    write = type(spark.range(1).write).parquet

    def written_then_crashed(self, path, **options):
        write(self, path, **options)
        if "/batch-" in path and not crashed:
            crashed.append(path)
            raise RuntimeError("crash")

    with monkeypatch.context() as patch, pytest.raises(Exception, match="crash"):
        patch.setattr(type(spark.range(1).write), "parquet", written_then_crashed)
        land()
    assert crashed
    land()
    expected = [(p, r, x) for p, r, _, x in EXPECTED if p in ("P1", "P2", "P4", "P5", "P6")]
    assert rows_of(layers.landed(spark, out, layers.BRONZE, "t")) == sorted(expected, key=repr)
