"""Types found while landing, against the values and against Spark's own inference."""

import pytest

from carelake import catalog, schemas
from carelake.sources import inference
from tests.messy import messy_rows, spark_tables


@pytest.mark.parametrize("values, expected", [
    (["1", "-2147483648", None], "int"),
    (["1", "2147483648"], "bigint"),
    (["1", "9223372036854775808"], "double"),
    (["1", "2.5", "9999999999"], "double"),
    (["1e5", ".5", "NaN", "-Infinity"], "double"),
    (["TRUE", "false"], "boolean"),
    (["true", "1"], "string"),
    (["2020-01-31", None], "date"),
    (["2020-01-31", "2020-01-31 10:00:00"], "timestamp"),
    (["2020-01-31", "2020-02-31"], "string"),
    (["2020-01-31", "20200131"], "string"),
    (["1", "x"], "string"),
    ([None, None], "string"),
    (["", "1"], "string"),
    ([" 7", "8 "], "int"),
    ([], "string"),
])
def test_type_of_values(spark, tmp_path, values, expected):
    text = spark.createDataFrame([(v, "k") for v in values], "`a.b` string, k string")
    typed, found = inference.land(text, str(tmp_path / "t"))
    assert typed.dtypes == [("a.b", expected), ("k", "string")]
    assert typed.count() == len(values)
    assert sum(r[0] is not None for r in typed.collect()) == sum(v is not None for v in values)
    # Parts merge to the whole.
    parts = [text.where(f"coalesce(`a.b`, '') {c} '2'") for c in ("<", ">=")]
    halves = [dict(p.agg(*inference.kinds(p)).first().asDict()) for p in parts]
    assert inference.type_of(inference.merged(*halves)["a.b"]) == inference.type_of(found["a.b"])


def test_one_pass_over_the_files_finds_what_two_do(spark, tmp_path):
    tables = dict(spark_tables(spark, messy_rows(2)).items())
    for name in schemas.BATCH:
        path = f"{tmp_path}/{name}.csv"
        catalog._write_csv(tables[name].coalesce(1), path)
        twice = spark.read.csv(path, header=True, inferSchema=True)
        expected = sorted(map(tuple, twice.collect()), key=repr)
        typed, _ = inference.land(spark.read.csv(path, header=True), f"{tmp_path}/{name}")
        assert "FileScan csv" not in typed._jdf.queryExecution().executedPlan().toString()
        assert typed.dtypes == twice.dtypes
        assert sorted(map(tuple, typed.collect()), key=repr) == expected
