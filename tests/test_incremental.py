"""Inputs taken file by file, over runs, repeats and crashes."""

import os

import pytest

from carelake import catalog, schemas
from carelake.plans import incremental
from carelake.sources import filesystem, layers
from tests.messy import messy_rows

NAMES = ("hospitals", "plans", "new_admissions")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


class Inputs:
    def __init__(self, spark, root):
        self.spark, self.source, self.out = spark, f"{root}/in", f"{root}/out"
        self.rows = messy_rows(8)

    def deliver(self, name, rows, columns=None):
        df = self.spark.createDataFrame(rows, schemas.BATCH[name]).coalesce(1)
        df = catalog._raw_headers(name, df if columns is None else df.select(*columns))
        df.write.mode("append").csv(
            f"{self.source}/{name}.csv", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )

    def run(self, **options):
        return incremental.ingest_new(self.spark, self.source, self.out, names=NAMES, **options)

    def found(self, name):
        return rows_of(layers.opened(self.spark, self.out, layers.BRONZE).read(f"{name}_raw"))


@pytest.fixture
def inputs(spark, tmp_path):
    return Inputs(spark, tmp_path)


def test_a_run_reads_new_files_only(spark, inputs, monkeypatch):
    assert inputs.run()[1] == 0
    admissions, plans = inputs.rows["new_admissions"], inputs.rows["plans"]
    inputs.deliver("new_admissions", admissions[:30])
    inputs.deliver("plans", plans)
    layer, taken = inputs.run()
    assert (layer.version, taken) == (1, 2)
    first = layer.datasets["new_admissions_raw"].folders
    # Nothing new: nothing is read, written or published.
    assert [n for _, n in (inputs.run(), inputs.run())] == [0, 0]
    assert layers.versions(spark, inputs.out, layers.BRONZE) == [1]
    inputs.deliver("new_admissions", admissions[30:])
    inputs.deliver("hospitals", inputs.rows["hospitals"])
    read = []
    plain = incremental.read_csv_files
    monkeypatch.setattr(incremental, "read_csv_files", lambda s, p, **o: read.extend(p) or plain(s, p, **o))
    layer, taken = inputs.run()
    assert taken == 2 and len(read) == 2
    assert layer.datasets["new_admissions_raw"].folders[:1] == first
    assert layer.datasets["new_admissions_raw"].rows == len(admissions)
    for name in NAMES:
        expected = spark.createDataFrame(inputs.rows[name], schemas.BATCH[name])
        assert inputs.found(name) == rows_of(expected)
    assert incremental.ledger(layer).groupBy("dataset").count().collect().__len__() == 3


def test_a_crash_takes_nothing_and_a_repeat_takes_all_once(inputs, monkeypatch):
    inputs.deliver("plans", inputs.rows["plans"][:2])
    inputs.run()
    inputs.deliver("plans", inputs.rows["plans"][2:])

    def crash(*_, **__):
        raise RuntimeError("crash")

    for target, name in ((layers, "store_all"), (layers, "publish"), (filesystem.FileSystem, "create")):
        with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="crash"):
            patch.setattr(target, name, crash)
            inputs.run()
        assert len(inputs.found("plans")) == 2
    assert inputs.run()[1] == 1 and inputs.run()[1] == 0
    assert inputs.found("plans") == sorted(map(tuple, inputs.rows["plans"]), key=repr)


def test_two_runs_at_once_do_not_take_a_file_twice(spark, inputs, monkeypatch):
    inputs.deliver("plans", inputs.rows["plans"])
    plain, raced = layers.store_all, []

    def overtaken(*args):
        if not raced:
            raced.append(True)
            inputs.run()
        return plain(*args)

    monkeypatch.setattr(layers, "store_all", overtaken)
    with pytest.raises(filesystem.AlreadyThere):
        inputs.run()
    assert inputs.found("plans") == sorted(map(tuple, inputs.rows["plans"]), key=repr)


def test_a_changed_file_and_other_headers_are_errors(inputs):
    inputs.deliver("plans", inputs.rows["plans"])
    inputs.run()
    folder = f"{inputs.source}/plans.csv"
    (name,) = (f for f in os.listdir(folder) if f.endswith(".csv") and f[0] != ".")
    with open(f"{folder}/{name}", "a") as file:
        file.write("PLAN-X,,true,true,true,true,true,true\n")
    crc = f"{folder}/.{name}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    with pytest.raises(ValueError, match="have changed"):
        inputs.run()
    inputs.deliver("hospitals", inputs.rows["hospitals"])
    columns = schemas.HOSPITALS.names
    inputs.deliver("hospitals", inputs.rows["hospitals"], columns[::-1])
    with pytest.raises(Exception, match="(?i)header"):
        incremental.ingest_new(inputs.spark, inputs.source, inputs.out, names=("hospitals",))


def test_a_backlog_may_be_taken_in_steps(inputs):
    plans = inputs.rows["plans"]
    for row in plans[:3]:
        inputs.deliver("plans", [row])
    assert [inputs.run(files=2)[1] for _ in range(3)] == [2, 1, 0]
    assert inputs.found("plans") == sorted(map(tuple, plans[:3]), key=repr)
