"""Facts that follow changes, against the facts of the tables as they are in the end."""

import datetime as dt
import random

import pytest
from pyspark.sql.types import IntegerType, StructType

from carelake.operators.cleaning import clean_tables
from carelake.plans import facts
from carelake.sources import filesystem, layers
from carelake.sources.files import stream_parquet
from carelake.streaming import changes
from carelake.streaming.live_facts import BUCKET, DATASET, KEPT, LiveFacts
from carelake.streaming.sums import Sums
from carelake.tables import NAMES
from tests.messy import SCHEMAS, messy_rows, spark_tables

AS_OF = dt.date(2002, 1, 1)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def expected(spark, rows):
    return rows_of(facts.patient_facts(clean_tables(spark_tables(spark, rows)), as_of=AS_OF))


class Feeds:
    """Deliveries of changes to folders, and the streams over them."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder

    def schema(self, name):
        return StructType([*SCHEMAS[name].fields]).add("change", IntegerType())

    def deliver(self, name, signed):
        """Rows with their change, as a file of their own."""
        rows = [(*row, change) for row, change in signed]
        df = self.spark.createDataFrame(rows, self.schema(name))
        df.coalesce(1).write.mode("append").parquet(f"{self.folder}/{name}")

    def streams(self, *names):
        return {
            n: stream_parquet(self.spark, f"{self.folder}/{n}", self.schema(n), files_per_batch=1)
            for n in names or NAMES
        }


@pytest.fixture
def feeds(spark, tmp_path):
    return Feeds(spark, str(tmp_path / "in"))


def live_of(spark, tmp_path, **options):
    return LiveFacts(spark, str(tmp_path / "live"), **options)


def test_all_tables_are_followed():
    assert set(KEPT) == set(NAMES)


@pytest.mark.parametrize("seed", [1])
def test_any_split_of_changes_gives_the_batch_facts(spark, tmp_path, feeds, seed):
    rng = random.Random(seed)
    final, other = messy_rows(seed), messy_rows(seed + 50)
    live = live_of(spark, tmp_path, buckets=4)
    for name in NAMES:
        # All final rows; and rows of another table that come and are taken back, in any order.
        noise = rng.sample(other[name], min(15, len(other[name])))
        signed = [(r, 1) for r in final[name]] + [(r, 1) for r in noise] + [(r, -1) for r in noise]
        rng.shuffle(signed)
        parts = rng.choice([1, 2, 3])
        for part in range(parts):
            if signed[part::parts]:
                feeds.deliver(name, signed[part::parts])
    live.run(feeds.streams())
    found = rows_of(live.read(as_of=AS_OF))
    assert found == expected(spark, final)
    assert found
    # Nothing new: the version stays.
    version = layers.opened(spark, live.folder, layers.GOLD).version
    live.run(feeds.streams())
    assert layers.opened(spark, live.folder, layers.GOLD).version == version


def changed_rows(rows):
    """One row of each table replaced by another, and the signed rows that say so."""
    after, signed = {}, {}
    policies = [r for r in rows["policies_new"] if r[1] and r[2] == "PLAN-1"]
    edits = {
        "policies_new": (policies[0], (*policies[0][:4], dt.date(2030, 1, 1), *policies[0][5:])),
        "plans": (rows["plans"][0], (*rows["plans"][0][:2], *[False] * 6)),
        "hospitals": (rows["hospitals"][0], (*rows["hospitals"][0][:4], "elsewhere", *rows["hospitals"][0][5:])),
        "patients": (rows["patients"][1], (*rows["patients"][1][:2], "01-01-1999")),
        "patient_history": (rows["patient_history"][0], (rows["patient_history"][0][0], *[1] * 25)),
        "new_admissions": (rows["new_admissions"][3], (*rows["new_admissions"][3][:4], 99, *rows["new_admissions"][3][5:])),
        "patient_device_stream": (rows["patient_device_stream"][0], (rows["patient_device_stream"][0][0], 1.0)),
    }
    for name, (old, new) in edits.items():
        kept = list(rows[name])
        kept.remove(old)
        after[name] = [*kept, new]
        signed[name] = [(old, -1), (new, 1)]
    return after, signed


def folders(spark, live):
    stored = layers.opened(spark, live.folder, layers.GOLD).datasets[DATASET].folders
    return {int(f.rpartition("=")[2]): f for f in stored}


def test_each_change_touches_only_what_it_concerns(spark, tmp_path, feeds):
    rows = messy_rows(9)
    live = live_of(spark, tmp_path, buckets=64)
    for name in NAMES:
        feeds.deliver(name, [(r, 1) for r in rows[name]])
    live.run(feeds.streams())
    assert rows_of(live.read(as_of=AS_OF)) == expected(spark, rows)
    after, signed = changed_rows(rows)
    bucket_of = {
        r.patient_id: r.bucket for r in live.computed().select("patient_id", BUCKET).distinct().collect()
    }
    for name in ("policies_new", "hospitals", "plans", "patients"):
        before = folders(spark, live)
        feeds.deliver(name, signed[name])
        live.run(feeds.streams(name))
        rows = {**rows, name: after[name]}
        assert rows_of(live.read(as_of=AS_OF)) == expected(spark, rows), name
        now = folders(spark, live)
        rewritten = {b for b in before.keys() | now.keys() if before.get(b) != now.get(b)}
        if name == "hospitals":
            there = {r[1] for r in rows["new_admissions"] if r[2] == signed[name][0][0][0]}
        elif name == "plans":
            there = {r[1] for r in rows["policies_new"] if r[2] == signed[name][0][0][0]}
        else:
            there = {row[SCHEMAS[name].names.index("patient_id")] for row, _ in signed[name]}
        assert rewritten <= {bucket_of[p] for p in there if p in bucket_of}, name
        assert len(rewritten) < len(before) or name in ("plans", "hospitals")
    # Old versions go, and with them the buckets' folders that no kept version has.
    removed = layers.expire(spark, live.folder, layers.GOLD, keep=1, older_than=dt.timedelta(0))
    assert removed and rows_of(live.read(as_of=AS_OF)) == expected(spark, rows)


def test_a_crash_at_any_step_loses_and_repeats_nothing(spark, tmp_path, feeds, monkeypatch):
    rows = messy_rows(4)
    after, signed = changed_rows(rows)
    live = live_of(spark, tmp_path, buckets=4)
    for name in NAMES:
        feeds.deliver(name, [(r, 1) for r in rows[name]])
    live.run(feeds.streams())
    for name in NAMES:
        feeds.deliver(name, signed[name])

    def crash(*_, **__):
        raise RuntimeError("crash")

    plain = Sums.store

    def stored_then_crashed(self, sums, batch_id, **options):
        plain(self, sums, batch_id, **options)
        crash()

    with monkeypatch.context() as patch, pytest.raises(Exception, match="crash"):
        patch.setattr(Sums, "store", stored_then_crashed)  # kept, but the stream does not know
        live.run(feeds.streams("policies_new"))
    live = live_of(spark, tmp_path, buckets=4)
    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="crash"):
        patch.setattr(filesystem.FileSystem, "create", crash)  # written, but not published
        live.run(feeds.streams())
    assert rows_of(live.read(as_of=AS_OF)) == expected(spark, rows)
    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="crash"):
        patch.setattr(Sums, "merge", crash)  # published, but sums not merged
        live.refresh()
    live = live_of(spark, tmp_path, buckets=4)
    live.run(feeds.streams())
    assert rows_of(live.read(as_of=AS_OF)) == expected(spark, after)


def test_sums_are_merged_only_after_the_facts_have_followed(spark, tmp_path, feeds, monkeypatch):
    monkeypatch.setattr("carelake.streaming.live_facts.BATCHES", 2)
    rows = messy_rows(3)
    live = live_of(spark, tmp_path, buckets=4)
    for part in range(4):
        for name in NAMES:
            feeds.deliver(name, [(r, 1) for r in rows[name][part::4]])
    live.run(feeds.streams())
    for sums in live.sums.values():
        assert list(sums._folders("batch")) == [] and list(sums._folders("upto")) == [3]
    after, signed = changed_rows(rows)
    for name in NAMES:
        feeds.deliver(name, signed[name])
    live.run(feeds.streams())
    assert rows_of(live.read(as_of=AS_OF)) == expected(spark, after)


def test_merged_sums_forget_what_has_been_taken_back(spark, tmp_path):
    schema = "k string, n bigint, days bigint"
    sums = Sums(spark, str(tmp_path / "sums"), schema, ["k"])
    sums.store(spark.createDataFrame([("a", 1, 5), ("b", 1, 2), ("c", 1, 4)], schema), 0)
    # b goes; c is replaced by a row with other days, so only its days change.
    sums.store(spark.createDataFrame([("b", -1, -2), ("c", 0, 3)], schema), 1)
    sums.merge()
    assert rows_of(spark.read.parquet(f"{tmp_path}/sums/upto=1")) == [("a", 1, 5), ("c", 1, 7)]


def test_without_changes_there_are_no_facts(spark, tmp_path):
    live = live_of(spark, tmp_path)
    live.refresh()
    assert live.read(as_of=AS_OF).collect() == []


def test_differences_of_versions_lead_from_one_to_the_other(spark, tmp_path):
    root, schema = str(tmp_path), "id int, v string"
    old = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], schema)
    new = spark.createDataFrame([(1, "a"), (2, None), (3, "d"), (4, None), (4, None)], schema)
    expected = [(1, "a", -1), (3, "c", -1), (3, "d", 1), (4, None, 2)]
    assert rows_of(changes.difference(old, new)) == expected
    first = layers.materialise_all({"t": old, "same": old}, root, layers.SILVER)
    second = layers.materialise_all({"t": new}, root, layers.SILVER)
    assert rows_of(changes.between(first, second, "t")) == expected
    assert changes.between(first, second, "same").collect() == []
    assert rows_of(changes.between(layers.opened(spark, root, "none"), first, "t")) == [
        (1, "a", 2), (2, None, 1), (3, "c", 1),
    ]
