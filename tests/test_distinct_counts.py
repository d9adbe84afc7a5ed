"""Kept bitmaps against distinct counts of the rows, for any split, repeat and crash."""

import random

import pytest
from pyspark.sql import functions as F

from carelake.operators import distinct
from carelake.plans import distinct_counts, insights
from carelake.sources import layers
from tests.messy import messy_rows, spark_tables

QUESTIONS = ("resource_use", "plan_popularity", "long_term_patients")


def rows_of(df):
    rows = [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()]
    return sorted(rows, key=repr)


def add_all(spark, root, t, parts):
    for i in range(parts):
        mine = F.pmod(F.xxhash64("patient_id"), F.lit(parts)) == i
        distinct_counts.add(spark, root, admissions=t.new_admissions.where(mine), policies=t.policies_new.where(mine))


@pytest.mark.parametrize(("seed", "parts"), [(1, 1), (2, 3)])
def test_questions_equal_those_over_rows(spark, tmp_path, seed, parts):
    t, root = spark_tables(spark, messy_rows(seed)), str(tmp_path)
    add_all(spark, root, t, parts)
    for folded in (False, True):
        kept = distinct_counts.fold(spark, root) if folded else layers.opened(spark, root, distinct_counts.LAYER)
        for name in QUESTIONS:
            got, want = getattr(distinct_counts, name)(kept, t), getattr(insights, name)(t)
            assert rows_of(got.select(want.columns)) == rows_of(want), name
    assert kept.read(distinct_counts.POLICIES).groupBy("plan_id", "word").count().where("count > 1").isEmpty()


def test_a_crash_and_a_rival_leave_the_counts(spark, tmp_path, monkeypatch):
    t, root = spark_tables(spark, messy_rows(3)), str(tmp_path)
    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="crash"):
        patch.setattr(layers, "publish", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("crash")))
        add_all(spark, root, t, 1)
    assert layers.opened(spark, root, distinct_counts.LAYER).datasets == {}
    add_all(spark, root, t, 1)
    present = layers.opened(spark, root, distinct_counts.LAYER)
    real = layers.publish

    def late(*args, **options):
        monkeypatch.setattr(layers, "publish", real)
        distinct_counts.fold(spark, root)
        return real(*args, **options)

    monkeypatch.setattr(layers, "publish", late)
    with pytest.raises(layers.AlreadyThere):
        distinct_counts.add(spark, root, admissions=t.new_admissions)
    kept = layers.opened(spark, root, distinct_counts.LAYER)
    assert kept.version == present.version + 1
    want = rows_of(insights.long_term_patients(t))
    assert rows_of(distinct_counts.long_term_patients(kept, t).select(insights.long_term_patients(t).columns)) == want


def test_bitmaps_of_any_number(spark):
    draw = random.Random(4)
    rows = [(draw.choice("ab"), draw.choice([None, -1, -64, -65, 0, 63, 64, 2**62, -(2**63), draw.randrange(300)])) for _ in range(900)]
    df = spark.createDataFrame([*rows, ("c", None)], "k string, v bigint")
    words = distinct.bitmaps(df, ["k"], "v")
    got = {r.k: r.n for r in distinct.counted(words.union(words), ["k"], "n").collect()}
    assert got == {k: len({v for j, v in rows if j == k and v is not None}) for k in "ab"}


def test_numbers_stay_and_go_on(spark, monkeypatch):
    monkeypatch.setattr(distinct, "GROUPS", 3)
    known = spark.createDataFrame([], "value string, number bigint")
    for some in (["a", "b", "b", None], ["c", "a", "d"], [], ["e", "b", ""]):
        new = distinct.unnumbered(spark.createDataFrame([(x,) for x in some], "value string"), known)
        known = spark.createDataFrame(known.union(new).collect(), known.schema)
    numbers = {r.value: r.number for r in known.collect()}
    assert set(numbers) == set("abcde") | {""} and len(set(numbers.values())) == 6
