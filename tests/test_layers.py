"""The layered run from raw files to gold, and the same jobs over its silver tables."""

import datetime as dt
import os

import pytest

from carelake import catalog, schemas
from carelake.operators.cleaning import clean_tables
from carelake.plans import facts, insights, medallion
from carelake.sources import filesystem, layers
from carelake.streaming import readings
from tests.messy import messy_rows, spark_tables
from tests.plans import plan_of


def rows_of(df):
    return sorted((tuple(r) for r in catalog.rounded(df).collect()), key=repr)


@pytest.fixture(scope="module")
def raw(spark):
    return spark_tables(spark, messy_rows(6))


@pytest.fixture(scope="module")
def folders(spark, raw, tmp_path_factory):
    root = tmp_path_factory.mktemp("layers")
    source, out = str(root / "in"), str(root / "out")
    for name in schemas.BATCH:
        df = getattr(raw, name).coalesce(1)
        catalog._write_csv(catalog._raw_headers(name, df), f"{source}/{name}.csv")
    catalog._device_headers(raw.patient_device_stream).write.parquet(f"{source}/readings")
    readings.run_stream(spark, f"{source}/readings", out)
    return source, out


def unreadable(raw):
    """Rows whose date is there and no date, of admissions and of distinct patients."""
    clean = clean_tables(raw)
    bad = "{0} IS NOT NULL AND try_to_date({0}, 'dd-MM-yyyy') IS NULL"
    return {
        "readable d_o_a": clean.new_admissions.filter(bad.format("d_o_a")).count(),
        "readable dob": clean.patients.filter(bad.format("dob")).count(),
    }


def test_unreadable_dates_are_counted(spark, raw, tmp_path):
    tables = dict(raw.items())
    rows = [("P1", "Ann", "1/2/1990"), ("P2", "Bo", None), ("P3", "Cy", "no date"), ("P4", "Di", "31-02-1990")]
    tables["patients"] = spark.createDataFrame(rows, schemas.PATIENTS)
    tables.pop("patient_device_stream")
    _, counts = medallion.refine(tables, str(tmp_path))
    assert counts["readable dob"] == 2
    assert counts["readable d_o_a"] == unreadable(raw)["readable d_o_a"]


def test_a_failed_write_leaves_the_layer_as_it_was(spark, tmp_path):
    root = str(tmp_path)
    layers.materialise_all({"a": spark.range(3), "b": spark.range(4)}, root, layers.GOLD)
    broken = spark.range(5).selectExpr("raise_error('broken') AS id")
    with pytest.raises(Exception, match="broken"):
        layers.materialise_all({"a": spark.range(9), "b": broken}, root, layers.GOLD)
    assert layers.dataset(spark, root, layers.GOLD, "a").count() == 3
    assert layers.dataset(spark, root, layers.GOLD, "b").count() == 4
    layers.materialise_all({"a": spark.range(9)}, root, layers.GOLD)
    assert layers.dataset(spark, root, layers.GOLD, "a").count() == 9


def folders_of(root, name):
    return {f for f in os.listdir(f"{root}/gold/{name}") if f.startswith("v-")}


def ages(days):
    return dt.timedelta(days=days)


def test_a_reader_keeps_its_version(spark, tmp_path):
    root = str(tmp_path)
    layers.materialise_all({"a": spark.range(3), "b": spark.range(3)}, root, layers.GOLD)
    before = layers.opened(spark, root, layers.GOLD)
    layers.materialise_all({"a": spark.range(5), "b": spark.range(5)}, root, layers.GOLD)
    assert [before.read(n).count() for n in "ab"] == [3, 3]
    now = layers.opened(spark, root, layers.GOLD)
    assert [now.read(n).count() for n in "ab"] == [5, 5]
    assert (before.version, now.version) == (1, 2)
    assert layers.opened(spark, root, layers.GOLD, 1).read("a").count() == 3
    with pytest.raises(KeyError, match="no c"):
        now.read("c")


@pytest.mark.parametrize("step", ["first write", "all written", "publishing"])
def test_a_crash_between_steps_shows_no_mixture(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path)
    layers.materialise_all({"a": spark.range(3), "b": spark.range(3)}, root, layers.GOLD)
    frames = {"a": spark.range(7), "b": spark.range(7)}

    def crash(*_):
        raise RuntimeError("crash")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="crash"):
        if step == "first write":
            layers.store_all({"a": frames["a"]}, root, layers.GOLD)
            crash()
        if step == "all written":
            layers.store_all(frames, root, layers.GOLD)
            crash()
        # The manifest is written in full, but has not got its name.
        patch.setattr(filesystem.FileSystem, "create", crash)
        layers.materialise_all(frames, root, layers.GOLD)
    now = layers.opened(spark, root, layers.GOLD)
    assert (now.version, now.read("a").count(), now.read("b").count()) == (1, 3, 3)
    # What the crash left is too young to go, then goes; the version stays.
    assert layers.expire(spark, root, layers.GOLD) == []
    left = {f"a/{f}" for f in folders_of(root, "a")} | {f"b/{f}" for f in folders_of(root, "b")}
    removed = layers.expire(spark, root, layers.GOLD, older_than=ages(0))
    assert len(removed) == {"first write": 1, "all written": 2, "publishing": 2}[step]
    assert set(removed) < left
    assert [now.read(n).count() for n in "ab"] == [3, 3]


def test_runs_that_publish_at_once_both_count(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    a = layers.store_all({"a": spark.range(3)}, root, layers.GOLD)
    b = layers.store_all({"b": spark.range(4)}, root, layers.GOLD)
    plain, raced = layers.opened, []

    def overtaken(*args):
        found = plain(*args)
        if not raced:
            raced.append(True)
            layers.publish(spark, root, layers.GOLD, b)
        return found

    monkeypatch.setattr(layers, "opened", overtaken)
    assert layers.publish(spark, root, layers.GOLD, a).version == 2
    now = plain(spark, root, layers.GOLD)
    assert now.read("a").count() == 3 and now.read("b").count() == 4
    with pytest.raises(filesystem.AlreadyThere):
        layers.publish(spark, root, layers.GOLD, a, expected=1)


def test_expired_versions_go_and_kept_ones_stay_whole(spark, tmp_path):
    root = str(tmp_path)
    layers.materialise_all({"a": spark.range(1), "b": spark.range(9)}, root, layers.GOLD)
    for n in (2, 3, 4):
        layers.materialise_all({"a": spark.range(n)}, root, layers.GOLD)
    removed = layers.expire(spark, root, layers.GOLD, keep=2, older_than=ages(0))
    assert len(removed) == 2 and layers.versions(spark, root, layers.GOLD) == [3, 4]
    for version in (3, 4):
        kept = layers.opened(spark, root, layers.GOLD, version)
        # b was written by the first run and is still part of every version.
        assert kept.read("a").count() == version and kept.read("b").count() == 9
    assert layers.expire(spark, root, layers.GOLD, keep=2, older_than=ages(0)) == []
    with pytest.raises(ValueError):
        layers.expire(spark, root, layers.GOLD, keep=0)


def test_manifests_say_what_datasets_are(spark, tmp_path):
    root = str(tmp_path)
    assert layers.opened(spark, root, layers.GOLD).datasets == {}
    about = {"a": layers.About("Numbers, it's \"said\"", {"quality": "gold", "owner": "é"})}
    empty = spark.createDataFrame([], "x array<int>, y string")
    layers.materialise_all({"a": spark.range(3), "b": empty}, root, layers.GOLD, about, based_on={"silver": 4})
    now = layers.opened(spark, root, layers.GOLD)
    assert now.based_on == {"silver": 4} and now.read("b").schema == empty.schema
    assert [tuple(r) for r in layers.inventory([now]).collect()] == [
        ("gold", 1, "a", about["a"].comment, about["a"].properties, 1, 3), ("gold", 1, "b", "", {}, 2, 0),
    ]


def test_run_batch_builds_gold(spark, raw, folders):
    source, out = folders
    counts = medallion.run_batch(spark, source, out, as_of=catalog.AS_OF)
    assert counts == {
        "rows": raw.hospitals.count(),
        "valid hosp_id": raw.hospitals.filter("hosp_id IS NULL").count(),
        **unreadable(raw),
    }
    t = clean_tables(raw)
    for name, direct in {
        "hospital_agg_facts": facts.hospital_facts(t),
        "patients_agg_facts": facts.patient_facts(t, as_of=catalog.AS_OF),
    }.items():
        gold = layers.dataset(spark, out, layers.GOLD, name)
        assert gold.columns == direct.columns
        assert rows_of(gold) == rows_of(direct)


def test_silver_tables_answer_insights_with_pushed_filters(spark, raw, folders):
    source, out = folders
    medallion.run_batch(spark, source, out, as_of=catalog.AS_OF)
    silver, t = medallion.silver_tables(spark, out), clean_tables(raw)
    assert rows_of(insights.plan_outcomes(silver)) == rows_of(insights.plan_outcomes(t))
    deaths = insights.emergency_outcomes_per_month(silver)
    assert rows_of(deaths) == rows_of(insights.emergency_outcomes_per_month(t))
    plan = plan_of(deaths)
    assert "EqualTo(outcome,EXPIRY)" in plan
    assert "EqualTo(type_of_admission_emergency_or_opd,E)" in plan
    assert "duration_of_intensive_unit_stay" not in plan


def test_exclusion_and_inference(spark, raw, folders):
    source, out = folders
    inferred = medallion.ingest(spark, source, f"{out}-inferred", infer=True)
    assert dict(inferred["policies_new"].dtypes)["policy_start_date"] == "date"
    assert dict(inferred["plans"].dtypes)["dental_care"] == "boolean"
    clean, _ = medallion.refine(inferred, f"{out}-inferred", exclude=("Ann", "P003"))
    patients = clean["patients"].collect()
    assert patients and all(p.full_name != "Ann" and p.patient_id != "P003" for p in patients)


def test_tables_by_patient_are_not_shuffled_again(spark, raw, folders):
    source, out = folders
    medallion.run_batch(spark, source, out, as_of=catalog.AS_OF, buckets=4)
    silver, t = medallion.silver_tables(spark, out), clean_tables(raw)
    assert rows_of(facts.patient_facts(silver, as_of=catalog.AS_OF)) == rows_of(
        facts.patient_facts(t, as_of=catalog.AS_OF)
    )
    settings = {
        "spark.sql.adaptive.enabled": "false",
        # Lets a join by patient and day take sides that lie by patient.
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        job = facts.patient_facts(silver, as_of=catalog.AS_OF)
        lines = job._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    scans = [line for line in lines if "FileScan" in line and "carelake_" in line]
    assert len(scans) == 5 and all("Bucketed: true" in line for line in scans)
    # What is left: days per patient, after admissions and ends are united, and the landed readings.
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2
    assert "Union" in lines[exchanges[0] + 1]
    assert any("heart_rate_per_minute" in line for line in lines[exchanges[1] :])


def test_a_hot_patient_keeps_a_table_in_plain_files(spark, tmp_path, monkeypatch):
    by = layers.Buckets("k", 4)
    rows = spark.range(100).selectExpr("if(id < 60, 'hot', concat('k', id)) AS k", "id")
    assert layers.is_even(rows, by)  # too few rows to matter
    monkeypatch.setattr(layers, "LEAST_SKEW", 10)
    assert not layers.is_even(rows, by)
    assert layers.is_even(rows.where("id >= 55"), by) and layers.is_even(rows.limit(0), by)
    root = str(tmp_path)
    version = layers.materialise_all({"t": rows, "u": rows}, root, layers.SILVER, buckets={"t": by})
    now = layers.opened(spark, root, layers.SILVER)
    assert now.datasets["t"].buckets == by and now.datasets["u"].buckets is None
    assert rows_of(now.read("t")) == rows_of(now.read("u")) == rows_of(version.read("t")) == rows_of(rows)
    assert now.datasets["t"].rows == 100
