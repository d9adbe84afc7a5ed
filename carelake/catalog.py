"""All registered queries: name to a function of session and star-schema folder.

Averages of decimals come out in different last digits with the order of
summation, so the catalogue rounds its doubles to four places; the jobs do not.
The jobs' totals are exact decimals; the catalogue returns them as bigint and
fails on one that does not fit.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, StructField

from carelake import schemas
from carelake.functions import dates, features, naming
from carelake.operators import cleaning, history, quality
from carelake.operators.summaries import steady_round
from carelake.plans import distinct_counts, facts, incremental, insights, medallion, questions
from carelake.sources import files, inference, layers, scratch
from carelake.sources.star import Star, as_readings
from carelake.streaming import live_facts, readings
from carelake.tables import CareTables

AS_OF = dt.date(2002, 1, 1)
Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    def shown(field: StructField) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, DoubleType):
            value = steady_round(value, digits)
        elif isinstance(field.dataType, DecimalType):
            value = value.cast("bigint")
        return value.alias(field.name)

    return df.select(*map(shown, df.schema))


def clean(spark: SparkSession, sf_dir: str, *, with_stay: bool = True) -> CareTables:
    return cleaning.clean_tables(Star(spark, sf_dir).tables(with_stay=with_stay))


def _over_clean(job: Callable[..., DataFrame], *, with_stay: bool = True, **options) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(job(clean(spark, sf_dir, with_stay=with_stay), **options))

    return query


# --- raw files with awkward headers -----------------------------------------


def _history_header(name: str) -> str:
    return name.upper().replace("_", " ")


# Raw headers the admission and device rules have to cope with.
ADMISSION_HEADERS = {
    "d_o_a": "D.O.A",
    "type_of_admission_emergency_or_opd": "TYPE OF ADMISSION-EMERGENCY/OPD",
}
DEVICE_HEADERS = {
    "patient_id": "Patient ID",
    "heart_rate_per_minute": " Heart Rate (per minute) ",
}


def _raw_headers(table: str, df: DataFrame) -> DataFrame:
    if table in ("patients", "patient_history"):
        return df.toDF(*map(_history_header, df.columns))
    if table == "new_admissions":
        return df.toDF(*(ADMISSION_HEADERS.get(c, _history_header(c)) for c in df.columns))
    return df


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(
        path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def _csv_scan(
    spark: SparkSession, sf_dir: str, *, table: str, infer: bool = True
) -> DataFrame:
    path = f"{scratch.new_folder(spark, 'csv')}/{table}.csv"
    _write_csv(_raw_headers(table, getattr(Star(spark, sf_dir), table)()), path)
    return files.read_csv(
        spark,
        path,
        rule=medallion.HEADER_RULES.get(table),
        schema=None if infer else schemas.BATCH[table],
    )


def csv_landed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of all six files with the types found as they were landed, and what the files hold."""
    folder = scratch.new_folder(spark, "landed")
    found = []
    for name in schemas.BATCH:
        _write_csv(getattr(Star(spark, sf_dir), name)(), f"{folder}/{name}.csv")
        typed, kinds = inference.land(spark.read.csv(f"{folder}/{name}.csv", header=True), f"{folder}/{name}")
        types = {c: inference.type_of(kinds[c]).simpleString() for c in typed.columns}
        counted = typed.agg(*(F.count(f"`{c}`").alias(c) for c in typed.columns))
        columns = F.array(
            *(F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.col(f"`{c}`").alias("present"))
              for c in typed.columns)
        )
        found.append(counted.select(F.lit(name).alias("table"), F.inline(columns)))
    return reduce(DataFrame.unionAll, found)


def _device_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*(DEVICE_HEADERS[c] for c in df.columns))


def normalize_columns_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _device_headers(Star(spark, sf_dir).readings())
    return naming.rename(raw, naming.device)


def sql_over_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    files.register_views(clean(spark, sf_dir), "policies_new", "plans")
    return rounded(
        spark.sql(
            "SELECT payment_type, count(*) AS policies, "
            "avg(daily_premium) AS avg_daily_premium "
            "FROM policies_new JOIN plans USING (plan_id) "
            "WHERE daily_premium > :least GROUP BY payment_type",
            args={"least": 1000},
        )
    )


# --- cleaning, quality, features ----------------------------------------------


def clean_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    admissions = cleaning.clean_admissions(Star(spark, sf_dir).new_admissions(with_stay=False))
    day = dates.parse_day(F.col("d_o_a"))
    return admissions.select("admission_id", "d_o_a", day.alias("admitted"))


def clean_hospitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_hospitals(Star(spark, sf_dir).hospitals())


def clean_patients(
    spark: SparkSession,
    sf_dir: str,
    *,
    exclude: tuple[str, str] | None = None,
    mode: str = "either",
) -> DataFrame:
    return cleaning.clean_patients(Star(spark, sf_dir).patients(), exclude, mode)


def expect_drop_hospitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.enforce(Star(spark, sf_dir).hospitals(), quality.HOSPITAL_HAS_ID)


def expect_warn_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hospitals = quality.violations(Star(spark, sf_dir).hospitals(), quality.HOSPITAL_HAS_ID)
    rates = Star(spark, sf_dir).readings()
    return hospitals.unionByName(quality.violations(rates, quality.HEART_RATE_VALID))


def _from_bitmaps(question: Callable[..., DataFrame], t: CareTables) -> DataFrame:
    """A question over bitmaps that are kept in a layer; all rows are taken in first."""
    spark = t.hospitals.sparkSession
    root = scratch.new_folder(spark, "distinct")
    kept = distinct_counts.add(spark, root, admissions=t.new_admissions, policies=t.policies_new)
    return question(kept, t)


def feature_risk(t: CareTables) -> DataFrame:
    return facts.with_risk(t.patient_history)


def feature_heart_lung(t: CareTables) -> DataFrame:
    return t.patient_history.select(
        "patient_id",
        features.heart_disease().alias("heart_disease"),
        features.lung_disease().alias("lung_disease"),
    )


def feature_admission_flags(t: CareTables) -> DataFrame:
    return t.new_admissions.select(
        "admission_id",
        features.icu_admission().alias("icu_admission"),
        features.died().alias("mortality_rate"),
    )


def feature_ages(t: CareTables) -> DataFrame:
    dob = F.col("dob")
    return t.patients.select(
        "patient_id",
        dates.age_by_calendar_year(dob, AS_OF).alias("calendar_age"),
        dates.age_in_full_years(dob, AS_OF).alias("full_years"),
        dates.age_in_365_days(dob, AS_OF).alias("age_of_patient"),
    )


def feature_coverage(t: CareTables) -> DataFrame:
    return t.plans.select("plan_id", features.full_coverage().alias("insurance_coverage"))


def feature_active_policy(t: CareTables) -> DataFrame:
    return facts.policy_calendar(t).select(
        "patient_id", "policy_end_date", "active", "admissions"
    )


# --- streams and layers ---------------------------------------------------------


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as an unbounded table under device headers, then normalised.

    The pattern matches one name, be it a file or a folder of files.
    """
    schema = Star(spark, sf_dir).table("events").schema
    events = files.stream_parquet(spark, f"{sf_dir}/event[s].parquet", schema)
    return naming.rename(_device_headers(as_readings(events)), naming.device)


def stream_clean_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch.new_folder(spark, "readings")
    stream = _events_stream(spark, sf_dir)
    readings.land(stream, f"{folder}/table", f"{folder}/checkpoint", quality=True)
    return spark.read.schema(schemas.READINGS).parquet(f"{folder}/table")


def _device_layouts(rows: DataFrame) -> list[DataFrame]:
    """Three deliveries of readings: whole numbers; with a kind of device; as text, not all of it numbers."""
    patient, rate = (F.col(c) for c in rows.columns)
    turn = F.round(rate * 100).cast("bigint") % 3
    named = rows.withColumn("turn", turn)
    text = F.when(rate < 60, F.concat(F.lit("about "), rate.cast("int").cast("string"))).otherwise(rate.cast("string"))
    kind = F.when(rate > 100, "band").otherwise("clip")
    return [
        named.where("turn = 0").select(patient.alias("Patient ID"), rate.cast("int").alias(" Heart Rate (per minute) ")),
        named.where("turn = 1").select(
            patient.alias("patient id"), rate.alias("Heart Rate (per minute)"), kind.alias("Kind of Device")
        ),
        named.where("turn = 2").select(patient.alias("patient_id"), text.alias("heart_rate_per_minute")),
    ]


def stream_grown_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings delivered in three layouts, in the schema that they come to."""
    folder = scratch.new_folder(spark, "grown")
    for rows in _device_layouts(Star(spark, sf_dir).readings()):
        rows.write.mode("append").parquet(f"{folder}/in")
        readings.run_stream(spark, f"{folder}/in", f"{folder}/out")
    return rounded(layers.landed(spark, f"{folder}/out", layers.SILVER, readings.CLEAN))


def stream_quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch.new_folder(spark, "quality")
    return readings.count_violations(
        _events_stream(spark, sf_dir), f"{folder}/counts", f"{folder}/checkpoint"
    )


def stream_joined_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch.new_folder(spark, "joined")
    patients = cleaning.clean_patients(Star(spark, sf_dir).patients())
    stream = readings.with_patients(_events_stream(spark, sf_dir), patients)
    readings.land(stream, f"{folder}/table", f"{folder}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{folder}/table")


def stream_patient_heart_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch.new_folder(spark, "rates")
    readings.maintain_heart_rates(
        _events_stream(spark, sf_dir), f"{folder}/sums", f"{folder}/checkpoint"
    )
    patients = cleaning.clean_patients(Star(spark, sf_dir).patients())
    summary = readings.live_summary(spark, f"{folder}/sums")
    return readings.heart_rates(summary, patients, as_of=AS_OF)


# What a first, wrong version of a row says instead.
EARLIER = {
    "hospitals": {"location": "CAST(NULL AS string)"},
    "new_admissions": {"duration_of_stay": "duration_of_stay + 3", "d_o_a": "'1/2/1991'"},
    "patients": {"dob": "'02-01-1950'"},
    "patient_history": {"smoking_": "1 - smoking_", "dm": "1"},
    "plans": {"dental_care": "NOT dental_care"},
    "policies_new": {"policy_end_date": "date_add(policy_end_date, 400)", "plan_id": "'PLAN-01'"},
    "patient_device_stream": {"heart_rate_per_minute": "heart_rate_per_minute + 50"},
}


def _feeds(t: CareTables) -> dict[str, list[DataFrame]]:
    """Each table as two deliveries of changes that together come to its rows.

    Every second row comes with the second delivery.  Three rows in ten are
    first delivered with wrong values, which the second takes back.
    """
    feeds = {}
    for name, rows in t.items():
        draw = F.pmod(F.xxhash64(*rows.columns), F.lit(10))
        drawn = rows.withColumns({"_draw": draw, "change": F.lit(1)})
        wrong = drawn.where("_draw < 3").withColumns({c: F.expr(e) for c, e in EARLIER[name].items()})
        first = drawn.where("_draw >= 5").unionByName(wrong).drop("_draw")
        second = drawn.where("_draw < 5").unionByName(wrong.withColumn("change", F.lit(-1))).drop("_draw")
        feeds[name] = [first, second]
    return feeds


def stream_patient_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live facts after two deliveries, the second of which corrects the first."""
    folder = scratch.new_folder(spark, "live")
    live = live_facts.LiveFacts(spark, f"{folder}/facts", buckets=16)
    feeds = _feeds(Star(spark, sf_dir).tables())
    for delivery in range(2):
        with ThreadPoolExecutor(len(feeds)) as pool:
            for written in [
                pool.submit(deliveries[delivery].write.mode("append").parquet, f"{folder}/in/{name}")
                for name, deliveries in feeds.items()
            ]:
                written.result()
        live.run({
            name: files.stream_parquet(spark, f"{folder}/in/{name}", deliveries[0].schema)
            for name, deliveries in feeds.items()
        })
    return rounded(live.read(as_of=AS_OF))


def _layered_run(spark: SparkSession, sf_dir: str, **options) -> str:
    """Raw files out, stream and batch run over them; returns the folder of the layers."""
    folder = scratch.new_folder(spark, "layers")
    raw = Star(spark, sf_dir).tables()
    with ThreadPoolExecutor(len(schemas.BATCH)) as pool:
        for written in [
            pool.submit(
                _write_csv, _raw_headers(name, getattr(raw, name)), f"{folder}/in/{name}.csv"
            )
            for name in schemas.BATCH
        ]:
            written.result()
    _device_headers(raw.patient_device_stream).write.parquet(f"{folder}/in/readings")
    readings.run_stream(spark, f"{folder}/in/readings", f"{folder}/out")
    medallion.run_batch(spark, f"{folder}/in", f"{folder}/out", as_of=AS_OF, **options)
    return f"{folder}/out"


def layered(spark: SparkSession, sf_dir: str, *, fact: str) -> DataFrame:
    """A gold table of a layered run."""
    return rounded(layers.dataset(spark, _layered_run(spark, sf_dir), layers.GOLD, fact))


def bucketed_patient_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts over silver tables that lie in files by patient."""
    silver = medallion.silver_tables(spark, _layered_run(spark, sf_dir, buckets=8))
    return rounded(facts.patient_facts(silver, as_of=AS_OF))


def quality_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two batch runs and two deliveries of readings have failed."""
    folder = scratch.new_folder(spark, "history")
    out, star = f"{folder}/out", Star(spark, sf_dir)
    rows = _device_headers(star.readings())
    high = F.col("` Heart Rate (per minute) `") >= 200
    for delivery in (rows.where(~high), rows.where(high)):
        delivery.write.mode("append").parquet(f"{folder}/in")
        readings.run_stream(spark, f"{folder}/in", out)
    raw = {name: table for name, table in star.tables().items() if name in schemas.BATCH}
    for _ in range(2):
        medallion.refine(raw, out)
    return history.history(spark, out, layers.SILVER, [readings.CLEAN])


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admissions that arrive in two deliveries and are taken by three runs."""
    folder = scratch.new_folder(spark, "ingest")
    rows = _raw_headers("new_admissions", Star(spark, sf_dir).new_admissions())
    for late in (False, True):
        part = rows.where((F.col("`ADMISSION ID`") % 3 == 0) == F.lit(late))
        part.write.mode("append").csv(
            f"{folder}/in/new_admissions.csv", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
        incremental.ingest_new(spark, f"{folder}/in", f"{folder}/out")
    bronze, taken = incremental.ingest_new(spark, f"{folder}/in", f"{folder}/out")
    if taken or bronze.version != 2:
        raise RuntimeError(f"a run without new files took {taken} and made version {bronze.version}")
    return bronze.read("new_admissions_raw")


def layered_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the manifests of a layered run say of its datasets."""
    out = _layered_run(spark, sf_dir)
    found = [layers.opened(spark, out, name) for name in (layers.BRONZE, layers.SILVER, layers.GOLD)]
    return layers.inventory(found).withColumn("quality", F.col("properties")["quality"]).drop("properties")


OTHER_TIERS = {"top_admissions": 300, "mid_admissions": 100}

QUERIES: dict[str, Query] = {
    "csv_scan_inferred": partial(_csv_scan, table="hospitals"),
    "csv_scan_policies": partial(_csv_scan, table="policies_new"),
    "csv_scan_plans": partial(_csv_scan, table="plans"),
    "csv_landed_types": csv_landed_types,
    "normalize_columns_basic": partial(_csv_scan, table="patient_history", infer=False),
    "normalize_columns_admissions": partial(_csv_scan, table="new_admissions", infer=False),
    "normalize_columns_stream": normalize_columns_stream,
    "sql_over_views": sql_over_views,
    "clean_dates": clean_dates,
    "clean_hospitals": clean_hospitals,
    "clean_patients_dedup": clean_patients,
    "exclude_rows_either": partial(
        clean_patients, exclude=("Customer#000000007", "P0000011"), mode="either"
    ),
    "exclude_rows_pair": partial(
        clean_patients, exclude=("Customer#000000007", "P0000007"), mode="pair"
    ),
    "expect_drop_hospitals": expect_drop_hospitals,
    "expect_warn_counts": expect_warn_counts,
    "feature_risk": _over_clean(feature_risk),
    "feature_heart_lung": _over_clean(feature_heart_lung),
    "feature_admission_flags": _over_clean(feature_admission_flags),
    "feature_ages": _over_clean(feature_ages),
    "feature_coverage": _over_clean(feature_coverage),
    "feature_active_policy": _over_clean(feature_active_policy),
    "hospital_facts": _over_clean(facts.hospital_facts),
    "patient_facts": _over_clean(facts.patient_facts, as_of=AS_OF),
    "patient_facts_dedup": _over_clean(facts.patient_facts, as_of=AS_OF, per_reading=False),
    "policy_holders": _over_clean(facts.policy_holders, as_of=AS_OF),
    "q1_above_avg_premium": _over_clean(questions.above_average_premium),
    "q2a_cover_share": _over_clean(questions.cover_share),
    "q2b_plan_premium": _over_clean(questions.plan_premium),
    "q3_branch_conditions": _over_clean(questions.branch_conditions),
    "q4_branch_tier": _over_clean(questions.branch_tier, as_of=AS_OF),
    "q4_branch_tier_lower": _over_clean(questions.branch_tier, as_of=AS_OF, **OTHER_TIERS),
    "q5_plan_month": _over_clean(questions.plan_month_admissions, with_stay=False),
    "q6_plan_change": _over_clean(questions.plan_changes),
    "q7_age_condition": _over_clean(questions.age_conditions, as_of=AS_OF),
    "i01_hospitals_per_sector": _over_clean(insights.hospitals_per_sector),
    "i02_beds_per_state": _over_clean(insights.beds_per_state),
    "i03_smokers": _over_clean(insights.smokers),
    "i04_busiest_hospitals": _over_clean(insights.busiest_hospitals),
    "i05_diabetes_and_hypertension": _over_clean(insights.diabetes_and_hypertension),
    "i06_premium_per_plan": _over_clean(insights.premium_per_plan),
    "i07_heart_failure": _over_clean(insights.heart_failure),
    "i08_coverage_per_plan": _over_clean(insights.coverage_per_plan),
    "i09_plan_outcomes": _over_clean(insights.plan_outcomes),
    "i10_resource_use": _over_clean(insights.resource_use),
    "i10_resource_use_kept": _over_clean(partial(_from_bitmaps, distinct_counts.resource_use)),
    "i12_plan_popularity_kept": _over_clean(partial(_from_bitmaps, distinct_counts.plan_popularity)),
    "i13_long_term_patients_kept": _over_clean(partial(_from_bitmaps, distinct_counts.long_term_patients)),
    "i11_sector_demographics": _over_clean(insights.sector_demographics, as_of=AS_OF),
    "i12_plan_popularity": _over_clean(insights.plan_popularity),
    "i13_long_term_patients": _over_clean(insights.long_term_patients),
    "i14_patients_per_hospital": _over_clean(insights.patients_per_hospital),
    "i15_emergencies_per_day": _over_clean(insights.emergencies_per_day, with_stay=False),
    "i15_admissions_per_day_other": _over_clean(
        insights.emergencies_per_day, with_stay=False, admission_type="O"
    ),
    "i16_patients_per_place": _over_clean(insights.patients_per_place),
    "i17_emergency_deaths_per_month": _over_clean(insights.emergency_outcomes_per_month),
    "i17_emergency_discharges_per_month": _over_clean(
        insights.emergency_outcomes_per_month, outcome=insights.DISCHARGE
    ),
    "i18_stay_to_discharge": _over_clean(insights.stay_to_discharge),
    "i19_beds_per_place": _over_clean(insights.beds_per_place),
    "i20_public_hospitals_per_place": _over_clean(insights.sector_hospitals_per_place),
    "i20_private_hospitals_per_place": _over_clean(
        insights.sector_hospitals_per_place, sector="Private"
    ),
    "i21_hospitals_per_place": _over_clean(insights.hospitals_per_place),
    "mode_usual_hospitals": _over_clean(insights.usual_hospitals),
    "stream_clean_readings": stream_clean_readings,
    "stream_quality_counts": stream_quality_counts,
    "stream_patient_heart_rate": stream_patient_heart_rate,
    "stream_joined_readings": stream_joined_readings,
    "stream_patient_facts": stream_patient_facts,
    "stream_grown_readings": stream_grown_readings,
    "layered_hospital_facts": partial(layered, fact="hospital_agg_facts"),
    "layered_patient_facts": partial(layered, fact="patients_agg_facts"),
    "layered_inventory": layered_inventory,
    "incremental_ingest": incremental_ingest,
    "quality_history": quality_history,
    "bucketed_patient_facts": bucketed_patient_facts,
}
