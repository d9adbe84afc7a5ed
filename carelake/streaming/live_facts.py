"""Patient facts that follow changes of all seven tables.

Each table arrives as a stream of changes (:mod:`carelake.streaming.changes`).  A
micro-batch is reduced to signed sums per key, which are kept below one folder
per table (:class:`carelake.streaming.sums.Sums`): what a policy, an admission
or a patient has added is taken back by adding it with the opposite sign, so no
row is ever looked for.  The sums, and all that follows from them, are the same
however the changes are split into micro-batches, repeated after a crash, or
ordered.

``refresh`` brings the facts up to the sums.  Patients are dealt into buckets.
A change touches the bucket of its patient; that of a hospital touches the
buckets of patients admitted there, that of a plan those of its holders.  Only
touched buckets are read from the sums, computed and written; the others' files
stay part of the new version.  The facts and how far they have followed each
table are published in one manifest, so a crash at any point leaves the version
before, and the next refresh does the rest.

Ages depend on the day of reading, so the kept facts have dates of birth instead
and ``read`` forms the ages.  Feeds are followed and refreshed by one process.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from carelake.functions import features
from carelake.functions.dates import age_in_365_days, parse_day
from carelake.operators.cleaning import harmonise_date
from carelake.operators.summaries import ratio, whole
from carelake.plans.facts import FACTS, calendar_of, policy_facts
from carelake.sources import layers
from carelake.sources.filesystem import FileSystem
from carelake.streaming.changes import CHANGE, as_changes
from carelake.streaming.sums import BATCHES, Sums

DATASET = "patients_live_facts"
BUCKET = "bucket"
BUCKETS = 64
_LEVELS = {level: f"n_{level}".lower().replace(" ", "_") for level in features.RISK_LEVELS}


def _signed(value: Column | int = 1, where: Column | None = None) -> Column:
    """Sum of a value over the rows that come, less that over the rows taken back."""
    term = F.col(CHANGE) * (F.lit(value) if isinstance(value, int) else value)
    term = term if where is None else F.when(where, term)
    return F.sum(F.coalesce(term, F.lit(0)))


def _known(column: str) -> Column:
    return _signed(where=F.col(column).isNotNull())


@dataclass(frozen=True)
class Kept:
    """How a table's changes become sums: its rows by ``keys``, added up as ``sums`` say."""

    keys: dict[str, str]
    sums: Callable[[], dict[str, Column]]
    prepared: Callable[[DataFrame], DataFrame] = lambda rows: rows
    doubles: tuple[str, ...] = ()

    @property
    def of_patients(self) -> bool:
        return "patient_id" in self.keys

    @property
    def schema(self) -> str:
        bucket = [f"{BUCKET} int"] if self.of_patients else []
        keys = [f"{name} {kind}" for name, kind in self.keys.items()]
        return ", ".join([*bucket, *keys, *(f"{s} {'double' if s in self.doubles else 'bigint'}" for s in self.sums())])

    @property
    def key_names(self) -> list[str]:
        return [*([BUCKET] if self.of_patients else []), *self.keys]

    def reduced(self, rows: DataFrame, buckets: int) -> DataFrame:
        """One row per key that changed; null patients, hospitals and plans never join."""
        rows = self.prepared(as_changes(rows)).filter(F.col(next(iter(self.keys))).isNotNull())
        if self.of_patients:
            rows = rows.withColumn(BUCKET, bucket_of(F.col("patient_id"), buckets))
        return rows.groupBy(*self.key_names).agg(*(c.alias(name) for name, c in self.sums().items()))


def bucket_of(patient: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(patient), F.lit(buckets)).cast("int")


def _with_conditions(rows: DataFrame) -> DataFrame:
    total = rows.withColumn("tot", features.condition_total())
    return total.withColumn("risk", features.risk(F.col("tot")))


KEPT = {
    "patients": Kept(
        {"patient_id": "string", "full_name": "string", "dob": "string"},
        lambda: {"times": _signed()},
        lambda rows: harmonise_date(rows, "dob"),
    ),
    "patient_history": Kept(
        {"patient_id": "string"},
        lambda: {
            "histories": _signed(), "conditions": _signed(F.col("tot")), "counted": _known("tot"),
            **{name: _signed(where=F.col("risk") == level) for level, name in _LEVELS.items()},
        },
        _with_conditions,
    ),
    "new_admissions": Kept(
        {"patient_id": "string", "hospital_id": "string", "day": "date"},
        lambda: {
            "admissions": _signed(), "ids": _known("admission_id"), "days": _signed(F.col("duration_of_stay")),
            "days_known": _known("duration_of_stay"),
        },
        lambda rows: harmonise_date(rows, "d_o_a").withColumn("day", parse_day(F.col("d_o_a"))),
    ),
    "policies_new": Kept(
        {"patient_id": "string", "policy_number": "string", "plan_id": "string", "policy_end_date": "date"},
        lambda: {"policies": _signed()},
    ),
    "patient_device_stream": Kept(
        {"patient_id": "string"},
        lambda: {
            "readings": _signed(), "rated": _known("heart_rate_per_minute"),
            "rate_sum": _signed(F.col("heart_rate_per_minute")),
        },
        doubles=("rate_sum",),
    ),
    "hospitals": Kept(
        {"hosp_id": "string"}, lambda: {"hospitals": _signed(), "located": _known("location")}
    ),
    "plans": Kept(
        {"plan_id": "string"},
        lambda: {"plans": _signed(), "covered": _signed(F.col("full")), "covered_known": _known("full")},
        lambda rows: rows.withColumn("full", features.full_coverage()),
    ),
}


class LiveFacts:
    """The sums and facts below one folder."""

    def __init__(self, spark: SparkSession, folder: str, *, buckets: int = BUCKETS) -> None:
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets
        self.sums = {
            name: Sums(
                spark, f"{self.folder}/sums/{name}", kept.schema, kept.key_names,
                cluster=BUCKET if kept.of_patients else None,
            )
            for name, kept in KEPT.items()
        }

    # --- following the feeds ---------------------------------------------------

    def follow(self, name: str, feed: DataFrame, *, trigger: dict[str, object] | None = None) -> StreamingQuery:
        """Start adding a table's changes to its sums; by default those there now."""
        kept, sums = KEPT[name], self.sums[name]
        writer = feed.writeStream.foreachBatch(
            lambda batch, batch_id: sums.store(kept.reduced(batch, self.buckets), batch_id, merge=False)
        ).option("checkpointLocation", f"{self.folder}/checkpoints/{name}")
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def run(self, feeds: dict[str, DataFrame]) -> layers.Layer:
        """Work off what has arrived in the feeds, then bring the facts up to it."""
        for query in [self.follow(name, feed) for name, feed in feeds.items()]:
            query.awaitTermination()
        return self.refresh()

    # --- the facts -----------------------------------------------------------------

    def _followed(self, layer: layers.Layer) -> dict[str, int]:
        """The last batch of each table that the facts contain."""
        stored = layer.datasets.get(DATASET)
        return json.loads(stored.about.properties["followed"]) if stored else dict.fromkeys(KEPT, -1)

    def _touched(self, followed: dict[str, int], upto: dict[str, int]) -> list[int]:
        """Buckets whose facts the changes since can differ in; at most ``buckets`` numbers."""

        def since(name: str) -> DataFrame:
            return self.sums[name].since(followed[name], upto=upto[name])

        def all_of(name: str) -> DataFrame:
            return self.sums[name].read(upto=upto[name])

        moved_on = {name for name in KEPT if upto[name] > followed[name]}
        changed = [since(name).select(BUCKET) for name in sorted(moved_on) if KEPT[name].of_patients]
        if "hospitals" in moved_on:
            moved = since("hospitals").select(F.col("hosp_id").alias("hospital_id"))
            changed.append(all_of("new_admissions").join(moved, "hospital_id", "left_semi").select(BUCKET))
        if "plans" in moved_on:
            changed.append(all_of("policies_new").join(since("plans"), "plan_id", "left_semi").select(BUCKET))
        if not changed:
            return []
        return sorted(r[BUCKET] for r in reduce(DataFrame.unionAll, changed).distinct().collect())

    def computed(self, buckets: list[int] | None = None, upto: dict[str, int] | None = None) -> DataFrame:
        """The facts of all patients or of some buckets, from the sums."""
        chosen = None if buckets is None else F.col(BUCKET).isin(buckets)

        def there(name: str, count: str) -> DataFrame:
            where = chosen if KEPT[name].of_patients else None
            sums = self.sums[name].read(where, upto=upto[name] if upto else None)
            # What has been taken back is not there; its key may stay for a while.
            return sums.where(F.col(count) > 0)

        people = there("patients", "times").groupBy("patient_id", "dob").agg(F.count(F.lit(1)).alias("persons"))
        history = there("patient_history", "histories").select(
            "patient_id", "histories", ratio("conditions", "counted").alias("conditions"),
            features.mode_of({level: F.col(name) for level, name in _LEVELS.items()}).alias("patient_risk"),
        )
        readings = there("patient_device_stream", "readings").drop(BUCKET)
        admitted = (
            there("new_admissions", "admissions")
            .join(there("hospitals", "hospitals"), F.col("hospital_id") == F.col("hosp_id"))
            .groupBy("patient_id", "day")
            .agg(
                *(F.sum(F.col(c) * F.col("hospitals")).alias(c) for c in ("admissions", "ids")),
                F.sum(F.when(F.col("days_known") > 0, F.col("days") * F.col("hospitals"))).alias("days"),
                F.sum(F.col("admissions") * F.col("located")).alias("places"),
            )
        )
        policies = there("policies_new", "policies")
        ends = policies.select("patient_id", F.col("policy_end_date").alias("day")).distinct()
        sold = policies.drop(BUCKET).join(there("plans", "plans"), "plan_id").withColumns(
            {c: F.col("policies") * F.col(c) for c in ("covered", "covered_known")}
        )
        known = people.join(history, "patient_id").join(readings, "patient_id")
        return policy_facts(
            calendar_of(admitted, ends), known, sold, by="dob", factors=["histories", "readings"],
            copies=("policies", "plans"), carried=("persons",),
        ).withColumn(BUCKET, bucket_of(F.col("patient_id"), self.buckets))

    def refresh(self) -> layers.Layer:
        """Bring the facts up to the sums and publish them; writes touched buckets only."""
        layer = layers.opened(self.spark, self.folder, layers.GOLD)
        followed = self._followed(layer)
        upto = {name: sums.last() for name, sums in self.sums.items()}
        if upto != followed:
            stored = self._rewritten(layer, self._touched(followed, upto), upto)
            layer = layers.publish(self.spark, self.folder, layers.GOLD, {DATASET: stored}, expected=layer.version)
        for name, sums in self.sums.items():
            sums.merge(least=BATCHES, upto=upto[name])
        return layer

    def _rewritten(self, layer: layers.Layer, touched: list[int], upto: dict[str, int]) -> layers.Stored:
        rows = self.computed(touched, upto)
        path = layers.location(self.folder, layers.GOLD, DATASET)
        kept = layer.datasets.get(DATASET)
        folders = [f for f in (kept.folders if kept else ()) if int(f.rpartition("=")[2]) not in touched]
        if touched:
            run = layers.new_folder()
            # Adaptive execution splits a bucket that is much larger than others.
            rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/{run}")
            found = (e.name for e in FileSystem(self.spark).entries(f"{path}/{run}"))
            folders += [f"{run}/{name}" for name in found if name.startswith(f"{BUCKET}=")]
        about = layers.About(
            "Patient facts that follow their tables' changes",
            {"quality": layers.GOLD, "followed": json.dumps(upto)},
        )
        stored = layers.Stored(tuple(folders), rows.drop(BUCKET).schema.json(), 0, about)
        trial = replace(layer, datasets={**layer.datasets, DATASET: stored})
        return replace(stored, rows=trial.read(DATASET).count())  # from the files' footers

    def read(self, *, as_of: dt.date | None = None) -> DataFrame:
        """The facts as last refreshed, at the ages of the day: the columns of ``patient_facts``."""
        layer = layers.opened(self.spark, self.folder, layers.GOLD)
        return at_age(layer.read(DATASET) if DATASET in layer.datasets else self.computed([]), as_of)


def at_age(facts: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Facts per date of birth as facts per age: totals count once per person of that age."""
    totals = (
        "number_of_hospital_admissions", "total_hospital_days_of_patient", "no_of_cross_city_admissions",
    )
    keys = ("patient_id", "policy_number", "age_of_patient")
    aged = facts.withColumn("age_of_patient", age_in_365_days(F.col("dob"), as_of))
    grouped = aged.groupBy(*keys).agg(
        *(whole(F.sum(F.col(c) * F.col("persons").cast("decimal(19,0)"))).alias(c) for c in totals),
        *(F.any_value(c).alias(c) for c in FACTS if c not in (*keys, *totals)),
    )
    return grouped.select(*FACTS)

