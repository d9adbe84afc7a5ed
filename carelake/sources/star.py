"""The seven input tables derived from an order-and-supplier star schema.

Suppliers act as hospitals, customers as patients, every order as an admission
and as a policy, nations as plans and user events as device readings.  Identifiers are
padded but never cut, and the flag formulas work on small remainders, so both
hold for keys of any size.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.functions.features import CONDITIONS, LUNG_CONDITIONS
from carelake.tables import CareTables


def _padded(prefix: str, number: Column, width: int) -> Column:
    digits = number.cast("string")
    return F.concat(
        F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0"))
    )


def _mixed_spelling(key: Column, day: Column) -> Column:
    """A date as ``M/d/yyyy``, ``dd-MM-yyyy`` or ``MM/dd/yyyy`` text, by key."""
    return (
        F.when(key % 3 == 0, F.concat_ws("/", F.month(day), F.day(day), F.year(day)))
        .when(key % 3 == 1, F.date_format(day, "dd-MM-yyyy"))
        .otherwise(F.date_format(day, "MM/dd/yyyy"))
    )


# One prime per flag, in table order, and the flags set more often
# or less often than 6 in 101.
FLAG_PRIMES = dict(
    zip(
        CONDITIONS + LUNG_CONDITIONS,
        (3, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43, 47, 53, 59, 61, 67, 71, 73, 79, 83,
         89, 97, 101, 103),
        strict=True,
    )
)
FLAG_RATES = {
    "dm": 30, "htn": 30, "smoking_": 25, "alcohol": 30, "chest_infection": 8,
    "pulmonary_embolism": 4,
}


def as_readings(events: DataFrame) -> DataFrame:
    """Readings from events; works on a batch and on a streaming frame."""
    return events.select(
        _padded("P", F.col("user_id"), 7).alias("patient_id"),
        (40 + F.col("value")).alias("heart_rate_per_minute"),
    )


class Star:
    """The schema's Parquet tables below one folder; each is opened once, when needed."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark = spark
        self._folder = sf_dir
        self._opened: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self._spark.read.parquet(f"{self._folder}/{name}.parquet")
        return self._opened[name]

    def hospitals(self) -> DataFrame:
        key = F.col("s_suppkey")
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        pedi, adult = key % 5, 10 + key % 11
        return (
            self.table("supplier")
            .join(places, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.when(key % 37 != 6, _padded("H", key, 6)).alias("hosp_id"),
                F.col("s_name").alias("name"),
                F.when(key % 3 == 0, "Public/Government").otherwise("Private").alias("sector"),
                F.col("r_name").alias("state"),
                F.col("n_name").alias("location"),
                (100 + key * 37 % 400).cast("int").alias("num_licensed_beds"),
                (80 + key * 37 % 400 + key * 13 % 40).cast("int").alias("num_staffed_beds"),
                (adult + F.when(key % 7 == 3, 0).otherwise(pedi)).cast("int").alias("num_icu_beds"),
                adult.cast("int").alias("adult_icu_beds"),
                pedi.cast("int").alias("pedi_icu_beds"),
                (key % 6).cast("int").alias("ventilators_available"),
                (1 + key % 8).cast("int").alias("surgery_theatres"),
            )
        )

    def new_admissions(self, *, with_stay: bool = True) -> DataFrame:
        """One admission per order, whose key is unique; ``with_stay=False`` leaves out
        hospital and durations.

        Those come from the order lines, which are summed up per order before the
        join and are not read at all without them.
        """
        key = F.col("o_orderkey")
        admissions = self.table("orders").withColumn("day", F.col("o_orderdate").cast("date"))
        columns = [
            key.alias("admission_id"),
            _padded("P", F.col("o_custkey"), 7).alias("patient_id"),
            _mixed_spelling(key, F.col("day")).alias("d_o_a"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "E")
            .otherwise("O")
            .alias("type_of_admission_emergency_or_opd"),
            F.when(F.col("o_orderstatus") == "F", "DISCHARGE")
            .when(F.col("o_orderstatus") == "P", "EXPIRY")
            .otherwise("OTHER")
            .alias("outcome"),
        ]
        if with_stay:
            lines = (
                self.table("lineitem")
                .groupBy("l_orderkey")
                .agg(F.min("l_suppkey").alias("supplier"), F.count("l_orderkey").alias("lines"))
            )
            admissions = admissions.join(lines, key == F.col("l_orderkey"), "left")
            days = F.coalesce("lines", F.lit(0))
            columns[2:2] = [_padded("H", F.col("supplier"), 6).alias("hospital_id")]
            columns[4:4] = [
                days.cast("int").alias("duration_of_stay"),
                F.greatest(days - 4, F.lit(0)).cast("int").alias("duration_of_intensive_unit_stay"),
            ]
        return admissions.select(*columns)

    def patients(self) -> DataFrame:
        """Every fiftieth patient appears twice."""
        key = F.col("c_custkey")
        rows = F.array_repeat(F.lit(1), F.when(key % 50 == 0, 2).otherwise(1))
        born = F.date_add(F.lit(dt.date(1940, 1, 1)), (key * 7919 % 22000).cast("int"))
        return (
            self.table("customer")
            .select("c_custkey", "c_name", F.explode(rows).alias("copy"))
            .select(
                _padded("P", key, 7).alias("patient_id"),
                F.col("c_name").alias("full_name"),
                F.when(key % 211 != 9, _mixed_spelling(key, born)).alias("dob"),
            )
        )

    def patient_history(self) -> DataFrame:
        def drawn(name: str, prime: int) -> str:
            draw = f"(k * k + k * {prime} + {prime * prime}) % 101"
            known = "c_custkey % 97 != 5" if name == "dm" else "true"
            return f"if({known}, int({draw} < {FLAG_RATES.get(name, 6)}), null) AS {name}"

        return (
            self.table("customer")
            .withColumn("k", F.col("c_custkey") % 101)
            .select(
                _padded("P", F.col("c_custkey"), 7).alias("patient_id"),
                *(F.expr(drawn(name, prime)) for name, prime in FLAG_PRIMES.items()),
            )
        )

    def plans(self) -> DataFrame:
        key = F.col("n_nationkey")
        return (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                _padded("PLAN-", key, 2).alias("plan_id"),
                F.when(key == 24, "UNSOLD").otherwise(F.col("r_name")).alias("payment_type"),
                (key % 7 != 0).alias("inpatient_care"),
                (key % 5 != 1).alias("outpatient_care"),
                (key % 3 != 2).alias("prescription_drugs"),
                ((key % 2 == 0) | (key % 4 == 1)).alias("mental_health_care"),
                (key % 11 != 3).alias("dental_care"),
                (key % 13 != 4).alias("vision_care"),
            )
        )

    def policies_new(self) -> DataFrame:
        key, start = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
        return self.table("orders").select(
            _padded("POL", key, 9).alias("policy_number"),
            _padded("P", F.col("o_custkey"), 7).alias("patient_id"),
            _padded("PLAN-", (key + F.col("o_custkey")) % 24, 2).alias("plan_id"),
            start.alias("policy_start_date"),
            F.date_add(start, (90 + key % 12 * 60).cast("int")).alias("policy_end_date"),
            (F.col("o_totalprice") / 100).alias("daily_premium"),
            F.col("o_totalprice").alias("insurance_coverage"),
        )

    def readings(self) -> DataFrame:
        return as_readings(self.table("events"))

    def tables(self, *, with_stay: bool = True) -> CareTables:
        return CareTables(
            hospitals=self.hospitals,
            new_admissions=lambda: self.new_admissions(with_stay=with_stay),
            patients=self.patients,
            patient_history=self.patient_history,
            plans=self.plans,
            policies_new=self.policies_new,
            patient_device_stream=self.readings,
        )
