"""DuckDB statements that say independently what each registered query returns.

They join the tables directly, row by row, where the jobs join summaries.
"""

from __future__ import annotations

import re

from carelake import schemas
from carelake.functions.features import CONDITIONS, COVERS, HEART_CONDITIONS, LUNG_CONDITIONS
from carelake.operators import history
from carelake.plans import medallion
from carelake.plans.questions import COVER_NAMES
from carelake.sources.star import FLAG_PRIMES, FLAG_RATES

AS_OF = "DATE '2002-01-01'"


def _spelled(key: str, day: str) -> str:
    return f"""CASE {key} % 3
      WHEN 0 THEN month({day}) || '/' || day({day}) || '/' || year({day})
      WHEN 1 THEN strftime({day}, '%d-%m-%Y')
      ELSE strftime({day}, '%m/%d/%Y') END"""


def _flag(name: str) -> str:
    prime, rate = FLAG_PRIMES[name], FLAG_RATES.get(name, 6)
    unknown = "WHEN c_custkey % 97 = 5 THEN NULL " if name == "dm" else ""
    drawn = f"(k * k + k * {prime} + {prime * prime}) % 101 < {rate}"
    return f"CASE {unknown}WHEN {drawn} THEN 1 ELSE 0 END AS {name}"


def _fixed(column: str) -> str:
    """Day-first text, through a real date instead of text surgery."""
    return (
        f"CASE WHEN {column} LIKE '%/%' "
        f"THEN strftime(strptime({column}, '%m/%d/%Y'), '%d-%m-%Y') ELSE {column} END"
    )


def _day(column: str) -> str:
    return f"CAST(try_strptime({column}, '%d-%m-%Y') AS DATE)"


def r(expression: str, digits: int = 4) -> str:
    """Rounded half up on the decimal digits, as a double; summing noise goes first."""
    return f"CAST(round(round(CAST({expression} AS DECIMAL(38, 10)), 8), {digits}) AS DOUBLE)"


TABLES = {
    "hospitals_raw": """
      SELECT CASE WHEN s_suppkey % 37 <> 6 THEN printf('H%06d', s_suppkey) END AS hosp_id,
        s_name AS name,
        CASE WHEN s_suppkey % 3 = 0 THEN 'Public/Government' ELSE 'Private' END AS sector,
        r_name AS state, n_name AS location,
        CAST(100 + (s_suppkey * 37) % 400 AS INT) AS num_licensed_beds,
        CAST(80 + (s_suppkey * 37) % 400 + (s_suppkey * 13) % 40 AS INT) AS num_staffed_beds,
        CAST(10 + s_suppkey % 11
          + CASE WHEN s_suppkey % 7 = 3 THEN 0 ELSE s_suppkey % 5 END AS INT) AS num_icu_beds,
        CAST(10 + s_suppkey % 11 AS INT) AS adult_icu_beds,
        CAST(s_suppkey % 5 AS INT) AS pedi_icu_beds,
        CAST(s_suppkey % 6 AS INT) AS ventilators_available,
        CAST(1 + s_suppkey % 8 AS INT) AS surgery_theatres
      FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "new_admissions_raw": f"""
      SELECT o_orderkey AS admission_id, printf('P%07d', o_custkey) AS patient_id,
        CASE WHEN supplier IS NOT NULL THEN printf('H%06d', supplier) END AS hospital_id,
        {_spelled("o_orderkey", "d")} AS d_o_a,
        CAST(n AS INT) AS duration_of_stay,
        CAST(greatest(n - 4, 0) AS INT) AS duration_of_intensive_unit_stay,
        CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'E' ELSE 'O' END
          AS type_of_admission_emergency_or_opd,
        CASE o_orderstatus WHEN 'F' THEN 'DISCHARGE' WHEN 'P' THEN 'EXPIRY' ELSE 'OTHER' END
          AS outcome
      FROM (
        SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus,
          CAST(o_orderdate AS DATE) AS d, min(l_suppkey) AS supplier, count(l_orderkey) AS n
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)""",
    "patients_raw": f"""
      SELECT printf('P%07d', c_custkey) AS patient_id, c_name AS full_name,
        CASE WHEN c_custkey % 211 <> 9 THEN {_spelled("c_custkey", "d")} END AS dob
      FROM (
        SELECT c_custkey, c_name,
          DATE '1940-01-01' + CAST((c_custkey * 7919) % 22000 AS INT) AS d
        FROM (FROM customer UNION ALL FROM customer WHERE c_custkey % 50 = 0))""",
    "patient_history_raw": f"""
      SELECT printf('P%07d', c_custkey) AS patient_id, {", ".join(map(_flag, FLAG_PRIMES))}
      FROM (SELECT c_custkey, c_custkey % 101 AS k FROM customer)""",
    "plans_raw": """
      SELECT printf('PLAN-%02d', n_nationkey) AS plan_id,
        CASE WHEN n_nationkey = 24 THEN 'UNSOLD' ELSE r_name END AS payment_type,
        n_nationkey % 7 <> 0 AS inpatient_care, n_nationkey % 5 <> 1 AS outpatient_care,
        n_nationkey % 3 <> 2 AS prescription_drugs,
        (n_nationkey % 2 = 0 OR n_nationkey % 4 = 1) AS mental_health_care,
        n_nationkey % 11 <> 3 AS dental_care, n_nationkey % 13 <> 4 AS vision_care
      FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "policies_new_raw": """
      SELECT printf('POL%09d', o_orderkey) AS policy_number,
        printf('P%07d', o_custkey) AS patient_id,
        printf('PLAN-%02d', (o_orderkey + o_custkey) % 24) AS plan_id,
        CAST(o_orderdate AS DATE) AS policy_start_date,
        CAST(o_orderdate AS DATE) + CAST(90 + (o_orderkey % 12) * 60 AS INT) AS policy_end_date,
        o_totalprice / 100 AS daily_premium, o_totalprice AS insurance_coverage
      FROM orders""",
    "readings": """
      SELECT printf('P%07d', user_id) AS patient_id, 40 + value AS heart_rate_per_minute
      FROM events""",
    "hospitals": """
      SELECT * REPLACE (
        CASE WHEN adult_icu_beds + pedi_icu_beds <> num_icu_beds THEN 0
          ELSE pedi_icu_beds END AS pedi_icu_beds,
        CASE WHEN num_staffed_beds > num_licensed_beds THEN num_licensed_beds
          ELSE num_staffed_beds END AS num_staffed_beds)
      FROM hospitals_raw WHERE hosp_id IS NOT NULL""",
    "new_admissions": f"""
      SELECT * REPLACE ({_fixed("d_o_a")} AS d_o_a), {_day(_fixed("d_o_a"))} AS admitted
      FROM new_admissions_raw""",
    "patients": f"""
      SELECT DISTINCT patient_id, full_name, {_fixed("dob")} AS dob FROM patients_raw""",
    "history": f"""
      SELECT *, {" + ".join(CONDITIONS)} AS tot,
        CASE WHEN {" OR ".join(c + " > 0" for c in HEART_CONDITIONS)} THEN 1 ELSE 0 END AS heart,
        CASE WHEN {" OR ".join(c + " > 0" for c in LUNG_CONDITIONS)} THEN 1 ELSE 0 END AS lung
      FROM patient_history_raw""",
    "risks": """
      SELECT *, CASE
        WHEN tot >= 2 AND smoking_ = 1 AND alcohol = 1 THEN 'Critical'
        WHEN tot >= 2 AND 1 IN (smoking_, alcohol) THEN 'Very High'
        WHEN tot > 2 THEN 'High'
        WHEN tot > 0 OR 1 IN (smoking_, alcohol) THEN 'Medium'
        WHEN tot = 0 AND smoking_ = 0 AND alcohol = 0 THEN 'Low'
        ELSE 'Unknown' END AS risk FROM history""",
    "ages": f"""
      SELECT patient_id, full_name, {_day("dob")} AS born,
        CAST(year({AS_OF}) - year({_day("dob")}) AS INT) AS calendar_age,
        CAST(date_sub('year', {_day("dob")}, {AS_OF}) AS INT) AS full_years,
        CAST(trunc(date_diff('day', {_day("dob")}, {AS_OF}) / 365) AS INT) AS age_of_patient
      FROM patients""",
    "covers": f"""
      SELECT plan_id, CAST({" AND ".join(COVERS)} AS INT) AS covered FROM plans_raw""",
    "admitted_patients": """
      SELECT * EXCLUDE (hosp_id)
      FROM new_admissions JOIN ages USING (patient_id) JOIN hospitals ON hosp_id = hospital_id""",
}


def with_tables(body: str, given: frozenset[str] = frozenset()) -> str:
    """Prefix the statement with the derived tables it mentions, in order.

    Tables that exist already, such as a test's own, are passed as ``given``.
    """
    needed: set[str] = set()

    def collect(sql: str) -> None:
        for name in TABLES.keys() - given:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                collect(TABLES[name])

    collect(body)
    parts = [f"{name} AS ({TABLES[name]})" for name in TABLES if name in needed]
    body = body.strip()
    if body.startswith(","):
        return f"WITH {', '.join([*parts, body[1:]])}"
    return f"WITH {', '.join(parts)} {body}" if parts else body


def _patient_facts(rates: str) -> str:
    """Direct join of all seven tables; ``rates`` says which readings rows take part."""
    return f"""
      , rates AS (SELECT patient_id, {rates}),
      joined AS (
        SELECT p.patient_id, p.policy_number, age_of_patient, tot, risk, covered, admission_id,
          duration_of_stay, location, rate, rated,
          coalesce(p.policy_end_date > admitted, false) AS active
        FROM policies_new_raw p JOIN ages USING (patient_id) JOIN risks USING (patient_id)
          JOIN new_admissions USING (patient_id) JOIN rates USING (patient_id)
          JOIN hospitals ON hosp_id = hospital_id JOIN covers USING (plan_id)),
      risk_modes AS (
        SELECT patient_id AS holder, policy_number AS number, age_of_patient AS age,
          risk AS patient_risk
        FROM joined GROUP BY 1, 2, 3, 4
        QUALIFY row_number() OVER (
          PARTITION BY holder, number, age ORDER BY count(*) DESC, patient_risk) = 1)
      SELECT patient_id, policy_number, age_of_patient,
        CASE WHEN 2 * count(*) FILTER (WHERE active) > count(*) THEN 'True' ELSE 'False' END
          AS active_policy_holder,
        {r("avg(tot)")} AS total_medical_condition_of_patient,
        count(admission_id) AS number_of_hospital_admissions,
        any_value(patient_risk) AS patient_risk,
        CAST(sum(duration_of_stay) AS BIGINT) AS total_hospital_days_of_patient,
        {r("avg(covered)")} AS insurance_coverage,
        count(location) AS no_of_cross_city_admissions,
        {r("sum(rate) / sum(rated)", 0)} AS avg_heart_rate
      FROM joined JOIN risk_modes
        ON holder = patient_id AND number = policy_number AND age IS NOT DISTINCT FROM age_of_patient
      GROUP BY ALL"""


EACH_READING = (
    "heart_rate_per_minute AS rate, CAST(rate IS NOT NULL AS INT) AS rated FROM readings"
)
ONCE_PER_PATIENT = (
    "sum(heart_rate_per_minute) AS rate, count(heart_rate_per_minute) AS rated "
    "FROM readings GROUP BY patient_id"
)


def _tier(top: int, mid: int) -> str:
    age = "coalesce(avg(calendar_age), 0)"
    return f"""
      SELECT branch_id, hospital_name, {r("age")} AS avg_patient_age, total_admissions,
        CASE WHEN age >= 50 OR total_admissions >= {top} THEN 'Tier 1'
          WHEN age BETWEEN 40 AND 49 OR total_admissions BETWEEN {mid} AND {top - 1}
          THEN 'Tier 2' ELSE 'Tier 3' END AS branch_tier
      FROM (SELECT hosp_id AS branch_id, name AS hospital_name, {age} AS age,
          count(admission_id) AS total_admissions
        FROM hospitals LEFT JOIN new_admissions ON hospital_id = hosp_id
          LEFT JOIN ages USING (patient_id) GROUP BY hosp_id, name)"""


def _percentage(condition: str, alias: str) -> str:
    return f"""SELECT {r(f"100 * avg(CASE WHEN {condition} THEN 1.0 ELSE 0 END)")} AS {alias}
      FROM history"""


def _emergency_days(admission_type: str) -> str:
    return f"""SELECT d_o_a AS date, count(patient_id) AS no_of_patients FROM new_admissions
      WHERE type_of_admission_emergency_or_opd = '{admission_type}' GROUP BY d_o_a"""


def _emergency_months(outcome: str) -> str:
    return f"""
      SELECT CAST(year(admitted) AS INT) AS year, CAST(month(admitted) AS INT) AS month,
        count(*) AS count_of_caes
      FROM admitted_patients
      WHERE type_of_admission_emergency_or_opd = 'E' AND outcome = '{outcome}' GROUP BY 1, 2"""


def _sector_places(sector: str) -> str:
    return f"""SELECT state, location, count(*) AS no_of_gov_hospitals FROM hospitals
      WHERE sector = '{sector}' GROUP BY ALL"""


def _mode(column: str, alias: str) -> str:
    """Values ranked by how often they occur, NULLs behind all others."""
    return f"""
      SELECT patient_id, {column} AS {alias}, found AS {alias}_count
      FROM (SELECT patient_id, {column}, count({column}) AS found FROM new_admissions GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY found DESC, {column} NULLS LAST) = 1"""


HOSPITAL_FACTS = f"""
  SELECT hospital_id, count(admission_id) AS total_admission,
    count(*) FILTER (WHERE duration_of_intensive_unit_stay > 0) AS total_icu_admission,
    {r("count(*) FILTER (WHERE outcome = 'EXPIRY') / count(admission_id)", 2)} AS mortality_rate,
    {r("avg(duration_of_intensive_unit_stay)", 0)} AS avg_day_in_icu,
    CAST(sum(surgery_theatres) AS BIGINT) AS no_of_surgical_theatre,
    {r("avg(duration_of_stay)", 0)} AS avg_day_of_stay,
    CAST(sum(ventilators_available) AS BIGINT) AS no_of_vantilators,
    {r("sum(num_staffed_beds) / sum(num_licensed_beds)", 2)} AS staffed_bed_to_normal_bed_ratio,
    {r("sum(num_icu_beds) / sum(num_licensed_beds)", 2)} AS icu_bed_to_normal_bed_ratio,
    {r("100 * sum(heart) / count(patient_id)", 2)} AS patient_with_heart_disease,
    {r("100 * sum(lung) / count(patient_id)", 2)} AS patient_with_lung_disease
  FROM admitted_patients JOIN history USING (patient_id) GROUP BY hospital_id"""

HEART_RATES = f"""
  SELECT patient_id, age_of_patient, count(*) AS readings,
    {r("avg(heart_rate_per_minute)", 0)} AS avg_heart_rate
  FROM readings JOIN (SELECT DISTINCT patient_id, age_of_patient FROM ages) USING (patient_id)
  GROUP BY ALL"""

READING_VIOLATIONS = """
  SELECT 'heart_rate_valid' AS expectation, 'warn' AS action,
    count(*) - count(*) FILTER (WHERE heart_rate_per_minute < 190) AS failed, count(*) AS total
  FROM readings"""

BODIES = {
    # sources and naming
    "csv_scan_inferred": "SELECT * FROM hospitals_raw",
    "csv_scan_policies": "SELECT * FROM policies_new_raw",
    "csv_scan_plans": "SELECT * FROM plans_raw",
    "normalize_columns_basic": "SELECT * FROM patient_history_raw",
    "normalize_columns_admissions": "SELECT * FROM new_admissions_raw",
    "normalize_columns_stream": "SELECT * FROM readings",
    "sql_over_views": f"""
      SELECT payment_type, count(*) AS policies, {r("avg(daily_premium)")} AS avg_daily_premium
      FROM policies_new_raw JOIN plans_raw USING (plan_id)
      WHERE daily_premium > 1000 GROUP BY payment_type""",
    # cleaning and quality
    "clean_dates": "SELECT admission_id, d_o_a, admitted FROM new_admissions",
    "clean_hospitals": "SELECT * FROM hospitals",
    "clean_patients_dedup": "SELECT * FROM patients",
    "exclude_rows_either": """SELECT * FROM patients
      WHERE NOT (full_name = 'Customer#000000007' OR patient_id = 'P0000011')""",
    "exclude_rows_pair": """SELECT * FROM patients
      WHERE (full_name, patient_id) <> ('Customer#000000007', 'P0000007')""",
    "expect_drop_hospitals": "SELECT * FROM hospitals_raw WHERE hosp_id IS NOT NULL",
    "expect_warn_counts": f"""
      SELECT 'valid hosp_id' AS expectation, 'drop' AS action,
        count(*) - count(hosp_id) AS failed, count(*) AS total
      FROM hospitals_raw UNION ALL {READING_VIOLATIONS}""",
    # features
    "feature_risk": "SELECT patient_id, tot, risk FROM risks",
    "feature_heart_lung": "SELECT patient_id, heart AS heart_disease, lung AS lung_disease "
    "FROM history",
    "feature_admission_flags": """
      SELECT admission_id, CASE WHEN duration_of_intensive_unit_stay > 0 THEN 1 ELSE 0 END
          AS icu_admission,
        CASE WHEN outcome = 'EXPIRY' THEN 1 ELSE 0 END AS mortality_rate FROM new_admissions""",
    "feature_ages": "SELECT patient_id, calendar_age, full_years, age_of_patient FROM ages",
    "feature_coverage": "SELECT plan_id, covered AS insurance_coverage FROM covers",
    "feature_active_policy": """
      SELECT patient_id, policy_end_date,
        count(*) FILTER (WHERE policy_end_date > admitted) AS active, count(*) AS admissions
      FROM (SELECT DISTINCT patient_id, policy_end_date FROM policies_new_raw)
        JOIN new_admissions USING (patient_id) JOIN hospitals ON hosp_id = hospital_id
      GROUP BY ALL""",
    # facts
    "hospital_facts": HOSPITAL_FACTS,
    "patient_facts": _patient_facts(EACH_READING),
    "patient_facts_dedup": _patient_facts(ONCE_PER_PATIENT),
    "policy_holders": """
      SELECT patient_id, full_name, age_of_patient, policy_number, plan_id
      FROM policies_new_raw RIGHT JOIN ages USING (patient_id)""",
    # questions
    "q1_above_avg_premium": """
      SELECT count(DISTINCT patient_id) AS count_of_patients
      FROM (SELECT *, avg(daily_premium) OVER () AS mean FROM policies_new_raw)
      WHERE daily_premium > mean""",
    "q2a_cover_share": "SELECT "
    + ", ".join(
        r(f"count(*) FILTER (WHERE {c}) / count({c})") + f" AS {n}" for c, n in COVER_NAMES.items()
    )
    + " FROM plans_raw",
    "q2b_plan_premium": f"""
      SELECT plan_id AS plan_type, {r("avg(daily_premium)")} AS "DailyPremium_Avg",
        {r('''sum(daily_premium * (policy_end_date - policy_start_date) + 1)
        / (max(policy_end_date) - min(policy_start_date))''')} AS "AverageAnnualPremium"
      FROM policies_new_raw JOIN plans_raw USING (plan_id) GROUP BY plan_id""",
    "q3_branch_conditions": """
      SELECT 'BR-0' || right(hospital_id, 4) AS branch_id, name AS hospital_name,
        CAST(sum(dm) AS BIGINT) AS dm_true, CAST(sum(htn) AS BIGINT) AS htn_true,
        count(*) FILTER (WHERE dm = 1 AND htn = 1) AS both,
        count(*) FILTER (WHERE dm = 0 AND htn = 0) AS neither
      FROM admitted_patients JOIN history USING (patient_id) GROUP BY 1, 2""",
    "q4_branch_tier": _tier(1000, 500),
    "q4_branch_tier_lower": _tier(300, 100),
    "q5_plan_month": """
      SELECT plan_id, CAST(year(admitted) AS INT) AS year, CAST(month(admitted) AS INT) AS month,
        count(admission_id) AS admission_count
      FROM policies_new_raw JOIN plans_raw USING (plan_id)
        JOIN patients USING (patient_id) JOIN new_admissions USING (patient_id)
      GROUP BY 1, 2, 3""",
    "q6_plan_change": """
      , numbered AS (SELECT *, row_number() OVER (
          PARTITION BY patient_id ORDER BY policy_start_date NULLS FIRST, plan_id NULLS FIRST
        ) AS place
        FROM policies_new_raw)
      SELECT old.patient_id, old.plan_id AS "Previous_Policy", new.plan_id AS "Current_Policy"
      FROM numbered old JOIN numbered new
        ON new.patient_id = old.patient_id AND new.place = old.place + 1
      WHERE new.plan_id <> old.plan_id""",
    "q7_age_condition": """
      , banded AS (
        SELECT CASE WHEN full_years < 30 THEN 'Under30'
            WHEN full_years < 60 THEN (full_years // 5 * 5) || '-' || (full_years // 5 * 5 + 5)
          END AS age_group,
          count(*) FILTER (WHERE dm = 1) AS diabetes, count(*) FILTER (WHERE cad = 1) AS cad,
          count(*) FILTER (WHERE htn = 1) AS hypertension
        FROM ages JOIN history USING (patient_id) GROUP BY 1)
      SELECT age_group, CASE greatest(diabetes, cad, hypertension) WHEN diabetes THEN 'diabetes'
        WHEN cad THEN 'cad' ELSE 'hypertension' END AS most_common_condition FROM banded""",
    # insights
    "i01_hospitals_per_sector": "SELECT sector, count(*) AS hospital_count FROM hospitals "
    "GROUP BY ALL",
    "i02_beds_per_state": f"""SELECT state, {r("avg(num_licensed_beds)")} AS avg_licensed_beds
      FROM hospitals GROUP BY state""",
    "i03_smokers": _percentage("smoking_ = 1", "percentage_smokers"),
    "i04_busiest_hospitals": """
      SELECT hospital_id, admission_count FROM (
        SELECT hospital_id, count(*) AS admission_count FROM new_admissions GROUP BY ALL)
      QUALIFY row_number() OVER (ORDER BY admission_count DESC, hospital_id NULLS FIRST) <= 5""",
    "i05_diabetes_and_hypertension": _percentage(
        "dm = 1 AND htn = 1", "percentage_diabetes_and_hypertension"
    ),
    "i06_premium_per_plan": f"""SELECT plan_id, {r("avg(daily_premium)")} AS avg_daily_premium
      FROM policies_new_raw GROUP BY ALL""",
    "i07_heart_failure": _percentage("heart_failure = 1", "percentage_heart_failure"),
    "i08_coverage_per_plan": f"""SELECT plan_id, {r("sum(insurance_coverage)")} AS total_coverage
      FROM policies_new_raw GROUP BY ALL""",
    "i09_plan_outcomes": f"""
      SELECT plan_id, count(admission_id) AS total_admissions,
        {r("avg(duration_of_stay)")} AS avg_duration_of_stay
      FROM policies_new_raw JOIN new_admissions USING (patient_id) GROUP BY plan_id""",
    "i10_resource_use": f"""
      SELECT name AS hospital_name,
        {r("count(DISTINCT admission_id) / nullif(num_icu_beds, 0)")} AS icu_bed_utilization_rate,
        {r("count(DISTINCT admission_id) / nullif(ventilators_available, 0)")}
          AS ventilator_utilization_rate
      FROM hospitals LEFT JOIN new_admissions ON hospital_id = hosp_id
      GROUP BY name, num_icu_beds, ventilators_available""",
    "i11_sector_demographics": f"""
      SELECT sector, {r("avg(calendar_age)")} AS avg_age, count(*) AS total_patients
      FROM admitted_patients GROUP BY sector""",
    "i12_plan_popularity": f"""
      SELECT payment_type, count(DISTINCT policy_number) AS policy_count,
        {r('''count(DISTINCT policy_number)
        / (SELECT count(DISTINCT policy_number) FROM policies_new_raw)''')} AS percentage_of_total
      FROM plans_raw LEFT JOIN policies_new_raw USING (plan_id) GROUP BY payment_type""",
    "i13_long_term_patients": f"""
      SELECT name AS hospital_name, full_name AS provider_name,
        count(DISTINCT admission_id) AS total_admissions,
        {r("avg(duration_of_stay)")} AS avg_duration_of_stay
      FROM admitted_patients GROUP BY name, full_name""",
    "i14_patients_per_hospital": "SELECT name AS hospital_name, count(*) AS count_of_patients "
    "FROM admitted_patients GROUP BY name",
    "i15_emergencies_per_day": _emergency_days("E"),
    "i15_admissions_per_day_other": _emergency_days("O"),
    "i16_patients_per_place": "SELECT state, location, count(*) AS count_of_patients "
    "FROM admitted_patients GROUP BY ALL",
    "i17_emergency_deaths_per_month": _emergency_months("EXPIRY"),
    "i17_emergency_discharges_per_month": _emergency_months("DISCHARGE"),
    "i18_stay_to_discharge": f"""
      SELECT name AS hospital_name, {r("avg(duration_of_stay)")} AS avg_stay
      FROM admitted_patients
      WHERE outcome = 'DISCHARGE' AND type_of_admission_emergency_or_opd = 'E' GROUP BY name""",
    "i19_beds_per_place": "SELECT state, location, CAST(sum(num_licensed_beds) AS BIGINT) "
    "AS total_beds FROM hospitals GROUP BY ALL",
    "i20_public_hospitals_per_place": _sector_places("Public/Government"),
    "i20_private_hospitals_per_place": _sector_places("Private"),
    "i21_hospitals_per_place": "SELECT location, state, count(*) AS count_of_hospitals "
    "FROM hospitals GROUP BY ALL",
    "mode_usual_hospitals": f"""
      SELECT h.patient_id, usual_hospital, usual_hospital_count, usual_stay, usual_stay_count
      FROM ({_mode("hospital_id", "usual_hospital")}) h
        JOIN ({_mode("duration_of_stay", "usual_stay")}) s ON s.patient_id IS NOT DISTINCT FROM h.patient_id""",
    # streams and layers
    "stream_clean_readings": "SELECT * FROM readings",
    "stream_quality_counts": READING_VIOLATIONS,
    "stream_patient_heart_rate": HEART_RATES,
    "stream_joined_readings": "SELECT patient_id, heart_rate_per_minute, full_name, dob "
    "FROM readings JOIN patients USING (patient_id)",
    "stream_patient_facts": _patient_facts(EACH_READING),
    "incremental_ingest": "SELECT * FROM new_admissions_raw",
    "quality_history": f"""
      , batch AS (
        SELECT 'hospitals' AS dataset, 'valid hosp_id' AS expectation, 'drop' AS action,
          count(*) FILTER (hosp_id IS NULL) AS failed, count(*) AS total FROM hospitals_raw
        UNION ALL SELECT 'new_admissions', 'readable d_o_a', 'warn',
          count(*) FILTER (d_o_a IS NOT NULL AND {_day("d_o_a")} IS NULL), count(*) FROM new_admissions
        UNION ALL SELECT 'patients', 'readable dob', 'warn',
          count(*) FILTER (dob IS NOT NULL AND {_day("dob")} IS NULL), count(*) FROM patients),
      stream AS (
        SELECT 'patient_device_stream_clean' AS dataset, 'heart_rate_valid' AS expectation, 'warn' AS action,
          heart_rate_per_minute >= 200 AS late, heart_rate_per_minute >= 190 AS bad FROM readings)
      SELECT dataset, CAST(run AS INT) AS run, expectation, action, failed, total,
        {r("failed / nullif(total, 0)")} AS failed_share
      FROM (
        SELECT *, unnest([1, 2]) AS run FROM batch
        UNION ALL SELECT dataset, expectation, action, count(*) FILTER (bad), count(*), 1 + CAST(late AS INT)
        FROM stream GROUP BY dataset, expectation, action, late)""",
    "bucketed_patient_facts": _patient_facts(EACH_READING),
    "stream_grown_readings": f"""
      SELECT patient_id,
        {r("CASE turn WHEN 0 THEN floor(rate) WHEN 1 THEN rate ELSE CASE WHEN rate >= 60 THEN rate END END")}
          AS heart_rate_per_minute,
        CASE WHEN turn = 1 THEN CASE WHEN rate > 100 THEN 'band' ELSE 'clip' END END AS kind_of_device,
        CASE WHEN turn = 2 AND rate < 60
          THEN printf('{{"heart_rate_per_minute":"about %d"}}', CAST(floor(rate) AS BIGINT)) END AS _rescued
      FROM (SELECT patient_id, heart_rate_per_minute AS rate,
        CAST(round(heart_rate_per_minute * 100) AS BIGINT) % 3 AS turn FROM readings)""",
    "layered_hospital_facts": HOSPITAL_FACTS,
    "layered_patient_facts": _patient_facts(EACH_READING),
}


def _inventory() -> str:
    """Each dataset's own rows counted, beside what the run says of it."""
    changed = {"hospitals", "new_admissions", "patients"}
    datasets = [(layer, name) for layer in ("bronze", "silver") for name in schemas.BATCH]
    rows = []
    for layer, name in datasets:
        table = name if layer == "silver" and name in changed else f"{name}_raw"
        suffix = {"bronze": "_raw", "silver": "_clean"}[layer]
        counted = f"SELECT count(*) FROM {table}"
        rows.append((layer, f"{name}{suffix}", name, len(schemas.BATCH[name]), counted))
    rows.append(("gold", "hospital_agg_facts", "hospital_agg_facts", 12, f"SELECT count(*) FROM ({HOSPITAL_FACTS})"))
    keys = """SELECT count(*) FROM (
      SELECT DISTINCT patient_id, policy_number, age_of_patient FROM policies_new_raw
      JOIN ages USING (patient_id) JOIN history USING (patient_id) JOIN new_admissions USING (patient_id)
      JOIN hospitals ON hosp_id = hospital_id JOIN covers USING (plan_id)
      SEMI JOIN readings USING (patient_id))"""
    rows.append(("gold", "patients_agg_facts", "patients_agg_facts", 11, keys))
    comments = {
        **{dataset: f"{medallion.COMMENTS[subject]}{medallion.STATES[layer]}" for layer, dataset, subject, _, _ in rows},
        history.LEDGER: history.ABOUT.comment,
    }
    # One result for each of the tables with an expectation.
    rows.append(("silver", history.LEDGER, "", 6, "SELECT 3"))
    return " UNION ALL ".join(
        f"""SELECT '{layer}' AS layer, 1 AS version, '{dataset}' AS dataset, '{comments[dataset]}' AS comment,
          '{layer}' AS quality,
          {columns} AS columns, ({counted}) AS rows"""
        for layer, dataset, _, columns, counted in rows
    )


def _landed_types() -> str:
    """What a reader of the six files finds: admission ids are small, and money has a fraction."""
    found = {"bigint": "int"}
    rows = [
        f"""SELECT '{table}' AS "table", '{f.name}' AS "column",
          '{found.get(f.dataType.simpleString(), f.dataType.simpleString())}' AS type,
          count({f.name}) AS present FROM {table}_raw"""
        for table, schema in schemas.BATCH.items()
        for f in schema
    ]
    return " UNION ALL ".join(rows)


BODIES["layered_inventory"] = _inventory()
BODIES["csv_landed_types"] = _landed_types()


for _name in ("i10_resource_use", "i12_plan_popularity", "i13_long_term_patients"):
    BODIES[f"{_name}_kept"] = BODIES[_name]


def statements() -> dict[str, str]:
    return {name: with_tables(body) for name, body in BODIES.items()}
