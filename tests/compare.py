"""Row-by-row comparison of a Spark result with a DuckDB statement."""

from __future__ import annotations

from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """Number of rows and the differences: columns, kinds of type, rows of either side."""
    expected = con.execute(sql)
    names = [c[0] for c in expected.description]
    problems = []
    if sorted(names) != sorted(df.columns):
        return 0, [f"columns {sorted(df.columns)} instead of {sorted(names)}"]
    kinds = {c[0]: str(c[1]).lower() for c in expected.description}
    same = {"number": {"bigint", "int", "integer", "double"}}
    for name, kind in df.dtypes:
        duck = kinds[name]
        alias = {"int": "integer", "string": "varchar"}.get(kind, kind)
        if duck not in (alias, kind) and not {duck, kind} <= {"string", "varchar"}:
            if not (kind in same["number"] and duck == "number"):
                problems.append(f"{name}: {kind} instead of {duck}")
    order = sorted(names)
    want = Counter(
        tuple(row[names.index(c)] for c in order) for row in expected.fetchall()
    )
    got = Counter(tuple(row[c] for c in order) for row in df.collect())
    for label, rows in (("missing", want - got), ("surplus", got - want)):
        if rows:
            problems.append(f"{label} {rows.total()}: {list(rows)[:3]}")
    return got.total(), problems
