"""Registered queries and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tagloom.session import local_frame

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the equivalent SQL where there is one."""
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return f"{value!r}::{'DOUBLE' if isinstance(value, float) else 'BIGINT'}"


def values_sql(rows: Sequence[tuple], alias: str) -> str:
    """``(VALUES ...) alias`` for use in a FROM clause."""
    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"(VALUES {body}) {alias}"


def rules_frame(spark: SparkSession, rules: Sequence[tuple[int, str]]) -> DataFrame:
    return local_frame(spark, rules, "id long, rule string")


def bins_sql(column: str, bins) -> str:
    """CASE expression of a bin table."""
    cases = []
    for low, high, points in bins:
        tests = ([f"{column} >= {low}"] if low is not None else []) + ([f"{column} <= {high}"] if high is not None else [])
        cases.append(f"WHEN {' AND '.join(tests)} THEN {points}")
    return f"CASE {' '.join(cases)} END"


def distances_sql(columns: Sequence[str], centres) -> str:
    """List of squared distances to each centre."""
    parts = ["+".join(f"({c}-{literal(float(x))})*({c}-{literal(float(x))})" for c, x in zip(columns, centre)) for centre in centres]
    return "[" + ", ".join(parts) + "]"
