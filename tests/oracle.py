"""Run registered queries and their SQL side by side: ``python tests/oracle.py SF_DIR [name ...] [spark.conf=value ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
         "float": "FLOAT"}


def session(**conf):
    from pyspark.sql import SparkSession

    builder = (SparkSession.builder.master("local[8]").appName("check")
               .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC"))
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def difference(df, con, sql) -> str | None:
    """What differs between the Spark result and the SQL result, or None."""
    result = con.execute(sql)
    described = {d[0]: str(d[1]) for d in result.description}
    expected_rows = result.fetchall()
    spark_types = dict(df.dtypes)
    if sorted(spark_types) != sorted(described):
        return f"columns {sorted(spark_types)} != {sorted(described)}"
    wrong = {c: (t, described[c]) for c, t in spark_types.items() if TYPES.get(t) != described[c]}
    if wrong:
        return f"types {wrong}"
    columns = sorted(spark_types)
    order = [list(described).index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in order) for row in expected_rows)
    actual = Counter(tuple(row) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    if actual != expected:
        missing, extra = expected - actual, actual - expected
        return (f"{sum(actual.values())} rows, {sum(expected.values())} expected; {sum(missing.values())} missing "
                f"{list(missing)[:2]}, {sum(extra.values())} extra {list(extra)[:2]}")
    return None


def main(sf_dir, names):
    from __spark_entry__ import oracle_sql, queries

    conf = dict(n.split("=", 1) for n in names if "=" in n)  # for instance spark.sql.ansi.enabled=false
    names = {n for n in names if "=" not in n}
    spark, con, oracles = session(**conf), connect(sf_dir), oracle_sql()
    failed = []
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            problem = difference(df, con, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001 - shown to the reader
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{time.time() - start:6.2f}s {name}: {'ok' if problem is None else problem}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} differ: {' '.join(failed)}")


if __name__ == "__main__":
    main(sys.argv[1], set(sys.argv[2:]))
