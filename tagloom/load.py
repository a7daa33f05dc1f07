"""Load text into the tables that the jobs read.

``python -m tagloom.load --table orders --lines FOLDER --out SOURCES/tbl_orders.parquet``
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tagloom.sources.readers import TABLE_COLUMNS, load_table


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(description="Load separated lines as a Parquet table, one row per key.")
    parser.add_argument("--table", choices=sorted(TABLE_COLUMNS), required=True, help="whose columns the lines have")
    parser.add_argument("--lines", required=True, help="file or folder of the lines")
    parser.add_argument("--out", required=True, help="path of the new table")
    parser.add_argument("--strict-compat", action="store_true", help="forget all empty fields at the end of a line")
    args = parser.parse_args(arguments)
    load_table(spark or SparkSession.builder.appName("load").getOrCreate(), args.table, args.lines, args.out, args.strict_compat)


if __name__ == "__main__":
    main()
