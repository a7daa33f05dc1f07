"""Run tag jobs.

``python -m tagloom.run --tag 23 29 --as-of 2019-08-31 --tags TAGS --sources FOLDER --profile FOLDER``, or
``spark-submit tagloom/run.py`` with the same arguments. Off local mode the package is sent to the executors.
"""

from __future__ import annotations

import argparse
import shutil
import sys
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
if not __package__:  # run as a script: its own folder is on the path, not the package's
    sys.path.insert(0, str(ROOT))

from tagloom.plans.registry import JobOptions, job  # noqa: E402
from tagloom.plans.template import KeptStates, parquet_source, run_jobs  # noqa: E402
from tagloom.session import materialised  # noqa: E402
from tagloom.sources.readers import read_fields, read_tags, read_tags_jdbc  # noqa: E402
from tagloom.sources.stores import ProfileStore  # noqa: E402


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, which start in folders of their own."""
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='tagloom-')}/tagloom", "zip", ROOT, "tagloom")
    spark.sparkContext.addPyFile(archive)


def tag_table(spark: SparkSession, args: argparse.Namespace):
    """The tag table from Parquet or, at a JDBC address, from a database, read once and used by all jobs."""
    if not args.tags.startswith("jdbc:"):
        return read_tags(spark, args.tags)
    properties = dict(p.split("=", 1) for p in args.tags_property)
    ranges = ("id", *args.tags_range) if args.tags_range else ()
    return materialised(read_tags_jdbc(spark, args.tags, args.tags_table, properties, *ranges), "tags")


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(description="Compute tags and add them to the profile.")
    parser.add_argument("--tag", type=int, nargs="+", required=True, help="ids of the level-4 tags")
    parser.add_argument("--as-of", required=True, help="day that recency is counted from, yyyy-mm-dd")
    parser.add_argument("--shift-days", type=int, default=0, help="days to move that day back")
    parser.add_argument("--tags", required=True, help="Parquet path of the tag table, or its JDBC address")
    parser.add_argument("--tags-table", default="tbl_basic_tag", help="name of the tag table in the database")
    parser.add_argument("--tags-property", action="append", default=[], metavar="NAME=VALUE", help="property of the JDBC connection")
    parser.add_argument("--tags-range", type=int, nargs=3, metavar=("LOWEST", "HIGHEST", "PARTS"), help="read the ids in so many ranges at once")
    parser.add_argument("--sources", required=True, help="folder of the source tables")
    parser.add_argument("--profile", required=True, help="folder of the profile")
    parser.add_argument("--products", help="folder of the product lists, one below it for each tag; by default products below the profile's")
    parser.add_argument("--keep", type=int, help="versions that stay; without it all do")
    parser.add_argument("--buckets", type=int, help="buckets of a new profile; by default as many as shuffle partitions")
    parser.add_argument("--states", help="folder of states by user, to which a run adds the new rows only")
    parser.add_argument("--new-by", help="column of the sources that grows with every load, with --states")
    parser.add_argument("--models", help="folder for fitted models; without it they are fitted on every run")
    parser.add_argument("--orders-table", default="tbl_orders", help="orders table of the shopping gender")
    parser.add_argument("--refresh", action="store_true", help="fit models anew")
    parser.add_argument("--replace-siblings", action="store_true", help="take away this job's earlier tags")
    parser.add_argument("--on-missing", choices=["error", "drop"], default="error", help="what to do with a value without a rule")
    args = parser.parse_args(arguments)
    if spark is None:
        spark = SparkSession.builder.appName("tags").getOrCreate()
        ship(spark)

    def orders():
        return read_fields(spark, f"{args.sources.rstrip('/')}/{args.orders_table}.parquet", ["memberId", "orderSn"], as_text=False)

    if bool(args.states) != bool(args.new_by):
        parser.error("--states and --new-by go together")
    kept = KeptStates(args.states, args.new_by, args.keep) if args.states else None

    def products(tag):
        root = args.products or f"{args.profile.rstrip('/')}/products"
        return ProfileStore(spark, f"{root.rstrip('/')}/{tag}", args.keep, args.buckets)

    options = JobOptions(args.as_of, args.shift_days, args.models, args.refresh, orders, args.on_missing)
    run_jobs([job(tag, options) for tag in args.tag], tag_table(spark, args), parquet_source(spark, args.sources),
             ProfileStore(spark, args.profile, args.keep, args.buckets), args.replace_siblings, products, kept)


if __name__ == "__main__":
    main()
