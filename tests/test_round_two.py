"""Malformed cells, null users, repeated changes, decimals in bands, and the command line."""

import subprocess
import sys
from pathlib import Path

import pytest

from tagloom import load
from tagloom.operators import match
from tagloom.operators.features import chi_square
from tagloom.operators.joins import skew_join
from tagloom.operators.profile import upsert
from tagloom.operators.text import count_vectorizer
from tagloom.plans.registry import BP, CYCLE, JobOptions, job
from tagloom.plans.tags import cycle_tag, psm_features, rfe_features, rfm_features
from tagloom.plans.template import TagJob, run_jobs
from tagloom.sources.readers import TABLE_COLUMNS, TAG_SCHEMA, read_fields
from tagloom.sources.stores import ProfileStore

ORDERS = [("1", "a", "10.5", "1566979200", "2"), ("1", "b", "", "", "0"), (None, "c", "3", "1566979200", "0"), ("2", "d", "x", "1566979200", "")]


def orders(spark):
    return spark.createDataFrame(ORDERS, "memberId string, orderSn string, orderAmount string, finishTime string, couponCodeValue string")


def test_malformed_cells_are_null(spark):
    rfm = {r.userId: r for r in rfm_features(orders(spark), "2019-08-31").collect()}
    assert rfm["1"][1:] == rfm["1"][1:2] + (2, 10.5) and rfm["2"][3] is None
    assert {r.userId for r in psm_features(orders(spark)).collect()} == {"1"}
    logs = spark.createDataFrame([("u", "x", "bad"), ("u", "y", "2019-08-30 10:00:00")], "global_user_id string, loc_url string, log_time string")
    assert [tuple(r)[1:] for r in rfe_features(logs, "2019-08-31").collect()] == [(1, 2, 2)]


def test_rows_without_a_user_are_not_tagged(spark):
    rules = spark.createDataFrame([(24, "0-7")], "id long, rule string")
    assert sorted(r.userId for r in cycle_tag(orders(spark), rules, "2019-08-31").collect()) == ["1", "2"]


def test_several_changes_of_one_user_are_one_row(spark):
    old = spark.createDataFrame([("1", "9"), ("2", "8")], "userId string, tagsId string")
    new = spark.createDataFrame([("1", "6"), ("1", "5"), ("3", "7,4"), ("4", None)], "userId string, tagsId string")
    assert sorted(map(tuple, upsert(old, new).collect())) == [("1", "5,6"), ("2", "8"), ("3", "7,4"), ("4", None)]


def test_decimals_on_few_and_many_bands(spark, monkeypatch):
    bands = spark.createDataFrame([(1, 0, 7), (2, 8, 14), (3, -5, -1)], "tagsId long, start long, end long")
    values = spark.createDataFrame([(x,) for x in (7.0, 7.5, 8.0, -0.5, -1.0, -5.5, None)], "v double")
    few = sorted(map(tuple, match.match_range(values, "v", bands).collect()))
    monkeypatch.setattr(match, "LOOP_BANDS", 0)
    assert sorted(map(tuple, match.match_range(values, "v", bands).collect())) == few == [(-1.0, 3), (7.0, 1), (8.0, 2)]
    monkeypatch.setattr(match, "fits_broadcast", lambda df: False)
    assert sorted(map(tuple, match.match_range(values, "v", bands).collect())) == few


def test_chi_square_leaves_nulls_out(spark):
    rows = [("a", "x"), ("b", "y"), ("a", "x"), ("b", "x")]
    plain = chi_square(spark.createDataFrame(rows, "f string, l string"), ["f"], "l").collect()
    nulls = chi_square(spark.createDataFrame([*rows, (None, "x"), ("a", None)], "f string, l string"), ["f"], "l").collect()
    assert plain == nulls and plain[0].dof == 1


def test_count_vectorizer_keeps_all_terms(spark):
    made = count_vectorizer(spark.range(3).selectExpr("transform(sequence(0, 99999), x -> concat(id, '-', x)) AS tokens"), "tokens")
    assert made.first()["counts"].size == 300_000


def test_salt_is_a_function_of_the_row(spark):
    left = spark.createDataFrame([("a", i) for i in range(50)], "k string, v long")
    right = spark.createDataFrame([("a", "x")], "k2 string, w string")
    assert skew_join(left, right, "k", "k2").count() == 50


def test_command_starts_from_another_folder(tmp_path):
    script = Path(__file__).resolve().parents[1] / "tagloom" / "run.py"
    done = subprocess.run([sys.executable, str(script), "--help"], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and "--on-missing" in done.stdout


def test_old_snapshots_are_retired(spark, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "profile"), keep=2)
    for i in range(4):
        store.upsert(spark.createDataFrame([("u", str(i))], "userId string, tagsId string"))
    assert sorted(p.name for p in (tmp_path / "profile").glob("manifest-*")) == ["manifest-000003.json", "manifest-000004.json"]
    assert store.version() == 4 and store.read().collect()[0].tagsId == "3" and store.read(3).collect()[0].tagsId == "2"


def test_products_are_no_tags(spark, tmp_path):
    assert job(BP, JobOptions("2019-08-31")).products and not job(CYCLE, JobOptions("2019-08-31")).products
    tags = spark.createDataFrame([(60, "p", "inType=Parquet##hbaseTable=t##family=f##selectFields=userId", 4, 3)], TAG_SCHEMA)
    lists = spark.createDataFrame([("u", "57,9,24")], "userId string, tagsId string")
    profile, products = (ProfileStore(spark, str(tmp_path / name)) for name in ("profile", "products"))
    profile.upsert(spark.createDataFrame([("u", "24")], "userId string, tagsId string"))
    listing = TagJob(60, lambda source, rules: source, products=True)
    with pytest.raises(ValueError):
        run_jobs([listing], tags, lambda spec: lists, profile)
    for _ in range(2):
        written = run_jobs([listing], tags, lambda spec: lists, profile, True, products)
    assert [tuple(r) for r in written.collect()] == [("u", "24")]
    assert [tuple(r) for r in products.read().collect()] == [("u", "57,9,24")]


def test_tables_are_loaded_from_text(spark, tmp_path):
    assert [len(TABLE_COLUMNS[t]) == len(set(TABLE_COLUMNS[t])) for t in sorted(TABLE_COLUMNS)] == [True] * 4
    width = len(TABLE_COLUMNS["orders"])
    lines = ["\x01".join(f"{key}{i}" if i else key for i in range(n)) for key, n in (("a", width), ("b", width - 1), ("c", width - 2), ("a", width))]
    (tmp_path / "lines").write_text("\n".join(lines))
    load.main(["--table", "orders", "--lines", str(tmp_path / "lines"), "--out", str(tmp_path / "t.parquet")], spark)
    found = {r["id"]: r for r in read_fields(spark, str(tmp_path / "t.parquet"), ["id", "siteid", "memberId", "ckcode"]).collect()}
    assert set(found) == {"a", "b"} and found["a"]["memberId"] == "a12" and found["b"]["ckcode"] == "" and found["a"]["ckcode"] == f"a{width - 1}"
