"""Bucketed stores, state kept between runs, and one scan for several jobs."""

import json

import pytest
from pyspark.sql import functions as F

from tagloom import run
from tagloom.operators.profile import changed_lists, one_change
from tagloom.plans import tags as jobs
from tagloom.plans.registry import JobOptions, job
from tagloom.plans.state import LOGS, ORDERS, StateStore, merged, summed
from tagloom.plans.template import shared_states
from tagloom.sources.readers import TAG_SCHEMA
from tagloom.sources.stores import BucketStore, Conflict, ProfileStore, publish, read_text
from tagloom.sources.tags import TagStore

P = "userId string, tagsId string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def many(spark, n=200, tag="a"):
    return spark.range(n).select(F.col("id").cast("string").alias("userId"), F.lit(tag).alias("tagsId"))


def folders(store, version):
    return json.loads(read_text(store.spark, f"{store.root}/manifest-{version:06d}.json"))["folders"]


def test_one_changed_user_rewrites_one_bucket(spark, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "profile"), buckets=8)
    store.replace(many(spark))
    store.upsert(spark.createDataFrame([("7", "b")], P))
    before, after = folders(store, 1), folders(store, 2)
    assert set(before) == set(after) == {str(b) for b in range(8)}
    assert sum(before[b] != after[b] for b in before) == 1
    found = dict(rows(store.read()))
    assert len(found) == 200 and found.pop("7") == "b" and set(found.values()) == {"a"}
    assert dict(rows(store.read(1)))["7"] == "a"
    store.add(spark.createDataFrame([("7", "c"), ("new", "c,c, ,a"), (None, None)], P))
    found = dict(rows(store.read()))
    assert found["7"] == "b,c" and found["new"] == "a,c" and store.version() == 3


def test_a_merge_shuffles_its_rows_once(spark, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "profile"), buckets=4)
    store.replace(many(spark))
    plans = []

    def combine(stacked, keys):
        found = changed_lists(stacked, keys)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    store.merge(one_change(many(spark, 50, "b")), combine)
    assert plans[0].count("Exchange") == 1


def test_second_writer_fails_and_a_dead_one_is_in_nobodys_way(spark, tmp_path):
    first, second = (ProfileStore(spark, str(tmp_path / "profile"), buckets=2) for _ in range(2))
    first.replace(many(spark, 3))
    base = second.version()
    first.upsert(spark.createDataFrame([("1", "b")], P))
    for write in (lambda: second.add(many(spark, 1, "z"), base), lambda: second.replace(many(spark, 1, "z"), base)):
        with pytest.raises(RuntimeError, match="another job"):
            write()
    (tmp_path / "profile" / "data-dead" / "_bucket=0").mkdir(parents=True)
    (tmp_path / "profile" / "manifest-000003.json.x.tmp").write_text("{")
    assert second.version() == 2
    second.upsert(spark.createDataFrame([("2", "c")], P))
    assert rows(first.read()) == [("0", "a"), ("1", "b"), ("2", "c")]
    assert len(list((tmp_path / "profile").glob("data-*"))) == 4  # those of three versions and the dead one's


def test_a_name_is_published_once(spark, tmp_path):
    path = str(tmp_path / "name")
    assert read_text(spark, path) is None
    assert publish(spark, path, "one") and not publish(spark, path, "two") and read_text(spark, path) == "one"
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["name"]
    with pytest.raises(Exception):
        publish(spark, str(tmp_path / "name" / "below"), "x")


def test_old_versions_go_with_folders_that_only_they_name(spark, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "profile"), keep=2, buckets=4)
    store.replace(many(spark))
    for k in range(4):
        store.upsert(spark.createDataFrame([("7", str(k))], P))
    left = {p.name for p in (tmp_path / "profile").glob("data-*")}
    assert left == {*folders(store, 4).values(), *folders(store, 5).values()} and len(left) == 3
    with pytest.raises(KeyError):
        store.read(3)
    assert dict(rows(store.read(4)))["7"] == "2"
    with pytest.raises(ValueError):
        ProfileStore(spark, "x", keep=1)


def test_empty_store_and_empty_changes(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "s"), "k string, n long", "k", buckets=3)
    assert store.read().count() == 0 and store.note() == {}
    store.replace(spark.createDataFrame([], "k string, n long"), note={"seen": 4})
    assert store.version() == 1 and store.read().count() == 0 and store.note() == {"seen": 4}


ORDER_ROWS = [("1", "a", "10.5", "0", "1566979200", "card", 1), ("1", "b", "x", "1", "", "cash", 1), ("2", "c", "3", "2", "1566979201", None, 2),
              ("1", "d", "4", None, "1567979201", "card", 2), (None, "e", "1", "0", "1", "card", 3), ("1", "a", "10.5", "0", "1566979200", "card", 3),
              ("3", None, None, "0", None, "", 3)]
ORDER_SCHEMA = "memberId string, orderSn string, orderAmount string, couponCodeValue string, finishTime string, paymentCode string, load long"
ALL = [m.name for m in ORDERS.measures]


def test_state_of_parts_is_that_of_the_whole(spark):
    orders = spark.createDataFrame(ORDER_ROWS, ORDER_SCHEMA)
    whole = rows(summed(orders, ORDERS, ALL))
    for split in ("load = 1", "memberId = '1'", "true", "false"):
        other = orders.where(f"NOT coalesce({split}, false)")
        parts = summed(orders.where(f"coalesce({split}, false)"), ORDERS, ALL).unionByName(summed(other, ORDERS, ALL))
        assert rows(merged(parts, ORDERS, ALL)) == whole


def test_features_from_state_equal_those_from_the_table(spark):
    orders = spark.createDataFrame(ORDER_ROWS, ORDER_SCHEMA)
    state = summed(orders, ORDERS, ALL)
    assert rows(jobs.rfm_of_state(state, "2019-09-02")) == rows(jobs.rfm_features(orders, "2019-09-02"))
    assert rows(jobs.psm_of_state(state)) == rows(jobs.psm_features(orders))
    bands = spark.createDataFrame([(24, "0-3"), (25, "4-9")], "id long, rule string")
    assert rows(jobs.cycle_of_state(state, bands, "2019-09-12")) == rows(jobs.cycle_tag(orders, bands, "2019-09-12"))
    methods = spark.createDataFrame([(30, "card"), (31, "cash"), (35, "other")], "id long, rule string")
    assert rows(jobs.payment_of_state(state, methods)) == rows(jobs.payment_tag(orders, methods))
    logs = spark.createDataFrame([("u", "x", "bad"), ("u", "y", "2019-08-30 10:00:00"), ("u", "x", "2019-08-29 10:00:00"), ("v", None, None), (None, "x", "2019-08-30")],
                                 "global_user_id string, loc_url string, log_time string")
    assert rows(jobs.rfe_of_state(summed(logs, LOGS, ["last_visit", "views"]), "2019-08-31")) == rows(jobs.rfe_features(logs, "2019-08-31"))


def test_rows_are_added_once(spark, tmp_path):
    orders = spark.createDataFrame(ORDER_ROWS, ORDER_SCHEMA)
    store = StateStore(spark, str(tmp_path / "state"), ORDERS, buckets=4)
    assert store.seen() is None and store.read().count() == 0
    for last in (1, 1, 2, 3, 3):
        state = store.add(orders.where(F.col("load") <= last), "load")
        assert rows(state) == rows(summed(orders.where(F.col("load") <= last), ORDERS, ALL)) and store.seen() == last
    assert store.store.version() == 3
    as_text = StateStore(spark, str(tmp_path / "text"), ORDERS, ["orders"], buckets=2)
    as_text.add(orders.withColumn("load", F.when(F.col("load") > 1, F.col("load").cast("string"))), "load")
    assert as_text.add(orders.withColumn("load", F.lit("3")), "load").agg(F.sum("orders")).first()[0] == 6


def test_jobs_of_one_table_share_a_scan(spark, tmp_path):
    tags = spark.createDataFrame([(23, "c", "inType=P##hbaseTable=o##selectFields=memberId,finishTime", 4, 3),
                                  (29, "p", "inType=P##hbaseTable=o##selectFields=memberId,paymentCode", 4, 3),
                                  (50, "s", "inType=P##hbaseTable=o##selectFields=memberId,orderSn,orderAmount,couponCodeValue", 4, 3),
                                  (45, "a", "inType=P##hbaseTable=l##selectFields=global_user_id,loc_url,log_time", 4, 3)], TAG_SCHEMA)
    reads = []

    def read(spec):
        reads.append((spec.table, spec.fields))
        return spark.createDataFrame(ORDER_ROWS, ORDER_SCHEMA).select(*spec.fields)

    options = JobOptions("2019-09-02")
    states = shared_states([job(t, options) for t in (23, 29, 50, 45)], tags, read)
    assert reads == [("o", ("memberId", "paymentCode", "finishTime", "orderAmount", "couponCodeValue"))] and set(states) == {23, 29, 50}
    assert states[23] is states[29] and states[23].columns == ["memberId", "paymentCode", "last_time", "codes", "tdon", "ton", "tda", "tra"]
    reads.clear()
    states = shared_states([job(t, options) for t in (23, 50)], tags, read)
    assert reads == [("o", ("memberId", "finishTime", "orderAmount", "couponCodeValue"))] and states[23].count() == 4


def test_runs_with_kept_states_from_the_command_line(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([(23, "c", "inType=P##hbaseTable=o##selectFields=memberId,finishTime", 4, 3), (29, "p", "inType=P##hbaseTable=o##selectFields=memberId,paymentCode", 4, 3),
                           (24, "0-7", "0-7", 5, 23), (25, "8-9999", "8-9999", 5, 23), (30, "card", "card", 5, 29), (35, "other", "other", 5, 29)],
                          TAG_SCHEMA).write.parquet(f"{root}/tags.parquet")
    orders = spark.createDataFrame(ORDER_ROWS, ORDER_SCHEMA)
    arguments = ["--tag", "23", "29", "--as-of", "2019-09-12", "--tags", f"{root}/tags.parquet", "--sources", root, "--profile", f"{root}/profile", "--replace-siblings"]
    for last in (2, 3):
        orders.where(F.col("load") <= last).write.mode("overwrite").parquet(f"{root}/o.parquet")
        run.main([*arguments, "--states", f"{root}/states", "--new-by", "load", "--buckets", "3"], spark)
    kept = rows(ProfileStore(spark, f"{root}/profile").read())
    arguments[arguments.index(f"{root}/profile")] = f"{root}/anew"
    run.main(arguments, spark)
    assert kept == rows(ProfileStore(spark, f"{root}/anew").read()) and {u for u, _ in kept} == {"1", "2", "3"}
    with pytest.raises(SystemExit):
        run.main([*arguments, "--states", "x"], spark)


def test_tag_table_from_a_database(spark, monkeypatch):
    """The options only: no database is started."""
    asked = []
    monkeypatch.setattr(run, "read_tags_jdbc", lambda *a: asked.append(a[1:]) or spark.createDataFrame([], TAG_SCHEMA))
    for more, ranges in (([], ()), (["--tags-range", "1", "900", "8"], ("id", 1, 900, 8))):
        with pytest.raises(KeyError):
            run.main(["--tag", "23", "--as-of", "2019-09-12", "--tags", "jdbc:mysql://host/db", "--tags-property", "user=u", "--tags-property", "password=a=b",
                      "--sources", "s", "--profile", "p", *more], spark)
        assert asked[-1] == ("jdbc:mysql://host/db", "tbl_basic_tag", {"user": "u", "password": "a=b"}, *ranges)


NEW = "name string, rule string, level int, pid long"


def test_two_writers_of_tags(spark, tmp_path):
    store = TagStore(spark, str(tmp_path / "tags"), buckets=16)
    tags = spark.createDataFrame([(4, "a", None, 1, -1), (9, "b", "r", 2, 4)], TAG_SCHEMA)
    models = spark.createDataFrame([(5, 9, "m", 1), (3, 9, "l", 2)], "id long, tag_id long, model_name string, state int")
    store.load(tags, models)
    assert rows(store.models()) == [(3, 9, "l", 2), (5, 9, "m", 1)] and rows(store.tags()) == rows(tags)
    first = spark.createDataFrame([("d", None, 2, 4), ("c", None, 2, 4)], NEW)
    second = spark.createDataFrame([("e", "x", 2, 4, "n", 1)], NEW + ", model_name string, state int")
    assert [r[:2] for r in rows(store.append(first, ["name"]))] == [(10, "c"), (11, "d")]
    with pytest.raises(Conflict):
        store.append(second, ["name"], base=1)
    assert store.version() == 2 and store.tags().count() == 4
    before = folders(store, 2)
    assert [r[:2] for r in rows(store.append(second, ["name"]))] == [(12, "e")]
    assert (6, 12, "n", 1) in rows(store.models())
    assert sum(before.get(b) != f for b, f in folders(store, 3).items()) == 1
    assert store.append(first.limit(0), ["name"]).count() == 0 and store.version() == 3


def test_a_writer_that_was_overtaken_starts_anew(spark, tmp_path):
    store, other = (TagStore(spark, str(tmp_path / "tags"), buckets=2) for _ in range(2))
    store.load(spark.createDataFrame([(1, "a", None, 1, -1)], TAG_SCHEMA))
    plain, overtaken = store.merge, []

    def late(changes, combine, base=None, note=None):
        if not overtaken:
            overtaken.append(other.append(spark.createDataFrame([("b", None, 2, 1)], NEW), ["name"]))
        return plain(changes, combine, base, note)

    store.merge = late
    made = store.append(spark.createDataFrame([("c", None, 2, 1)], NEW), ["name"])
    assert rows(made)[0][:2] == (3, "c") and [r[0] for r in rows(store.tags())] == [1, 2, 3] and store.version() == 3


def test_ids_of_tags_are_given_once(spark, tmp_path):
    store = TagStore(spark, str(tmp_path / "tags"), buckets=2)
    paths = "name1 string, name2 string, name3 string"
    made = store.add_paths(spark.createDataFrame([("a", "b", "c"), ("a", "b", "d"), ("a", "b", "c")], paths))
    assert [r[:2] for r in rows(made)] == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    store.load(store.tags().where("id < 4"))  # takes out the newest tag
    made = store.add_paths(spark.createDataFrame([("a", "b", "c"), ("a", "b", "e")], paths))
    assert [r[:2] + r[4:5] for r in rows(made)] == [(5, "e", 2)]
    assert store.add_paths(spark.createDataFrame([("a", "b", "e")], paths)).count() == 0 and store.version() == 3
    with pytest.raises(Exception, match="without its tag"):
        store.load(store.tags(), spark.createDataFrame([(1, 77, "m", 1)], "id long, tag_id long, model_name string, state int"))
    assert store.version() == 3
