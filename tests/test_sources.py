"""Readers, stores, the job template and the command line."""

import pytest
from pyspark.sql import functions as F

from tagloom import run, session
from tagloom.operators.cluster import fit_kmeans
from tagloom.operators.profile import collect_tags, drop_tags, merge_all_users, merge_new_users, merge_new_users_sql, upsert
from tagloom.plans.template import TagJob, parquet_source, run_job
from tagloom.sources.readers import (LOG_COLUMNS, read_csv, read_delimited, read_fields, read_homes, read_libsvm, read_ratings,
                                     read_tags, read_tags_jdbc)
from tagloom.sources.stores import ProfileStore, stored_centres

SEP = "\x01"


def pairs(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def write(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_delimited(spark, tmp_path):
    lines = [SEP.join(f) for f in (["1", "a", "x"], ["2", "b"], ["3", "c", "y", "z"], ["4"], ["1", "a2", "x2"], ["5", "", ""],
                                   ["6", "é", " "])]
    path = write(tmp_path / "part-0.txt", lines)
    kept = {r["id"]: (r["n"], r["s"]) for r in read_delimited(spark, path, ["id", "n", "s"]).collect()}
    assert kept == {"1": ("a2", "x2"), "2": ("b", ""), "5": ("", ""), "6": ("é", " ")}
    strict = {r["id"] for r in read_delimited(spark, path, ["id", "n", "s"], strict_compat=True).collect()}
    assert strict == {"1", "2", "6"}  # both empty fields of line 5 are forgotten, so it is too short
    assert len(LOG_COLUMNS) == 11


def test_delimited_last_line_over_many_splits(spark, tmp_path):
    path = write(tmp_path / "big.txt", [SEP.join([str(i % 50), str(i)]) for i in range(5000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = {int(r["id"]): int(r["v"]) for r in read_delimited(spark, path, ["id", "v"]).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {i: 4950 + i for i in range(50)}


def test_delimited_last_file_wins_without_a_sort(spark, tmp_path):
    # The last file by name is the shortest one, so the scan reads it last or first, but not in the order of the names.
    write(tmp_path / "a 1.txt", [SEP.join([str(i % 7), f"a{i}"]) for i in range(900)])
    write(tmp_path / "b%20é.txt", [SEP.join([str(i % 9), f"b{i}"]) for i in range(2000)])
    write(tmp_path / "c=1.txt", [SEP.join(["3", "c0"]), SEP.join(["3", "c1"]), SEP.join(["100", "c2"])])
    loaded = read_delimited(spark, str(tmp_path), ["id", "v"])
    want = {str(k): f"b{max(i for i in range(2000) if i % 9 == k)}" for k in range(9)} | {"3": "c1", "100": "c2"}
    assert {r["id"]: r["v"] for r in loaded.collect()} == want
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan and "HashAggregate" in plan


def test_delimited_empty_folder(spark, tmp_path):
    (tmp_path / "none.txt").write_text("")
    assert read_delimited(spark, str(tmp_path), ["id", "v"]).collect() == []


def test_text_formats(spark, tmp_path):
    homes = write(tmp_path / "homes", ["4424038|Farmington|2058.0|4|2|3|11|0.21|249900.0"])
    row = read_homes(spark, homes).first()
    assert (row["city"], row["sqFt"], row["bedrooms"], row["price"]) == ("Farmington", 2058.0, 4, 249900.0)
    ratings = write(tmp_path / "ratings", ["196\t242\t3\t881250949"])
    assert tuple(read_ratings(spark, ratings).first()) == (196, 242, 3.0)
    iris = write(tmp_path / "iris", ["5.1,3.5,1.4,0.2,Iris-setosa"])
    assert tuple(read_csv(spark, iris, "a double, b double, c double, d double, s string").first()) == (5.1, 3.5, 1.4, 0.2, "Iris-setosa")
    svm = write(tmp_path / "svm", ["1 1:5.1 4:0.2"])
    row = read_libsvm(spark, svm, 4).first()
    assert row["label"] == 1.0 and list(row["features"].toArray()) == [5.1, 0, 0, 0.2]


def test_read_fields_reads_only_them(spark, sf_dir):
    df = read_fields(spark, f"{sf_dir}/customer.parquet", ["c_custkey", "c_mktsegment"])
    assert df.dtypes == [("c_custkey", "string"), ("c_mktsegment", "string")]
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in df._jdf.queryExecution().toString()


def test_jdbc_reader_passes_its_ranges(spark):
    calls = {}

    class Reader:
        def jdbc(self, url, table, **options):
            calls[table] = options
            return "frame"

    class Session:
        read = Reader()

    assert read_tags_jdbc(Session(), "jdbc:x", "tags", {"user": "u"}) == "frame"
    assert read_tags_jdbc(Session(), "jdbc:x", "ranged", {}, "id", 0, 100, 4) == "frame"
    assert calls["tags"] == {"properties": {"user": "u"}}
    assert calls["ranged"]["numPartitions"] == 4 and calls["ranged"]["column"] == "id"


P = "userId string, tagsId string"


def test_merges(spark):
    new = spark.createDataFrame([("1", "10"), ("1", "11"), ("2", " "), ("3", "7")], P)
    old = spark.createDataFrame([("1", "6,10"), ("2", "5"), ("9", "4")], P)
    assert pairs(merge_new_users(new, old)) == [("1", "10,11,6"), ("2", "5"), ("3", "7")]
    assert pairs(merge_new_users_sql(new, old)) == [("1", "10,11,6"), ("2", "5"), ("3", "7")]
    assert pairs(merge_all_users(new, old)) == [("1", "10,11,6"), ("2", "5"), ("3", "7"), ("9", "4")]
    assert pairs(upsert(old, spark.createDataFrame([("2", None), ("8", "1")], P))) == [("1", "6,10"), ("2", None), ("8", "1"), ("9", "4")]
    assert pairs(collect_tags(spark.createDataFrame([("1", "2,2,1"), ("1", None), ("2", None)], P))) == [("1", "1,2"), ("2", None)]


def test_stale_tags_are_dropped_but_users_stay(spark):
    profile = spark.createDataFrame([("1", "24,5"), ("2", "24"), ("3", "6"), ("4", None)], P)
    stale = spark.createDataFrame([(24, "0-7"), (25, "8-14")], "id long, rule string")
    assert pairs(drop_tags(profile, stale)) == [("1", "5"), ("2", None), ("3", "6"), ("4", None)]


def test_profile_store(spark, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "profile"))
    assert store.version() == 0 and store.read().count() == 0
    store.upsert(spark.createDataFrame([("1", "a"), ("2", "b")], P))
    before = store.read()
    store.upsert(spark.createDataFrame([("2", "c"), ("3", "d")], P))
    assert store.version() == 2
    assert pairs(store.read()) == [("1", "a"), ("2", "c"), ("3", "d")]
    assert pairs(before) == [("1", "a"), ("2", "b")]  # a reader of the old snapshot is not disturbed
    (tmp_path / "profile" / "data-000003").mkdir()  # a write that broke off
    assert store.version() == 2
    store.upsert(spark.createDataFrame([("1", "z")], P))
    assert pairs(store.read())[0] == ("1", "z")


def test_model_store(spark, tmp_path):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 50, 51)], "x double")
    fits = []

    def fit():
        fits.append(1)
        return fit_kmeans(df, ["x"], 2)

    path = str(tmp_path / "m")
    first = stored_centres(spark, path, 2, ["x"], fit)
    assert sorted(c[0] for c in first) == [1.5, 50.5]
    assert stored_centres(spark, path, 2, ["x"], fit) == first and len(fits) == 1
    stored_centres(spark, path, 2, ["x"], fit, refresh=True)
    stored_centres(spark, path, 2, ["y"], fit)  # other features: another model
    assert len(fits) == 3


@pytest.fixture
def shop(spark, tmp_path):
    """Small source tables and a tag table."""
    root = str(tmp_path)
    users = [(str(i), str(1 + i % 2), str(1 + i % 6), f"19{60 + i % 40}-05-31") for i in range(40)]
    spark.createDataFrame(users, "id string, gender string, job string, birthday string").write.parquet(f"{root}/tbl_users.parquet")
    orders = [(str(u), f"o{u}-{n}", str(10.0 * u * n), str(1564415022 - 86400 * (u % 70)), "alipay" if u % 2 else "bitcoin",
               "5.0" if n == 0 else "0.00") for u in range(40) for n in range(1 + u % 5)]
    spark.createDataFrame(orders, "memberId string, orderSn string, orderAmount string, finishTime string, paymentCode string, "
                                  "couponCodeValue string").write.parquet(f"{root}/tbl_orders.parquet")
    goods = [(o[1], ["黑色", "樱花粉", "白色"][i % 3], ["烤箱", "料理机"][i % 2]) for i, o in enumerate(orders)]
    spark.createDataFrame(goods, "cOrderSn string, ogColor string, productType string").write.parquet(f"{root}/tbl_goods.parquet")
    logs = [(str(u), f"http://shop.example/product/{i % (3 + u)}.html", f"2019-08-{1 + i % 28:02d} 09:10:37")
            for u in range(20) for i in range(30)]
    spark.createDataFrame(logs, "global_user_id string, loc_url string, log_time string").write.parquet(f"{root}/tbl_logs.parquet")

    def source(table, fields):
        return f"inType=HBase##zkHosts=h##zkPort=1##hbaseTable={table}##family=detail##selectFields={fields}"

    tags = [(4, "gender", source("tbl_users", "id,gender"), 4, 3), (7, "job", source("tbl_users", "id,job"), 4, 3),
            (14, "age", source("tbl_users", "id,birthday"), 4, 3), (23, "cycle", source("tbl_orders", "memberId,finishTime"), 4, 3),
            (29, "payment", source("tbl_orders", "memberId,paymentCode"), 4, 3),
            (37, "value", source("tbl_orders", "memberId,orderSn,orderAmount,finishTime"), 4, 36),
            (45, "activity", source("tbl_logs", "global_user_id,loc_url,log_time"), 4, 36),
            (50, "sensitivity", source("tbl_orders", "memberId,orderSn,orderAmount,couponCodeValue"), 4, 36),
            (56, "shopping gender", source("tbl_goods", "cOrderSn,ogColor,productType"), 4, 36),
            (60, "brand", source("tbl_logs", "global_user_id,loc_url"), 4, 36)]
    children = {4: ["1", "2"], 7: [str(n) for n in range(1, 7)], 14: ["19600101-19791231", "19800101-19991231"],
                23: ["0-7", "8-14", "15-30", "31-60", "61-90"], 29: ["alipay", "other"], 37: ["1", "2"], 45: ["1"], 50: ["1", "2"],
                56: ["0", "1", "-1"]}
    ids = {}
    for pid, texts in children.items():
        for n, rule in enumerate(texts):
            ids.setdefault(pid, set()).add(str(pid * 100 + n))
            tags.append((pid * 100 + n, rule, rule, 5, pid))
    schema = "id long, name string, rule string, level int, pid long"
    spark.createDataFrame(tags, schema).write.parquet(f"{root}/tags.parquet")
    return root, ids


def test_all_jobs_from_the_command_line(spark, shop):
    root, ids = shop
    store = ProfileStore(spark, f"{root}/profile")
    for done, tag in enumerate((4, 7, 14, 23, 29, 37, 45, 50, 56, 60), 1):
        run.main(["--tag", str(tag), "--as-of", "2019-09-01", "--tags", f"{root}/tags.parquet", "--sources", root,
                  "--profile", f"{root}/profile", "--models", f"{root}/models"], spark)
        assert store.version() == done
        profile = {r["userId"]: set(r["tagsId"].split(",")) for r in store.read().collect()}
        if tag in ids:
            tagged = [len(own & ids[tag]) for own in profile.values()]
            assert max(tagged) == 1 and sum(tagged) > 0
    assert len(profile) == 40
    assert all(len(own & ids[4]) == 1 and len(own & ids[29]) == 1 for own in profile.values())


def test_several_jobs_share_one_write(spark, shop):
    root, ids = shop
    run.main(["--tag", "4", "23", "29", "--as-of", "2019-09-01", "--tags", f"{root}/tags.parquet", "--sources", root,
              "--profile", f"{root}/together", "--replace-siblings"], spark)
    store = ProfileStore(spark, f"{root}/together")
    assert store.version() == 1
    own = [set(r["tagsId"].split(",")) for r in store.read().collect()]
    assert len(own) == 40 and all(len(t & ids[4]) == 1 and len(t & ids[29]) == 1 for t in own)


def test_typed_sources_give_the_same_tags(spark):
    from tagloom.plans import tags

    rules = spark.createDataFrame([(1, "1"), (2, "2")], "id long, rule string")
    bands = spark.createDataFrame([(8, "19800101-19991231")], "id long, rule string")
    text = spark.createDataFrame([("1", "2", "1990-01-02"), ("2", "1", "1970-01-01")], "id string, gender string, birthday string")
    typed = text.select(F.col("id").cast("long").alias("id"), F.col("gender").cast("int").alias("gender"),
                        F.col("birthday").cast("date").alias("birthday"))
    assert pairs(tags.exact_tag(text, rules, "gender")) == pairs(tags.exact_tag(typed, rules, "gender")) == [("1", "2"), ("2", "1")]
    assert pairs(tags.age_tag(text, bands)) == pairs(tags.age_tag(typed, bands)) == [("1", "8")]


def test_unknown_job(spark, shop):
    root, _ = shop
    with pytest.raises(KeyError):
        run.main(["--tag", "99", "--as-of", "2019-09-01", "--tags", f"{root}/tags.parquet", "--sources", root, "--profile", f"{root}/p"], spark)


def test_replaced_siblings(spark, shop):
    root, ids = shop
    tags = read_tags(spark, f"{root}/tags.parquet")
    store = ProfileStore(spark, f"{root}/profile2")

    def everyone(tag_id):
        return TagJob(23, lambda source, _: source.select(F.col("memberId").alias("userId"), F.lit(str(tag_id)).alias("tagsId")).distinct())

    run_job(everyone(2300), tags, parquet_source(spark, root), store)
    kept = run_job(everyone(2301), tags, parquet_source(spark, root), store)
    assert {r["tagsId"] for r in kept.collect()} == {"2300,2301"}
    moved = run_job(everyone(2302), tags, parquet_source(spark, root), store, replace_siblings=True)
    assert {r["tagsId"] for r in moved.collect()} == {"2302"}


def test_shared_folder_is_required_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://somewhere"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_second_writer_of_a_version_fails_and_loses_nothing(spark, tmp_path):
    root = str(tmp_path / "profile")
    first, second = ProfileStore(spark, root), ProfileStore(spark, root)
    row = lambda user, tags: spark.createDataFrame([(user, tags)], "userId string, tagsId string")
    first.replace(row("1", "a"))
    base = second.version()
    first.upsert(row("2", "b"))
    with pytest.raises(RuntimeError, match="another job"):
        second.replace(row("3", "c"), base)
    with pytest.raises(RuntimeError, match="another job"):
        second.add(row("3", "c"), base)
    assert sorted(map(tuple, first.read().collect())) == [("1", "a"), ("2", "b")]


def test_broken_write_gives_its_version_up(spark, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "profile"))
    broken = spark.sql("SELECT '1' AS userId, CAST(raise_error('broken') AS STRING) AS tagsId")
    with pytest.raises(Exception, match="broken"):
        store.replace(broken)
    assert store.upsert(spark.createDataFrame([("1", "a")], "userId string, tagsId string")).count() == 1
