"""The keyed store against whole tables, and what a crash, a second writer and a repeated batch leave."""

import random

import pytest
from pyspark.sql import functions as F

from folio.operators.upsert import replace_groups, upsert
from folio.sources.store import Conflict, KeyedStore
from folio.streaming import logs


def rows_of(df):
    return sorted(map(str, df.collect()))


def size(store):
    import os

    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(store.path + "/data") for f in files if f.endswith(".parquet"))


@pytest.mark.parametrize("kind", ["long", "string"])
def test_writes_equal_those_of_a_whole_table(spark, tmp_path, kind):
    rng = random.Random(kind)
    key = (lambda i: i) if kind == "long" else (lambda i: f"k{i:04d}")
    make = lambda n, tag: spark.createDataFrame([(key(rng.randrange(300)), f"{tag}{i}", None if i % 3 else i) for i in range(n)], f"k {kind}, v string, n long")
    whole = make(200, "a").dropDuplicates(["k"]).cache()
    store = KeyedStore(spark, str(tmp_path / "t"), "k", rows=20)
    assert store.create(whole) == 1 and len(store.manifest()["ranges"]) > 5
    for step in range(3):
        new = make(25, f"r{step}").cache()
        groups = new.select("k").union(spark.createDataFrame([(key(step * 7),)], f"k {kind}")).distinct()
        store.replace(new, groups)
        after = replace_groups(whole, new, groups, "k")
        whole = spark.createDataFrame(after.collect(), after.schema)
        assert rows_of(store.read()) == rows_of(whole)
    one = whole.dropDuplicates(["k"])
    store = KeyedStore(spark, str(tmp_path / "u"), "k", rows=20)
    store.create(one)
    new = make(40, "m").dropDuplicates(["k"]).cache()
    store.merge(new)
    assert rows_of(store.read()) == rows_of(upsert(store.read(1), new, "k"))
    for r, after in zip(store.manifest()["ranges"], [*store.manifest()["ranges"][1:], {"low": None}], strict=True):
        if r["folder"]:
            got = spark.read.parquet(f"{store.path}/{r['folder']}").where("k is not null").agg(F.min("k"), F.max("k")).first()
            assert (r["low"] is None or got[0] >= r["low"]) and (after["low"] is None or got[1] < after["low"])


def test_one_hundredth_of_the_keys_rewrites_about_one_hundredth_of_the_bytes(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "t"), "k", rows=1000)
    payload = F.sha2(F.col("id").cast("string"), 256).alias("v")
    store.create(spark.range(200_000).select((F.col("id") % 20_000).alias("k"), payload))
    before = size(store)
    store.replace(spark.range(2000).select((5000 + F.col("id") % 200).alias("k"), payload))
    assert size(store) - before < 0.03 * before
    assert store.read().count() == 200_000 and store.read().where("k between 5000 and 5199").count() == 2000


def test_a_write_that_dies_leaves_the_version_before(spark, tmp_path, monkeypatch):
    store = KeyedStore(spark, str(tmp_path / "t"), "k", rows=10)
    store.create(spark.range(50).select(F.col("id").alias("k")))
    was = rows_of(store.read())
    with monkeypatch.context() as m:
        m.setattr(KeyedStore, "_publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.replace(spark.range(40, 70).select(F.col("id").alias("k")))
    assert rows_of(store.read()) == was and store.versions() == [1]
    dead = size(store)
    store.vacuum()
    assert size(store) < dead and rows_of(store.read()) == was
    assert store.replace(spark.range(40, 70).select(F.col("id").alias("k"))) == 2 and store.read().count() == 70


def test_readers_keep_their_version_and_a_second_writer_conflicts(spark, tmp_path):
    one, two = (KeyedStore(spark, str(tmp_path / "t"), "k", rows=10) for _ in range(2))
    one.create(spark.createDataFrame([(i, "old") for i in range(30)], "k long, v string"))
    pinned = one.read()
    stale = two.manifest()
    one.replace(spark.createDataFrame([(3, "new")], "k long, v string"))
    two.manifest = lambda *_: stale
    with pytest.raises(Conflict):
        two.replace(spark.createDataFrame([(9, "lost")], "k long, v string"))
    assert pinned.where("v = 'old'").count() == 30 and one.read().where("v = 'new'").count() == 1 and one.read().where("v = 'lost'").count() == 0
    for i in range(4):
        one.replace(spark.createDataFrame([(i, f"{i}")], "k long, v string"))
    was = rows_of(one.read())
    one.compact()
    one.vacuum(keep=1)
    assert rows_of(one.read()) == was and len(one.versions()) == 1
    with pytest.raises(Conflict):
        one.create(one.read())


def test_cases(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "t"), "k", rows=5)
    store.create(spark.createDataFrame([], "k long, v string"))
    assert store.read().count() == 0
    store.replace(spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "k long, v string"))
    store.replace(spark.createDataFrame([(None, "c"), (2, None)], "k long, v string").withColumn("more", F.lit(1)))
    assert rows_of(store.read()) == rows_of(spark.createDataFrame([(None, "a"), (1, "b"), (1, "b"), (None, "c"), (2, None)], "k long, v string"))
    store.replace(spark.createDataFrame([(7, f"{i}") for i in range(200)], "k long, v string"))  # one key of many ranges' rows
    assert store.read().where("k = 7").count() == 200
    assert store.replace(spark.createDataFrame([], "k long, v string")) == 5 and store.read().count() == 205
    with pytest.raises(ValueError):
        KeyedStore(spark, str(tmp_path / "none"), "k").read()


def test_a_stream_goes_on_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    at = str(tmp_path / "in")
    table = str(tmp_path / "table")
    for i in range(3):
        spark.createDataFrame([(k, f"{i}") for k in range(i, i + 4)], "k long, v string").coalesce(1).write.mode("append").parquet(at)
        logs.ingest_keyed(spark, spark.readStream.schema("k long, v string").parquet(at), table, "k", rows=2).awaitTermination()
    store = KeyedStore(spark, table, "k")
    assert {tuple(r) for r in store.read().collect()} == {(0, "0"), (1, "1"), (2, "2"), (3, "2"), (4, "2"), (5, "2")}
    was = store.versions()
    assert store.replace(spark.createDataFrame([(0, "again")], "k long, v string"), batch=2) == was[-1] and store.versions() == was


def test_logs_are_appended_and_read_by_year(spark, tmp_path):
    folder = str(tmp_path / "log")
    assert logs.read_log(spark, folder).count() == 0
    rows = spark.createDataFrame([("2023-05-01 00:00:00", "1"), ("2024-05-01 00:00:00", "2"), ("2024-06-01 00:00:00", "x")], "Time string, Id string").withColumn("Time", F.col("Time").cast("timestamp"))
    logs.append_log(rows, folder)
    logs.append_log(rows.where("Id = '2'"), folder)
    assert logs.read_log(spark, folder).count() == 4 and logs.read_log(spark, folder, 2024).count() == 3
    assert sorted(r.Id for r in logs.read_log(spark, folder, 2024).where("Id is not null").collect()) == [2, 2]
    assert logs.read_log(spark, folder).columns == list(logs.LOG)
    (tmp_path / "log" / "year=2024" / "part-bad.parquet").write_text("no table")
    with pytest.raises(Exception):  # noqa: B017
        logs.read_log(spark, folder).count()
