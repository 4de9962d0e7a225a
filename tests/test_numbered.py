"""Rows numbered over many ranges, with a payload that a count doesn't read."""

import pytest
from pyspark.sql import functions as F

from folio.operators import filings, ingest, upsert, worklist


def rows(spark, n=2_000_000, parts=64):
    return spark.range(0, n, 1, parts).select((F.col("id") * 7919 % n).alias("k"), F.concat(F.lit("payload of some length "), F.col("id").cast("string")).alias("payload"))


@pytest.fixture(params=[64, None])
def partitions(request, spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    if request.param:
        spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_each_number_once_and_in_order(spark, partitions):
    n = 2_000_000
    out = upsert.numbered(rows(spark, n), ["k"], "at")
    got = out.agg(F.count("*"), F.count_distinct("at"), F.min("at"), F.max("at"), F.count(F.when(F.col("at") != F.col("k") + 1, 1))).first()
    assert tuple(got) == (n, n, 1, n, 0)


def test_next_version_gives_each_row_an_id(spark, partitions):
    n = 300_000
    raw = spark.createDataFrame([(5, 1, "old")], "DataId long, ProcessingId long, payload string")
    pending = rows(spark, n).select((F.col("k") % 11 + 2).alias("ProcessingId"), "payload")
    out, _ = ingest.next_version(raw, {}, pending, spark.createDataFrame([(2,)], "ProcessingId long"))
    assert tuple(out.agg(F.count("*"), F.count_distinct("DataId"), F.max("DataId")).first()) == (n + 1, n + 1, n + 5)


def test_get_or_create_over_many_ranges(spark, partitions):
    n = 200_000
    dim = spark.createDataFrame([(3, "payload of some length 1")], "id long, name string")
    out = upsert.get_or_create(dim, rows(spark, n).select(F.col("payload").alias("name")), "id", "name")
    assert tuple(out.agg(F.count("*"), F.count_distinct("id"), F.count_distinct("name"), F.max("id")).first()) == (n, n, n, n + 2)


def test_ties_are_numbered_alike_however_rows_are_dealt(spark):
    few = spark.createDataFrame([(1, f"row {i}") for i in range(50)], "k long, payload string")
    order = lambda df: {r.payload: r.at for r in upsert.numbered(df, ["k"], "at").collect()}
    assert order(few.repartition(1)) == order(few.repartition(7, "payload"))


def test_new_rows_and_their_children_are_all_there(spark, partitions):
    n = 200_000
    work = spark.createDataFrame([(4, "x", "y")], "Id int, k string, payload string")
    new = rows(spark, n).withColumn("k", F.col("k").cast("string"))
    both, child = worklist.insert_with_child(work, new, ["k"])
    assert tuple(both.agg(F.count("*"), F.count_distinct("Id"), F.max("Id")).first()) == (n + 1, n + 1, n + 4)
    own = both.select(F.col("Id").alias("ID"), F.col("k").alias("name"))
    assert child.join(own, "ID").where("k = name").count() == n


def test_find_or_create_over_many_ranges(spark, partitions):
    n = 200_000
    wanted = rows(spark, n).select(F.when(F.col("k") > 0, F.col("k")).alias("k"), F.col("k").alias("j"), "payload")
    found, table = filings.find_or_create(spark.createDataFrame([(9, 5, 5)], "id long, k long, j long"), wanted, ["k", "j"])
    assert tuple(table.agg(F.count("*"), F.count_distinct("id"), F.max("id")).first()) == (n, n, n + 8)
    assert tuple(found.agg(F.count("*"), F.count_distinct("id"), F.count("payload")).first()) == (n, n, n)
