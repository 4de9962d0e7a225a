"""Queries of the keyed store: all orders kept by customer, with a flush that replaces and clears groups, and a merge of some columns."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from folio.plans.catalogue import query, read
from folio.shared import folder
from folio.sources.store import KeyedStore


def _new_store(spark, key: str, rows: int) -> KeyedStore:
    path = f"{folder(spark)}/store-{uuid.uuid4().hex[:12]}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return KeyedStore(spark, path, key, rows)


@query("""
SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_custkey NOT BETWEEN 100 AND 140
UNION ALL SELECT o_custkey, o_orderkey + 100000000, o_totalprice, 'N' FROM orders WHERE o_custkey BETWEEN 100 AND 120
""")
def store_flush(spark, sf_dir):
    """The customers 100 to 140 are flushed: those up to 120 have new orders, the others are cleared."""
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    store = _new_store(spark, "o_custkey", 5_000)
    store.create(orders)
    new = orders.where("o_custkey between 100 and 120").withColumns({"o_orderkey": F.col("o_orderkey") + 100_000_000, "o_orderstatus": F.lit("N")})
    store.replace(new, orders.where("o_custkey between 100 and 140").select("o_custkey").distinct())
    return store.read()


@query("""
SELECT c_custkey, CASE WHEN c_custkey BETWEEN 50 AND 80 THEN 'moved ' || c_name ELSE c_name END AS c_name, CASE WHEN c_custkey BETWEEN 50 AND 80 AND c_custkey % 2 = 0 THEN 0 ELSE c_nationkey END AS nation FROM customer
UNION ALL SELECT c_custkey + 1000000000, 'moved ' || c_name, -1 FROM customer WHERE c_custkey BETWEEN 50 AND 80
""")
def store_merge(spark, sf_dir):
    """Customers 50 to 80 get another name, every second another nation, the others' nation being null in what comes; as many rows are new."""
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    store = _new_store(spark, "c_custkey", 500)
    store.create(customers)
    some = customers.where("c_custkey between 50 and 80").withColumn("c_name", F.concat(F.lit("moved "), "c_name"))
    kind = customers.schema["c_nationkey"].dataType
    changed = some.withColumn("c_nationkey", F.when(F.col("c_custkey") % 2 == 0, F.lit(0).cast(kind)))
    new = some.withColumns({"c_custkey": F.col("c_custkey") + 1_000_000_000, "c_nationkey": F.lit(None).cast(kind)})
    store.merge(changed.unionByName(new))
    return store.read().select("c_custkey", "c_name", F.coalesce("c_nationkey", F.lit(-1)).alias("nation"))
