"""Queries of the ingest chain, filings and small set operations, over statements made from orders and lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.operators import filings, ingest, worklist
from folio.plans.catalogue import money, query, read

CODES = ["SNP", "SOA", "XYZ"]
_N = "row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)"


def statement_rows(spark, sf_dir) -> DataFrame:
    """Each customer is a deal, each order a file; every third line is a heading, amounts of every fifth part are blank."""
    line = read(spark, sf_dir, "lineitem").withColumn("n", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")))
    order = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("deal"))
    code = F.get(F.array(*[F.lit(c) for c in CODES]), (F.col("l_orderkey") % 3).cast("int"))
    return line.join(order, "l_orderkey").select(
        "deal", F.col("l_orderkey").alias("file"), code.alias("stmt_type"), F.concat(F.lit("S"), (F.col("n") / 4).cast("int").cast("string")).alias("section"), (F.col("n") / 4).cast("int").alias("section_pos"), F.col("n").alias("row_order"),
        F.when(F.col("n") % 3 == 0, "DPG").otherwise("DP").alias("flag"), F.concat(F.lit("P"), (F.col("l_partkey") % 20).cast("string")).alias("datapoint"), F.lit("amount").alias("col"), F.lit(0).alias("col_pos"),
        F.when(F.col("l_partkey") % 5 == 0, "-").otherwise(money("l_extendedprice").cast("string")).alias("raw"), F.lit(None).cast("string").alias("coord"))


def small_chart(spark) -> DataFrame:
    rows = spark.range(60).select(F.col("id").alias("coa_id"), (F.col("id") % 2).cast("int").alias("template"), F.concat(F.lit("P"), (F.col("id") % 15).cast("string")).alias("name"), F.concat(F.lit("P"), (F.col("id") % 7).cast("string")).alias("parent_name"), F.col("id").alias("seq"))
    return rows


def templates(spark) -> DataFrame:
    return spark.createDataFrame([("SNP", 0), ("SOA", 1)], "stmt_type string, template int")


_FACTS = f"""
WITH l AS (SELECT o_custkey AS deal, l_orderkey AS file, ['SNP', 'SOA', 'XYZ'][1 + l_orderkey % 3] AS code, n, 'S' || (n // 4) AS section, n % 3 = 0 AS head, 'P' || (l_partkey % 20) AS dp, CASE WHEN l_partkey % 5 > 0 THEN CAST(l_extendedprice AS DECIMAL(18,2))::VARCHAR END AS value
  FROM (SELECT *, {_N} AS n FROM lineitem) JOIN orders ON l_orderkey = o_orderkey),
p AS (SELECT *, last_value(CASE WHEN head THEN dp END IGNORE NULLS) OVER (PARTITION BY file ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS parent FROM l),
i AS (SELECT *, CASE code WHEN 'SNP' THEN 0 WHEN 'SOA' THEN 1 END AS tid FROM p WHERE NOT head AND value IS NOT NULL),
c AS (SELECT id AS coa_id, id % 2 AS tid, 'P' || (id % 15) AS name, 'P' || (id % 7) AS par FROM range(60) r(id)),
r AS (SELECT deal, file, code, n, section, value, i.tid, min(coa_id) FILTER (par = parent) AS a, count(coa_id) AS k, min(coa_id) AS lone FROM i LEFT JOIN c ON c.tid = i.tid AND c.name = i.dp GROUP BY ALL),
s AS (SELECT *, CASE WHEN a IS NOT NULL THEN a WHEN k = 1 THEN lone END AS coa_id, CASE WHEN a IS NOT NULL OR k = 1 THEN 'mapped' WHEN k > 1 THEN 'ambiguous' ELSE 'unmapped' END AS status FROM r),
f AS (SELECT *, row_number() OVER (PARTITION BY deal ORDER BY CASE code WHEN 'SNP' THEN 0 WHEN 'SOA' THEN 1 ELSE 99 END, file, n) AS disp_seq FROM s WHERE coa_id IS NOT NULL OR tid IS NOT NULL)
"""


@query(_FACTS + "SELECT deal, file, n AS row_order, coa_id, CASE WHEN coa_id IS NULL THEN tid END AS template_type, CASE WHEN coa_id IS NULL THEN section END AS group_name, value, disp_seq FROM f")
def ingest_facts(spark, sf_dir):
    stored = ingest.facts(statement_rows(spark, sf_dir), small_chart(spark), templates(spark))
    return stored.select("deal", "file", "row_order", "coa_id", "template_type", "group_name", "value", "disp_seq")


@query(_FACTS + "SELECT l.deal, count(DISTINCT l.file) AS files, coalesce(max(cells), 0) AS cells, coalesce(max(mapped), 0) AS mapped, coalesce(max(ambiguous), 0) AS ambiguous, coalesce(max(unmapped), 0) AS unmapped FROM l LEFT JOIN (SELECT deal, count(*) AS cells, count(*) FILTER (status = 'mapped') AS mapped, count(*) FILTER (status = 'ambiguous') AS ambiguous, count(*) FILTER (status = 'unmapped') AS unmapped FROM f GROUP BY 1) x ON l.deal = x.deal GROUP BY 1")
def ingest_counts(spark, sf_dir):
    rows = statement_rows(spark, sf_dir)
    return ingest.ingest_counts(ingest.facts(rows, small_chart(spark), templates(spark)), rows)


@query("""
WITH raw AS (SELECT o_orderkey AS DataId, o_custkey AS pid, o_orderstatus AS name FROM orders WHERE o_custkey % 4 <> 0), new AS (SELECT o_custkey AS pid, o_orderpriority AS name FROM orders WHERE o_custkey % 3 = 0),
kept AS (SELECT pid, count(*) AS n FROM raw WHERE pid % 6 <> 0 GROUP BY 1), came AS (SELECT pid, count(*) AS n, count(DISTINCT name) AS names FROM new GROUP BY 1)
SELECT coalesce(k.pid, c.pid) AS pid, CAST(coalesce(k.n, 0) + coalesce(c.n, 0) AS BIGINT) AS n, coalesce(c.names, 0) AS n_names, c.n IS NOT NULL AND coalesce(c.n, 0) > 0 AS fresh FROM kept k FULL JOIN came c ON k.pid = c.pid
""")
def flush_store(spark, sf_dir):
    """A flush in which every second deal comes for the first time, so that its old rows go; new names and rows get ids of their own."""
    orders = read(spark, sf_dir, "orders")
    raw = orders.where("o_custkey % 4 <> 0").select(F.col("o_orderkey").alias("DataId"), F.col("o_custkey").alias("ProcessingId"))
    pending = orders.where("o_custkey % 3 = 0").select(F.col("o_custkey").alias("ProcessingId"), F.col("o_orderpriority").alias("category"), F.col("o_orderkey").alias("disp_seq"))
    first = orders.where("o_custkey % 6 = 0").select(F.col("o_custkey").alias("ProcessingId"))
    dim = spark.createDataFrame([(4, "1-URGENT")], "id long, name string")
    out, _ = ingest.next_version(raw, {"category": dim}, pending, first)
    top = raw.agg(F.max("DataId").alias("top"))
    out = out.join(F.broadcast(top))
    return out.groupBy(F.col("ProcessingId").alias("pid")).agg(F.count("*").alias("n"), F.count_distinct("category_id").alias("n_names"), F.bool_or(F.col("DataId") > F.col("top")).alias("fresh"))


@query("""
WITH w AS (SELECT c_custkey AS row_id, c_nationkey AS uei, CASE WHEN c_custkey % 2 = 0 THEN 'TX' ELSE 'CA' END AS state, 1995 AS low, 1995 + c_custkey % 4 AS high FROM customer),
f AS (SELECT s_nationkey AS uei, ['CA', 'NY', 'TX'][1 + s_suppkey % 3] AS own, 1992 + s_suppkey % 7 AS year, s_suppkey AS report FROM supplier),
j AS (SELECT row_id, year, report, own, row_number() OVER (PARTITION BY row_id ORDER BY own <> state, CASE WHEN own <> state THEN own ELSE '' END, year DESC, report) AS k FROM w JOIN f ON w.uei = f.uei WHERE year BETWEEN low AND high)
SELECT w.row_id, year, report, own AS found_state FROM w LEFT JOIN j ON w.row_id = j.row_id AND k = 1
""")
def newest_filing(spark, sf_dir):
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    wanted = read(spark, sf_dir, "customer").select(k.alias("row_id"), F.col("c_nationkey").alias("uei"), F.when(k % 2 == 0, "TX").otherwise("CA").alias("state"), F.lit(1995).alias("low"), (1995 + k % 4).alias("high"))
    there = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("uei"), F.get(F.array(F.lit("CA"), F.lit("NY"), F.lit("TX")), (s % 3).cast("int")).alias("state"), (1992 + s % 7).alias("year"), s.alias("report"))
    return filings.newest_filing(wanted, there).select("row_id", "year", "report", "found_state")


@query("""
WITH c AS (SELECT o_orderkey AS row_id, o_custkey % 7 AS u, o_custkey % 5 AS y FROM orders),
f AS (SELECT l_orderkey AS row_id, n AS r, l_partkey % 7 AS u, l_suppkey % 5 AS y, l_partkey % 3 AS e, CASE WHEN l_partkey % 4 > 0 THEN l_suppkey % 28 END AS d, l_partkey % 11 > 0 AS known FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) + 1 AS n FROM lineitem)),
p AS (SELECT c.row_id, r, (CASE WHEN f.u = c.u AND known THEN 50 ELSE 0 END) + (CASE WHEN f.y = c.y THEN 20 ELSE 0 END) + 10 + (CASE e WHEN 0 THEN 8 WHEN 1 THEN 5 ELSE 0 END) AS score, d FROM c JOIN f ON c.row_id = f.row_id WHERE known OR f.u = 0),
b AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, d IS NOT NULL DESC, d DESC, r) AS k FROM p)
SELECT c.row_id, CAST(coalesce(r, 2) AS INT) AS "row", CAST(score AS INT) AS score FROM c LEFT JOIN b ON c.row_id = b.row_id AND k = 1
""")
def reliant_filing(spark, sf_dir):
    """Each order's lines are the sheet of its filings."""
    text = lambda c: c.cast("string")
    criteria = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_orderkey").alias("sheet"), F.concat(F.lit("U "), text(F.col("o_custkey") % 7)).alias("uei"), text(2020 + F.col("o_custkey") % 5).alias("year"), F.lit("Texas").alias("state"), F.lit("Local Government").alias("entity"))
    line = read(spark, sf_dir, "lineitem").withColumn("n", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")) + 1)
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    entity = F.get(F.array(F.lit(" local government "), F.lit("Government"), F.lit("State")), (p % 3).cast("int"))
    there = line.select(F.col("l_orderkey").alias("sheet"), F.col("n").alias("row"), F.when((p % 11 == 0) & (p % 7 == 0), "R").alias("report"), F.when(p % 11 > 0, F.concat(F.lit("U"), text(p % 7))).alias("uei"), text(2020 + s % 5).alias("year"), F.lit("TX").alias("state"), entity.alias("entity"), F.when(p % 4 > 0, F.date_add(F.lit("2024-01-01").cast("date"), (s % 28).cast("int"))).alias("submitted"))
    return filings.best_reliant(criteria, there)


@query("""
WITH s AS (SELECT c_custkey AS sub, c_custkey % 25 AS cc, c_nationkey AS company, 2020 + c_custkey % 3 AS y FROM customer)
SELECT DISTINCT n_regionkey AS COAID, company AS CompanyId, y AS ProcessYear, t AS FileTypeId FROM s JOIN nation ON cc = n_nationkey, unnest([1, 2]) u(t) WHERE n_regionkey < 4 AND (n_regionkey % 2 = 0 OR t = 1)
""")
def work_materialized(spark, sf_dir):
    k, r = F.col("c_custkey"), F.col("COAID")
    subscriptions = read(spark, sf_dir, "customer").select((k % 25).alias("ClientCOAMappingId"), F.col("c_nationkey").alias("CompanyId"), (2020 + k % 3).alias("ProcessYear"))
    client = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("ClientCOAMappingId"), F.col("n_regionkey").alias("COAID"))
    charts = read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("COAID")).where("COAID < 4").withColumn("SegmentId", r % 2)
    types = spark.createDataFrame([(0, 1), (0, 2), (1, 1)], "SegmentId int, FileTypeId int")
    return worklist.materialize(subscriptions, client, charts, types.select("SegmentId").distinct(), types)


@query("SELECT user_id, (SELECT list(event_type ORDER BY first) FROM (SELECT event_type, min(event_id) AS first FROM events e WHERE e.user_id = u.user_id GROUP BY 1))::VARCHAR AS kinds FROM (SELECT DISTINCT user_id FROM events) u")
def first_seen_kinds(spark, sf_dir):
    seen = ingest.first_seen(read(spark, sf_dir, "events"), ["user_id"], "event_type", "event_id")
    return seen.select("user_id", F.concat(F.lit("["), F.array_join("values", ", "), F.lit("]")).alias("kinds"))


@query("SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 15")
def most_common_suppliers(spark, sf_dir):
    return ingest.most_common(read(spark, sf_dir, "lineitem"), "l_suppkey")


@query("""
WITH w AS (SELECT o_orderkey AS Id, o_orderkey % 3 = 0 AS hit, o_orderkey % 4 AS e, o_orderkey % 5 AS d FROM orders)
SELECT Id, CAST(CASE WHEN e = 1 AND d = 1 THEN 1 WHEN hit THEN NULL ELSE 7 END AS INT) AS done FROM w
""")
def reset_and_complete(spark, sf_dir):
    """Every third row is set back; then rows with both stages done are completed."""
    k = F.col("o_orderkey")
    none = lambda t: F.lit(None).cast(t)
    work = read(spark, sf_dir, "orders").select(k.alias("Id"), F.lit(1).alias("IsActive"), F.lit(7).alias("CompletionStatus"), *[none(t).alias(c) for c, t in (("ExtractionStatus", "int"), ("ExtractionFlag", "string"), ("DataValidationStatus", "int"), ("DataValidationFlag", "string"), ("OutputPath", "string"), ("Remarks", "string"), ("ModifiedOn", "timestamp"))])
    back = worklist.reset(work, work.where("Id % 3 = 0"))
    staged = back.withColumns({"ExtractionStatus": (F.col("Id") % 4).cast("int"), "DataValidationStatus": (F.col("Id") % 5).cast("int")})
    return worklist.completed(staged).select("Id", F.col("CompletionStatus").alias("done"))
