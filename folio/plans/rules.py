"""Queries of the statement rules, page tests, matching of coordinates and names, and table shapes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from folio.functions import fuzzy
from folio.operators import coordinates, pages, statement_rules
from folio.plans.catalogue import money, query, read
from folio.sources import tables

LABELS = ["Unamortized bond premium", "Net Pension Liability", "Lease liability", "General Obligation Bonds (1)", "State loan payable", "Interfund loan", "Compensated absences*", "Scope"]


@query("""
WITH s AS (SELECT l_orderkey AS order_id, CAST(floor(sum(CAST(l_extendedprice AS DECIMAL(18,2)))) AS BIGINT) AS total FROM lineitem GROUP BY 1),
w AS (SELECT order_id, total, CASE WHEN order_id % 4 = 0 AND total > 99 THEN CAST(substr(total::VARCHAR, 1, 1) || substr(total::VARCHAR, 3) AS BIGINT) WHEN order_id % 4 = 1 THEN total // 3 ELSE total END AS v FROM s),
m AS (SELECT *, list_distinct(list_filter(flatten([[CAST(substr(v::VARCHAR, 1, p) || d || substr(v::VARCHAR, p + 1) AS BIGINT) FOR d IN range(0, 10)] FOR p IN range(0, length(v::VARCHAR) + 1)]), lambda x: abs(x - total) <= 1)) AS fits FROM w)
SELECT order_id, CAST(CASE WHEN v BETWEEN total * 0.8 AND total * 1.2 THEN v WHEN len(fits) = 1 THEN fits[1] ELSE v END AS BIGINT) AS amount, CASE WHEN v BETWEEN total * 0.8 AND total * 1.2 THEN 'ok' WHEN len(fits) = 1 THEN 'repaired' ELSE 'fail' END AS state FROM m
""")
def digit_drop_repair(spark, sf_dir):
    sums = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(F.floor(F.sum(money("l_extendedprice"))).cast("long").alias("total"))
    text, k = F.col("total").cast("string"), F.col("order_id") % 4
    written = F.when((k == 0) & (F.col("total") > 99), F.concat(F.substring(text, 1, 1), F.substring(text, 3, 40)).cast("long")).when(k == 1, F.floor(F.col("total") / 3)).otherwise(F.col("total"))
    found = statement_rules.digit_drop(written.cast("decimal(38,4)"), F.col("total").cast("decimal(38,4)"))
    return sums.select("order_id", found.alias("r")).select("order_id", F.col("r.value").cast("long").alias("amount"), "r.state")


@query("""
SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'Premium/ Discount' WHEN 1 THEN 'Pension-OPEB Liability' WHEN 2 THEN 'Lease Liability'
 WHEN 3 THEN CASE WHEN p_size = 1 + p_partkey % 50 THEN 'Short-term Debt' ELSE 'Long-term Debt' END WHEN 4 THEN 'State Loan'
 WHEN 5 THEN CASE WHEN p_size = 1 + p_partkey % 50 THEN 'Short-term Liability' ELSE 'Long-term Liability' END
 WHEN 6 THEN CASE WHEN p_size = 1 + p_partkey % 50 THEN 'Short-term Liability' ELSE 'Long-term Liability' END END AS kind FROM part
""")
def debt_class(spark, sf_dir):
    label = F.get(F.array(*[F.lit(x) for x in LABELS]), (F.col("p_partkey") % 8).cast("int"))
    return read(spark, sf_dir, "part").select("p_partkey", statement_rules.debt_class(label, F.col("p_size"), 1 + F.col("p_partkey") % 50).alias("kind"))


@query("""
WITH f AS (SELECT s_suppkey, s_nationkey, CASE WHEN s_suppkey % 7 <> 0 THEN s_suppkey % 90 END AS income, s_suppkey % 5 AS paid FROM supplier),
c AS (SELECT *, CASE WHEN paid + 40 <> 0 THEN (income + 10 + 5) / CAST(paid + 40 AS DOUBLE) END AS coverage FROM f)
SELECT s_suppkey, coverage, coalesce(bool_or(coverage < 1) OVER (PARTITION BY s_nationkey), false) AS low FROM c
""")
def debt_coverage(spark, sf_dir):
    k = F.col("s_suppkey")
    funds = read(spark, sf_dir, "supplier").select(k, "s_nationkey", F.when(k % 7 != 0, k % 90).alias("operating_income"), F.lit(10).alias("depreciation"), F.lit(5).alias("investment_income"), (k % 5).alias("principal"), F.lit(40).alias("interest"))
    return statement_rules.debt_coverage(funds, ["s_nationkey"]).select("s_suppkey", "coverage", "low")


@query("SELECT c_custkey, round((c_custkey % 9) / (c_custkey % 9 + 3.0) * 80 / (80 + c_custkey % 4), 9) AS governmental, round((c_custkey % 4) / (80.0 + c_custkey % 4), 9) AS units FROM customer")
def activity_shares(spark, sf_dir):
    k = F.col("c_custkey")
    shares = statement_rules.activity_shares(k % 9, F.lit(3), F.lit(80), k % 4)
    return read(spark, sf_dir, "customer").select("c_custkey", shares.alias("s")).select("c_custkey", F.round("s.governmental", 9).alias("governmental"), F.round("s.units", 9).alias("units"))


@query()
def column_shift_repair(spark, sf_dir):
    """Items of an order with their amount in one of two columns; in every third order the first item stands in the wrong one."""
    k, right = F.col("l_orderkey"), F.col("l_linenumber") % 2 == 0
    amt = F.round(money("l_extendedprice")).cast("decimal(38,4)")
    items = read(spark, sf_dir, "lineitem").select(k.alias("table_id"), F.lit("s").alias("section"), F.col("l_linenumber").cast("int").alias("row_order"), amt.alias("total"), right.alias("right"), ((k % 3 == 0) & (F.col("l_linenumber") == 1)).alias("wrong"))
    totals = items.groupBy("table_id", "section").agg(F.coalesce(F.sum(F.when(~F.col("right"), F.col("total"))), F.lit(0)).cast("decimal(38,4)").alias("a"), F.coalesce(F.sum(F.when(F.col("right"), F.col("total"))), F.lit(0)).cast("decimal(38,4)").alias("b"))
    in_b = F.col("right") != F.col("wrong")
    rows = items.select("table_id", "section", "row_order", F.lit("DP").alias("flag"), F.lit("item").alias("label"), F.when(~in_b, F.col("total")).alias("a"), F.when(in_b, F.col("total")).alias("b"), "total")
    rows = rows.unionByName(totals.select("table_id", "section", F.lit(1000).alias("row_order"), F.lit("CP").alias("flag"), F.lit("Total").alias("label"), "a", "b", (F.col("a") + F.col("b")).cast("decimal(38,4)").alias("total")))
    return statement_rules.repair_shifts(rows).select("table_id", "row_order", F.col("a").cast("double").alias("a"), F.col("b").cast("double").alias("b"), "moved")


@query()
def coordinate_match(spark, sf_dir):
    """Line items as cells, and as words of the same orders at other places."""
    by_order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    line = read(spark, sf_dir, "lineitem").withColumn("id", F.row_number().over(by_order))
    cells = line.select(F.col("l_orderkey").alias("doc_id"), F.col("id").alias("cell_id"), (F.col("l_linenumber") % 4).alias("col_index"), F.lit(4).alias("n_cols"), F.format_number(F.floor("l_quantity"), 0).alias("value"))
    words = line.select(F.col("l_orderkey").alias("doc_id"), F.lit(1).alias("page"), F.col("id").alias("word_id"), F.floor("l_quantity").cast("string").alias("text"), (F.col("l_partkey") % 612).cast("double").alias("x0"))
    return coordinates.attach(cells, words).select("doc_id", "cell_id", "page", "word_id")


@query()
def name_ratios(spark, sf_dir):
    parts = read(spark, sf_dir, "part")
    return parts.select("p_partkey", F.round(fuzzy.partial_ratio("p_type", "p_name"), 6).alias("partial"), F.round(fuzzy.token_set_ratio("p_type", "p_name"), 6).alias("token_set"))


@query("""
SELECT doc_id, (regexp_matches(t, '(?i)the') AND NOT regexp_matches(t, '(?i)licen[cs]e') AND len(regexp_extract_all(t, '[0-9]{2}')) >= 2) AS schedule, (regexp_matches(t, '(?i)total') OR regexp_matches(t, '(?i)note')) AS notes FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
""")
def page_flags(spark, sf_dir):
    tests = [pages.PageTest("schedule", every=("(?i)the",), none=("(?i)licen[cs]e",), least={"[0-9]{2}": 2}), pages.PageTest("notes", some=("(?i)total", "(?i)note"))]
    return pages.page_flags(read(spark, sf_dir, "documents").select("doc_id", "text"), "text", tests).select("doc_id", "schedule", "notes")


_TIER = "CASE event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 WHEN 'view' THEN 2 END"


@query(f"SELECT user_id, tier, event_id FROM (SELECT user_id, event_id, {_TIER} AS tier, row_number() OVER (PARTITION BY user_id ORDER BY {_TIER}, event_id) AS k FROM events WHERE {_TIER} IS NOT NULL) WHERE k = 1")
def evidence_tiers(spark, sf_dir):
    tier = F.expr(_TIER)
    return pages.best_hit(read(spark, sf_dir, "events"), ["user_id"], tier, ["event_id"], ["event_id"]).select("user_id", "tier", "event_id")


@query("""
WITH l AS (SELECT user_id, event_id, event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) > 40 AS far FROM (SELECT DISTINCT user_id, event_id FROM events)),
i AS (SELECT *, coalesce(sum(far::INT) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS island FROM l)
SELECT user_id, event_id FROM i WHERE island = 0
""")
def first_page_cluster(spark, sf_dir):
    return pages.first_cluster(read(spark, sf_dir, "events"), ["user_id"], "event_id", 40).select("user_id", "event_id")


@query("SELECT DISTINCT l_orderkey AS doc_id, l_returnflag AS statement, l_linenumber + 1 AS page FROM lineitem JOIN (SELECT o_orderkey, 1 + o_custkey % 6 AS n FROM orders) ON o_orderkey = l_orderkey WHERE l_linenumber + 1 BETWEEN 1 AND n")
def page_map_cleaned(spark, sf_dir):
    found = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_returnflag").alias("statement"), F.col("l_linenumber").alias("page"))
    return pages.clean_map(found, read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), (1 + F.col("o_custkey") % 6).alias("n_pages")), 1)


@query("SELECT doc_id, len(w) >= 8 AND len(list_filter(w, lambda x: length(x) = 1)) > len(w) * 0.2 AS shredded FROM (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM documents)")
def shredded_text(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", pages.shredded(F.col("text"), 0.2).alias("shredded"))


@query("SELECT r_name AS name, r_regionkey, NULL AS n_regionkey FROM region UNION ALL SELECT n_name, NULL, n_regionkey FROM nation")
def stacked_statements(spark, sf_dir):
    region = read(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("name"))
    return tables.stack([region, read(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), "n_regionkey")], ["name"])


@query("SELECT CAST(n_nationkey AS VARCHAR) || ' | ' || n_name AS line FROM nation")
def pipe_lines(spark, sf_dir):
    return tables.pipe_text(read(spark, sf_dir, "nation").select("n_nationkey", "n_name"))


@query("SELECT n_name AS nation, n_regionkey AS region, CAST(NULL AS VARCHAR) AS fiscal_year FROM nation")
def header_aliases(spark, sf_dir):
    return tables.by_alias(read(spark, sf_dir, "nation"), {"nation": ["nation name", "N NAME"], "region": ["regionkey"], "fiscal_year": ["fy"]})
