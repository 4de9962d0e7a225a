"""The registered queries of the library's operators over the driver's tables, and SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.functions import amounts, text
from folio.operators import coa, gates, matching, nested, total_check, upsert, worklist
from folio.streaming import logs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: str):
    return F.col(c).cast("decimal(18,2)")


def order_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as statements: lines are items; the total is their rounded sum, off by a small amount that hangs on the key."""
    items = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("table_id"), F.col("l_returnflag").alias("label"), money("l_extendedprice").cast("decimal(38,4)").alias("amt"))
    off = F.get(F.array(*[F.lit(x) for x in (0, 0, 0, 1, 2, -3, 0)]), (F.col("table_id") % 7).cast("int"))
    totals = items.groupBy("table_id").agg((F.round(F.sum("amt")) + F.first(off)).cast("decimal(38,4)").alias("amt"))
    rows = items.select("table_id", F.lit(0).alias("row_order"), F.lit("DP").alias("flag"), "label", "amt")
    rows = rows.unionByName(totals.select("table_id", F.lit(1).alias("row_order"), F.lit("CP").alias("flag"), F.lit("Total").alias("label"), "amt"))
    return rows.select("table_id", F.lit("Lines").alias("section"), "row_order", "flag", "label", F.lit("Total Lines").alias("datapoint"), F.lit("amount").alias("col"), "amt")


_CHECK = """
WITH s AS (SELECT l_orderkey AS table_id, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS computed FROM lineitem GROUP BY 1),
c AS (SELECT table_id, computed, round(computed) + [0,0,0,1,2,-3,0][1 + table_id % 7] AS reported FROM s),
v AS (SELECT table_id, CAST(computed AS DOUBLE) AS computed, CAST(reported AS DOUBLE) AS reported, CASE WHEN abs(computed - reported) <= 1 THEN 'PASS' ELSE 'amount: FAIL' END AS status FROM c)
"""


@query(_CHECK + "SELECT * FROM v")
def total_check_section(spark, sf_dir):
    checked = total_check.section_check(order_statements(spark, sf_dir))
    status = F.when(F.col("passed"), "PASS").otherwise(F.concat("col", F.lit(": FAIL")))
    return checked.select("table_id", F.col("computed").cast("double").alias("computed"), F.col("reported").cast("double").alias("reported"), status.alias("status"))


@query(_CHECK + "SELECT o_orderstatus, count(*) AS n_total, count(*) FILTER (status = 'PASS') AS n_pass, count(*) FILTER (status LIKE '%FAIL%') AS n_fail, CAST(0 AS BIGINT) AS n_skipped, CAST(0 AS BIGINT) AS n_blank FROM v JOIN orders ON table_id = o_orderkey GROUP BY 1")
def total_check_summary(spark, sf_dir):
    statuses = total_check.status_text(total_check.section_check(order_statements(spark, sf_dir)))
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("table_id"), "o_orderstatus")
    return total_check.summary(statuses.join(orders, "table_id"), ["o_orderstatus"])


@query("""
WITH s AS (SELECT l_orderkey AS table_id, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS whole, sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (lower(l_returnflag) NOT LIKE '%r%') AS part FROM lineitem GROUP BY 1),
c AS (SELECT table_id, whole, coalesce(part, 0) AS part, round(whole) + [0,0,0,1,2,-3,0][1 + table_id % 7] AS reported FROM s)
SELECT table_id, CAST(CASE WHEN abs(whole - reported) <= 1 AND abs(part - reported) > 1 THEN whole ELSE part END AS DOUBLE) AS computed, (abs(whole - reported) <= 1 OR abs(part - reported) <= 1) AS passed FROM c
""")
def total_check_excludes(spark, sf_dir):
    return total_check.section_check(order_statements(spark, sf_dir), exclude=["r"]).select("table_id", F.col("computed").cast("double").alias("computed"), "passed")


@query("""
SELECT l_orderkey AS table_id, l_returnflag AS label, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS computed FROM lineitem WHERE l_returnflag IN ('A', 'N') GROUP BY ALL
""")
def item_label_sums(spark, sf_dir):
    sums = total_check.item_sums(order_statements(spark, sf_dir), include=["a", "n", "r"], exclude_start=["r"], by=["table_id", "label"])
    return sums.select("table_id", "label", F.col("computed").cast("double").alias("computed"))


def event_rows(spark, sf_dir) -> DataFrame:
    """Events as a statement per user, ordered by id; purchases are totals."""
    flag = F.when(F.col("event_type") == "purchase", "CP").otherwise("DP")
    return read(spark, sf_dir, "events").select(F.col("user_id").alias("table_id"), F.lit("all").alias("section"), F.col("event_id").alias("row_order"), flag.alias("flag"), F.lit("value").alias("col"), F.round("value").cast("decimal(38,4)").alias("amt"))


_EVENTS = """
WITH e AS (SELECT user_id, event_id, event_type = 'purchase' AS cp, CAST(round(value) AS DECIMAL(18,4)) AS amt FROM events),
b AS (SELECT *, coalesce(sum(cp::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS block FROM e),
s AS (SELECT user_id, block, coalesce(sum(amt) FILTER (NOT cp), 0) AS since FROM b GROUP BY ALL),
t AS (SELECT b.user_id AS table_id, event_id AS row_order, amt AS reported, since, lag(amt) OVER (PARTITION BY b.user_id ORDER BY event_id) AS before FROM b JOIN s ON b.user_id = s.user_id AND b.block = s.block WHERE cp)
"""


@query(_EVENTS + "SELECT table_id, row_order, CAST(since AS DOUBLE) AS since, abs(since - reported) <= 1 AS passed FROM t")
def positional_window_sum(spark, sf_dir):
    return total_check.positional_check(event_rows(spark, sf_dir), rolling=False).select("table_id", "row_order", F.col("since").cast("double").alias("since"), "passed")


@query(_EVENTS + "SELECT table_id, row_order, CAST(before AS DOUBLE) AS before, abs(since - reported) <= 1 OR coalesce(abs(since + before - reported) <= 1, false) AS passed FROM t")
def rolling_subtotal(spark, sf_dir):
    return total_check.positional_check(event_rows(spark, sf_dir)).select("table_id", "row_order", F.col("before").cast("double").alias("before"), "passed")


@query("""
WITH s AS (SELECT l_orderkey AS table_id, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS gross, sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2))) AS net FROM lineitem GROUP BY 1),
c AS (SELECT table_id, round(CASE WHEN table_id % 3 = 0 THEN net ELSE gross END) + [0,0,0,1,2,-3,0][1 + table_id % 7] AS reported, gross, net FROM s)
SELECT table_id, CASE WHEN abs(gross - reported) <= 1 THEN 0 WHEN abs(net - reported) <= 1 THEN 1 ELSE 0 END AS chain, CASE WHEN abs(gross - reported) <= 1 OR abs(net - reported) <= 1 THEN 'PASS' ELSE 'amount: FAIL' END AS status FROM c
""")
def first_present_chain(spark, sf_dir):
    price, net = money("l_extendedprice"), (money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,2)")
    sums = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("table_id")).agg(F.sum(price).alias("gross"), F.sum(net).alias("net"))
    off = F.get(F.array(*[F.lit(x) for x in (0, 0, 0, 1, 2, -3, 0)]), (F.col("table_id") % 7).cast("int"))
    reported = F.round(F.when(F.col("table_id") % 3 == 0, F.col("net")).otherwise(F.col("gross"))) + off
    formulas = sums.select("table_id", F.lit("amount").alias("col"), reported.alias("reported"), F.posexplode(F.array("gross", "net")).alias("chain", "computed"))
    return total_check.first_present(formulas).select("table_id", "chain", "status")


@query("SELECT l_orderkey AS table_id, CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_returnflag = 'A'), 0) - coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_returnflag = 'R'), 0) AS DOUBLE) AS difference FROM lineitem GROUP BY 1")
def cp_subtract(spark, sf_dir):
    part = lambda f: F.coalesce(F.sum(F.when(F.col("label") == f, F.col("amt"))), F.lit(0))
    return order_statements(spark, sf_dir).where("flag = 'DP'").groupBy("table_id").agg((part("A") - part("R")).cast("double").alias("difference"))


def written(spark, sf_dir) -> DataFrame:
    """Balances written in several ways."""
    k, b = F.col("c_custkey") % 8, F.format_number(F.abs("c_acctbal"), 2)
    raw = F.when(k == 0, F.concat(F.lit("("), b, F.lit(")"))).when(k == 1, F.lit("-")).when(k == 2, F.concat(F.lit("$"), b)).when(k == 3, F.lit(None)).when(k == 4, F.lit("null")).when(k == 5, F.concat(F.lit("-"), b)).when(k == 6, F.lit("###")).otherwise(b)
    return read(spark, sf_dir, "customer").select("c_custkey", raw.alias("raw"))


_B = "CAST(CAST(abs(c_acctbal) AS DECIMAL(18,2)) AS DOUBLE)"


def _parsed(two, three, dash, other):
    return f"SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN -{_B} WHEN 1 THEN {dash} WHEN 2 THEN {two} WHEN 3 THEN {three} WHEN 4 THEN {other} WHEN 5 THEN -{_B} WHEN 6 THEN {other} ELSE {_B} END AS amt FROM customer"


@query(_parsed("0.0", "0.0", "0.0", "0.0"))
def val_amount(spark, sf_dir):
    return written(spark, sf_dir).select("c_custkey", (amounts.val_amount(F.col("raw")).cast("double") + 0.0).alias("amt"))


@query(_parsed(_B, "0.0", "0.0", "0.0"))
def parse_amount(spark, sf_dir):
    return written(spark, sf_dir).select("c_custkey", amounts.parse_amount(F.col("raw")).cast("double").alias("amt"))


@query(_parsed(_B, "NULL", "NULL", "NULL"))
def to_dec(spark, sf_dir):
    return written(spark, sf_dir).select("c_custkey", amounts.to_dec(F.col("raw")).cast("double").alias("amt"))


@query("SELECT count(*) AS n, count(*) FILTER (c_custkey % 8 IN (1, 3, 6)) AS n_empty FROM customer")
def empty_cells(spark, sf_dir):
    return written(spark, sf_dir).agg(F.count("*").alias("n"), F.count_if(amounts.is_empty(F.col("raw"))).alias("n_empty"))


def chart(spark, sf_dir) -> DataFrame:
    part = read(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("coa_id"), (F.col("p_size") % 5).alias("template"), F.col("p_type").alias("name"), F.col("p_brand").alias("parent_name"), F.col("p_partkey").alias("seq"))


@query("""
WITH ch AS (SELECT p_partkey AS id, p_size % 5 AS tid, p_type AS name, p_brand AS par FROM part),
it AS (SELECT p_partkey, p_size % 7 AS tid, CASE WHEN p_partkey % 4 = 1 THEN p_type ELSE upper(p_type) END AS dp, CASE WHEN p_partkey % 3 = 0 THEN lower(p_brand) WHEN p_partkey % 3 = 1 THEN p_brand ELSE 'none' END AS par, p_brand AS sec FROM part),
r AS (SELECT it.*,
  (SELECT min(id) FROM ch WHERE ch.tid = it.tid AND ch.name = it.dp AND ch.par = it.par) AS a,
  (SELECT min(id) FROM ch WHERE ch.tid = it.tid AND lower(ch.name) = lower(it.dp) AND lower(ch.par) = lower(it.par)) AS b,
  (SELECT min(id) FROM ch WHERE ch.tid = it.tid AND ch.name = it.dp AND ch.par = it.sec) AS c,
  (SELECT min(id) FROM ch WHERE ch.tid = it.tid AND lower(ch.name) = lower(it.dp) AND lower(ch.par) = lower(it.sec)) AS d,
  (SELECT CASE WHEN count(*) = 1 THEN min(id) END FROM ch WHERE ch.tid = it.tid AND ch.name = it.dp) AS e,
  (SELECT CASE WHEN count(*) = 1 THEN min(id) END FROM ch WHERE ch.tid = it.tid AND lower(ch.name) = lower(it.dp)) AS f,
  (SELECT count(*) FROM ch WHERE ch.tid = it.tid AND lower(ch.name) = lower(it.dp)) AS n FROM it)
SELECT p_partkey, coalesce(a, b, c, d, e, f) AS coa_id, CASE WHEN coalesce(a, b, c, d, e, f) IS NOT NULL THEN 'mapped' WHEN n > 0 THEN 'ambiguous' ELSE 'unmapped' END AS status FROM r
""")
def coa_resolve(spark, sf_dir):
    k = F.col("p_partkey")
    items = read(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 7).alias("template"), F.when(k % 4 == 1, F.col("p_type")).otherwise(F.upper("p_type")).alias("datapoint"), F.when(k % 3 == 0, F.lower("p_brand")).when(k % 3 == 1, F.col("p_brand")).otherwise("none").alias("parent"), F.col("p_brand").alias("section"))
    return coa.resolve(items, chart(spark, sf_dir)).select("p_partkey", "coa_id", "status")


_NAME = "p_type || CASE WHEN p_partkey % 3 > 0 THEN ' ' || p_partkey % 7 ELSE '' END"


@query(f"""
WITH ch AS (SELECT p_partkey AS id, p_size % 5 AS tid, {_NAME} AS name, p_brand AS par FROM part),
it AS (SELECT p_partkey, p_size % 7 AS tid, CASE WHEN p_partkey % 4 = 1 THEN {_NAME} ELSE upper({_NAME}) END AS dp, CASE WHEN p_partkey % 3 = 0 THEN lower(p_brand) WHEN p_partkey % 3 = 1 THEN p_brand ELSE 'none' END AS par, CASE WHEN p_partkey % 5 > 0 THEN p_brand ELSE 'none' END AS sec FROM part),
j AS (SELECT it.*, id, ch.name, ch.par AS cpar FROM it LEFT JOIN ch ON ch.tid = it.tid AND lower(ch.name) = lower(it.dp)),
r AS (SELECT p_partkey, min(id) FILTER (name = dp AND cpar = par) AS a, min(id) FILTER (lower(cpar) = lower(par)) AS b, min(id) FILTER (name = dp AND cpar = sec) AS c, min(id) FILTER (lower(cpar) = lower(sec)) AS d,
  CASE WHEN count(id) FILTER (name = dp) = 1 THEN min(id) FILTER (name = dp) END AS e, CASE WHEN count(id) = 1 THEN min(id) END AS f, count(id) AS n FROM j GROUP BY 1)
SELECT p_partkey, coalesce(a, b, c, d, e, f) AS coa_id, CASE WHEN coalesce(a, b, c, d, e, f) IS NOT NULL THEN 'mapped' WHEN n > 0 THEN 'ambiguous' ELSE 'unmapped' END AS status FROM r
""")
def coa_resolve_all(spark, sf_dir):
    """All of part as chart and as items; names that hang on the key make ambiguous and unmapped items."""
    k, part = F.col("p_partkey"), read(spark, sf_dir, "part")
    name = F.concat_ws(" ", "p_type", F.when(k % 3 > 0, k % 7))
    every = part.select(k.alias("coa_id"), (F.col("p_size") % 5).alias("template"), name.alias("name"), F.col("p_brand").alias("parent_name"), k.alias("seq"))
    items = part.select("p_partkey", (F.col("p_size") % 7).alias("template"), F.when(k % 4 == 1, name).otherwise(F.upper(name)).alias("datapoint"), F.when(k % 3 == 0, F.lower("p_brand")).when(k % 3 == 1, F.col("p_brand")).otherwise("none").alias("parent"), F.when(k % 5 > 0, F.col("p_brand")).otherwise("none").alias("section"))
    return coa.resolve(items, every).select("p_partkey", "coa_id", "status")


@query("""
WITH m AS (SELECT p_partkey AS seq, unnest(CASE WHEN p_size % 2 = 0 THEN [p_brand, 'All'] ELSE [p_brand] END) AS template, CASE WHEN p_partkey % 6 = 0 THEN 'DPG' ELSE 'DP' END AS flag FROM part),
n AS (SELECT *, row_number() OVER (PARTITION BY template ORDER BY seq) AS display_seq FROM m)
SELECT template, CAST(display_seq AS INT) AS display_seq, flag, CAST(CASE WHEN flag = 'DPG' THEN -1 ELSE coalesce(max(CASE WHEN flag = 'DPG' THEN display_seq END) OVER (PARTITION BY template ORDER BY seq), -1) END AS INT) AS parent_seq FROM n
""")
def coa_explode_parent(spark, sf_dir):
    master = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("seq"), F.when(F.col("p_size") % 2 == 0, F.concat("p_brand", F.lit(" | All"))).otherwise(F.col("p_brand")).alias("statement"), F.when(F.col("p_partkey") % 6 == 0, " dpg ").otherwise("DP").alias("flag"), F.col("p_name").alias("datapoint"))
    return coa.build_tree(master).select("template", "display_seq", "flag", "parent_seq")


@query("SELECT CASE WHEN event_type IN ('click', 'view') THEN CASE event_type WHEN 'click' THEN 7 ELSE 9 END ELSE 9 + row_number() OVER (PARTITION BY event_type IN ('click', 'view') ORDER BY event_type) END AS id, event_type AS name FROM (SELECT DISTINCT event_type FROM events) ")
def surrogate_get_or_create(spark, sf_dir):
    dim = spark.createDataFrame([(7, "click"), (9, "view")], "id long, name string")
    return upsert.get_or_create(dim, read(spark, sf_dir, "events").select(F.col("event_type").alias("name")), "id", "name")


@query("""
SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, CASE WHEN n.c_custkey IS NOT NULL THEN n.c_mktsegment ELSE o.c_mktsegment END AS c_mktsegment, coalesce(n.c_nationkey, o.c_nationkey) AS c_nationkey
FROM (SELECT * FROM customer WHERE c_custkey % 3 <> 0) o FULL JOIN (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'NEW' END AS c_mktsegment, CASE WHEN c_custkey % 10 = 0 THEN 99 END AS c_nationkey FROM customer WHERE c_custkey % 2 = 0) n ON o.c_custkey = n.c_custkey
""")
def upsert_partial(spark, sf_dir):
    customer, k = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey"), F.col("c_custkey")
    new = customer.where(k % 2 == 0).select("c_custkey", F.when(k % 4 == 0, F.lit(None)).otherwise("NEW").alias("c_mktsegment"), F.when(k % 10 == 0, 99).alias("c_nationkey"))
    return upsert.upsert(customer.where(k % 3 != 0), new, "c_custkey", {"c_mktsegment": F.lit(True)})


@query("SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders WHERE o_custkey % 5 <> 0 OR o_orderkey % 2 = 0 GROUP BY 1")
def idempotent_replace(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    new = orders.where("o_custkey % 5 = 0 and o_orderkey % 2 = 0")
    out = upsert.replace_groups(orders, new, orders.where("o_custkey % 5 = 0"), "o_custkey")
    out = upsert.replace_groups(out, new, orders.where("o_custkey % 5 = 0"), "o_custkey")
    return out.groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum(money("o_totalprice")).cast("double").alias("total"))


@query("""
SELECT row_id, score, s_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, s_acctbal DESC, s_suppkey DESC) AS k FROM (
  SELECT c_custkey AS row_id, 50 + CASE WHEN c_custkey % 10 = s_suppkey % 10 THEN 20 ELSE 0 END + CASE WHEN s_acctbal > c_acctbal THEN 10 ELSE 0 END AS score, s_suppkey, s_acctbal FROM customer JOIN supplier ON c_nationkey = s_nationkey)) WHERE k = 1
""")
def best_scored_match(spark, sf_dir):
    wanted = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row_id"), F.col("c_nationkey").alias("nation"), "c_acctbal")
    there = read(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), "s_acctbal")
    score = 50 + F.when(F.col("row_id") % 10 == F.col("s_suppkey") % 10, 20).otherwise(0) + F.when(F.col("s_acctbal") > F.col("c_acctbal"), 10).otherwise(0)
    return matching.best_scored(wanted, there, "nation", score, [F.col("s_acctbal"), F.col("s_suppkey")], ["s_suppkey"], equal=[(F.col("row_id") % 10, F.col("s_suppkey") % 10)])


@query("""
SELECT c_custkey AS row_id, max(o_orderkey) FILTER (o_orderdate = last) AS o_orderkey FROM (
  SELECT c_custkey, o_orderkey, o_orderdate, max(o_orderdate) OVER (PARTITION BY c_custkey) AS last FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-12-31') ON c_custkey = o_custkey) GROUP BY 1
""")
def newest_within_range(spark, sf_dir):
    customer = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row_id"), F.col("c_custkey").alias("o_custkey"))
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    low, high = F.lit("1995-01-01").cast("timestamp_ntz"), F.lit("1996-12-31").cast("timestamp_ntz")
    return matching.newest_within(customer, orders, ["o_custkey"], "o_orderdate", low, high, "o_orderkey").select("row_id", "o_orderkey")


def work_list(spark, sf_dir) -> DataFrame:
    """Orders as a work list, with all stages' statuses made from the key."""
    k = F.col("o_orderkey")
    three = lambda n: F.when((k / n).cast("long") % 3 == 0, F.lit(None)).when((k / n).cast("long") % 3 == 1, 1).otherwise(0).cast("int")
    flag = lambda n: F.when((k / n).cast("long") % 4 == 0, F.lit(None)).when((k / n).cast("long") % 4 == 1, "p").otherwise("c")
    return read(spark, sf_dir, "orders").select(k.alias("Id"), F.col("o_custkey").alias("CompanyId"), three(1).alias("SourcingStatus"), flag(2).alias("SourcingFlag"), three(5).alias("SourcingValidationStatus"), flag(3).alias("SourcingValidationFlag"), three(7).alias("ExtractionStatus"), flag(11).alias("ExtractionFlag"), F.when(k % 5 == 0, 1).alias("CompletionStatus"), (k % 6 % 4).cast("int").alias("COAID"), F.when(k % 13 != 0, 1).otherwise(0).alias("IsActive"))


def _t(n):
    return f"CASE (o_orderkey // {n}) % 3 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE 0 END"


def _f(n):
    return f"CASE (o_orderkey // {n}) % 4 WHEN 0 THEN NULL WHEN 1 THEN 'p' ELSE 'c' END"


@query(f"""
WITH w AS (SELECT o_orderkey AS Id, o_custkey, {_t(1)} AS a, {_f(2)} AS af, {_t(5)} AS b, {_f(3)} AS bf, {_t(7)} AS c, {_f(11)} AS cf, CASE WHEN o_orderkey % 5 = 0 THEN 1 END AS done FROM orders)
SELECT Id, c_name, n_name FROM w JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
WHERE a = 1 AND af = 'c' AND b = 1 AND bf = 'c' AND (cf IS NULL OR cf = 'c') AND (c IS NULL OR c = 0) AND (done IS NULL OR done = 0) AND Id % 13 <> 0 AND Id % 6 % 4 IN (1, 2) AND c_custkey % 11 <> 0
""")
def pending_worklist(spark, sf_dir):
    company = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("CompanyId"), "c_name", "c_nationkey", F.when(F.col("c_custkey") % 11 != 0, 1).otherwise(0).alias("IsActive"))
    nation = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return worklist.pending(work_list(spark, sf_dir), "Extraction", company).join(company.drop("IsActive"), "CompanyId").join(nation, "c_nationkey", "left").select("Id", "c_name", "n_name")


@query(f"SELECT CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE {_t(7)} END AS ExtractionStatus, CASE WHEN o_orderkey % 9 = 0 THEN 'c' ELSE {_f(11)} END AS ExtractionFlag, count(*) AS n FROM orders GROUP BY ALL")
def status_machine(spark, sf_dir):
    work = work_list(spark, sf_dir)
    return worklist.advance(work, work.where("Id % 9 = 0"), "Extraction", 1, "c").groupBy("ExtractionStatus", "ExtractionFlag").agg(F.count("*").alias("n"))


def event_log(spark, sf_dir) -> DataFrame:
    """Events as display log rows that arrive in the order of their ids."""
    k = F.col("event_id")
    return read(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("Id"), (k % 3).alias("ProcessingId"), F.col("event_type").alias("Stage"), F.when(k % 2 == 0, "even").alias("SubStage"), F.col("ts").alias("Time"), F.col("props").alias("Message"))


@query("""
WITH l AS (SELECT event_id, user_id, event_id % 3 AS pid, event_type, CASE WHEN event_id % 2 = 0 THEN 'even' END AS sub, ts FROM events)
SELECT event_id, min(ts) OVER g AS started, CAST(row_number() OVER (g ORDER BY event_id) AS INT) AS seq FROM l WINDOW g AS (PARTITION BY user_id, pid, event_type, sub)
""")
def display_log_order(spark, sf_dir):
    return logs.display_order(logs.with_seq(event_log(spark, sf_dir), "event_id")).select("event_id", "started", F.col("Seq").alias("seq"))


@query("SELECT event_id, CAST(user_id AS BIGINT) AS Id FROM events WHERE user_id = 7 AND event_id % 3 = 1 AND regexp_matches(event_type, '(?i)VIEW|ick')")
def log_read_and_search(spark, sf_dir):
    found = logs.search(logs.read_for(event_log(spark, sf_dir), 7, 1), "VIEW|ick", "Stage", "SubStage")
    return found.select("event_id", F.col("Id").cast("long").alias("Id"))


@query("""
WITH l AS (SELECT event_id, user_id, event_type, CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id % 4 END AS pid FROM events),
g AS (SELECT DISTINCT user_id, event_type, pid FROM l WHERE event_id % 50 = 1)
SELECT event_id FROM l WHERE NOT EXISTS (SELECT 1 FROM g WHERE l.user_id = g.user_id AND l.event_type = g.event_type AND (l.pid IS NULL OR l.pid IS NOT DISTINCT FROM g.pid))
UNION ALL SELECT -event_id FROM l WHERE event_id % 50 = 1
""")
def group_replace_nullsafe(spark, sf_dir):
    log = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.when(F.col("event_id") % 3 != 0, F.col("user_id") % 4).alias("pid"))
    new = log.where("event_id % 50 = 1").withColumn("event_id", -F.col("event_id"))
    return upsert.replace_log_group(log, new, ["user_id", "event_type"], "pid").select("event_id")


@query("SELECT event_id, event_type, props FROM events WHERE regexp_matches(event_type, 'err|sign') ORDER BY event_id DESC LIMIT 500")
def log_tail(spark, sf_dir):
    return logs.tail(logs.search(read(spark, sf_dir, "events"), "err|sign", "event_type"), "event_id").select("event_id", "event_type", "props")


@query("SELECT n_nationkey AS k, n_name AS name, n_regionkey AS region FROM nation UNION ALL SELECT r_regionkey, r_name, NULL FROM region")
def diagonal_union(spark, sf_dir):
    nation = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    return nation.unionByName(read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name")), allowMissingColumns=True)


@query("""
WITH d AS (SELECT DISTINCT user_id, event_id FROM events), g AS (SELECT *, CASE WHEN event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) > 40 THEN 1 ELSE 0 END AS b FROM d)
SELECT user_id, event_id FROM (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM g) WHERE i = 0
""")
def page_cluster_first(spark, sf_dir):
    return gates.islands(read(spark, sf_dir, "events"), ["user_id"], "event_id", 40).where("island = 0").select("user_id", "event_id")


@query("""
WITH d AS (SELECT DISTINCT p_brand, p_size FROM part), g AS (SELECT *, CASE WHEN p_size - lag(p_size) OVER (PARTITION BY p_brand ORDER BY p_size) > 1 THEN 1 ELSE 0 END AS b FROM d),
i AS (SELECT *, CAST(sum(b) OVER (PARTITION BY p_brand ORDER BY p_size) AS BIGINT) AS island FROM g)
SELECT p_brand, island, round(avg(p_size), 6) AS centroid, count(*) AS n FROM i GROUP BY ALL
""")
def x0_clusters(spark, sf_dir):
    return gates.centroids(read(spark, sf_dir, "part"), ["p_brand"], "p_size", 1).withColumn("centroid", F.round("centroid", 6))


FRAMEWORKS = {"the": [("[ \n]the[ \n]", 1), ("[ \n]and[ \n]", 2)], "der": [("[ \n]der[ \n]", 2), ("[ \n]und[ \n]", 2)], "le": [("[ \n]le[ \n]", 2), ("[ \n]et[ \n]", 2)]}


def _score(name):
    return " + ".join(f"least(len(regexp_extract_all(t, '{p}')), 3) * {w}" for p, w in FRAMEWORKS[name])


@query(f"""
WITH d AS (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents), s AS (SELECT doc_id, {_score('the')} AS a, {_score('der')} AS b, {_score('le')} AS c FROM d)
SELECT doc_id, CASE WHEN greatest(a, b, c) = 0 THEN 'none' WHEN a >= b AND a >= c THEN 'the' WHEN b >= c THEN 'der' ELSE 'le' END AS framework, CAST(greatest(a, b, c) AS BIGINT) AS score FROM s
""")
def framework_score(spark, sf_dir):
    t = F.lower(F.coalesce("text", F.lit("")))
    scores = read(spark, sf_dir, "documents").select("doc_id", *[text.capped_score(t, w).alias(k) for k, w in FRAMEWORKS.items()])
    best = F.greatest(*FRAMEWORKS)
    name = F.when(best == 0, "none")
    for k in FRAMEWORKS:
        name = name.when(F.col(k) == best, k)
    return scores.select("doc_id", name.alias("framework"), best.alias("score"))


@query("""
WITH d AS (SELECT doc_id, string_split(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g'), ' ') AS w FROM documents)
SELECT doc_id, round(100.0 * (list_contains(w, 'the')::INT + list_contains(w, 'and')::INT + list_contains(w, 'der')::INT) / 3, 2) AS pct FROM d
""")
def entity_token_pct(spark, sf_dir):
    tokens = text.name_tokens(F.lit("The AND der the 12 of"), ["of"])
    return read(spark, sf_dir, "documents").select("doc_id", text.match_pct(tokens, F.col("text")).alias("pct"))


@query("""
WITH l AS (SELECT doc_id, lines[i] AS line, i FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
s AS (SELECT *, coalesce(sum(regexp_matches(line, '[.?!]\\s*$')::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM l)
SELECT doc_id, CAST(k AS BIGINT) AS sentence, max(i) - 1 AS last_line, length(string_agg(line, ' ' ORDER BY i)) AS n_chars FROM s GROUP BY doc_id, k
""")
def sentence_split(spark, sf_dir):
    lines = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("i", "line"))
    before = Window.partitionBy("doc_id").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    ends = F.coalesce(F.sum(F.col("line").rlike(r"[.?!]\s*$").cast("long")).over(before), F.lit(0))
    rows = lines.withColumn("sentence", ends)
    return rows.groupBy("doc_id", "sentence").agg(F.max("i").cast("long").alias("last_line"), (F.sum(F.length("line")) + F.count("*") - 1).cast("long").alias("n_chars"))


@query("""
WITH s AS (SELECT source, CASE WHEN quality = 1 AND toxic = 0 THEN 1 WHEN quality = 0 AND toxic = 0 THEN 2 WHEN quality = 0 THEN 3 END AS r FROM labels JOIN documents USING (doc_id))
SELECT source, CASE max(r) WHEN 1 THEN 'PASS' WHEN 3 THEN 'FAIL' ELSE 'REVIEW' END AS gate FROM s GROUP BY 1
""")
def gate_aggregate(spark, sf_dir):
    steps = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    q, t = F.col("quality") == 1, F.col("toxic") == 0
    status = F.when(q & t, "PASS").when(~q & t, "REVIEW").when(~q, "NOT FOUND").otherwise("NOT APPLICABLE")
    return gates.gate(steps.select("source", status.alias("status")), ["source"])


@query("""
WITH s AS (SELECT source, CASE WHEN quality = 1 AND toxic = 0 THEN 1 WHEN quality = 0 AND toxic = 0 THEN 2 WHEN quality = 0 THEN 3 END AS r FROM labels JOIN documents USING (doc_id))
SELECT source, CASE max(r) WHEN 1 THEN 'PASS' WHEN 3 THEN 'FAIL' ELSE 'REVIEW' END AS gate FROM s GROUP BY 1
""")
def gate_aggregate_all(spark, sf_dir):
    steps = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    q, t = F.col("quality") == 1, F.col("toxic") == 0
    status = F.when(q & t, "PASS").when(~q & t, "REVIEW").when(~q, "NOT FOUND").otherwise("NOT APPLICABLE")
    return gates.gate(steps.select("source", status.alias("status")), ["source"])


@query("""
SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'OCR REQUIRED' WHEN doc_id % 5 = 0 OR quality = 0 THEN 'FAIL' WHEN toxic = 1 THEN 'REVIEW' ELSE 'PASS' END AS verdict FROM labels
""")
def overall_status(spark, sf_dir):
    k = F.col("doc_id")
    g1 = F.when(k % 7 == 0, "OCR REQUIRED").when(k % 5 == 0, "?").otherwise("PASS")
    g2 = F.when(F.col("quality") == 0, "FAIL").otherwise("PASS")
    g3 = F.when(F.col("toxic") == 1, "REVIEW").otherwise("PASS")
    return read(spark, sf_dir, "labels").select("doc_id", gates.overall(g1, g2, g3).alias("verdict"))


@query("SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) % 10 AS k, count(*) AS n FROM events GROUP BY ALL")
def json_props(spark, sf_dir):
    k = F.from_json("props", "k long")["k"] % 10
    return read(spark, sf_dir, "events").groupBy("event_type", k.alias("k")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, unnest(['price', 'key', 'missing']) AS col, unnest([CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), CAST(o_custkey AS VARCHAR), '-']) AS raw FROM orders")
def compact_expand(spark, sf_dir):
    from folio.sources.statements import expand_compact

    cells = F.array(F.lit("DP"), F.col("o_orderstatus"), F.lit("Order"), F.lit(""), money("o_totalprice").cast("string"), F.col("o_custkey").cast("string"))
    rows = read(spark, sf_dir, "orders").select("o_orderkey", cells.alias("cells"), F.array(F.lit("price"), F.lit("key"), F.lit("missing")).alias("cols"))
    return expand_compact(rows).select("o_orderkey", "col", "raw")


@query("SELECT o_orderkey, o_custkey AS a, CAST(length(o_orderpriority) AS BIGINT) AS b FROM orders")
def melt_pivot(spark, sf_dir):
    wide = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("a"), F.length("o_orderpriority").cast("long").alias("b"))
    return total_check.widen(total_check.melt(wide, ["o_orderkey"], ["a", "b"]), ["o_orderkey"], ["a", "b"])


@query("""
SELECT role, CAST(sum(length(text)) AS BIGINT) AS tokens, round(sum(length(text)) / 1000000.0 * CASE role WHEN 'user' THEN 2.5 ELSE 10 END, 6) AS cost FROM conversations WHERE role IN ('user', 'assistant') GROUP BY role
""")
def cost_breakdown(spark, sf_dir):
    rates = spark.createDataFrame([("user", 2.5), ("assistant", 10.0)], "role string, rate double")
    used = read(spark, sf_dir, "conversations").groupBy("role").agg(F.sum(F.length("text")).alias("tokens"))
    return used.join(F.broadcast(rates), "role").select("role", "tokens", F.round(F.col("tokens") / 1000000 * F.col("rate"), 6).alias("cost"))


@query("SELECT page_id, list_sort(list_distinct([page_id % 5, page_id % 7, CAST(3 AS BIGINT)]))::VARCHAR AS pages FROM pages")
def page_map_union(spark, sf_dir):
    both = F.array_sort(F.array_union(F.array(F.col("page_id") % 5, F.col("page_id") % 7), F.array(F.lit(3).cast("long"))))
    return read(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("["), F.array_join(both, ", "), F.lit("]")).alias("pages"))


@query("SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS start, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM events GROUP BY ALL")
def windowed_log_counts(spark, sf_dir):
    return logs.windowed_counts(read(spark, sf_dir, "events")).withColumn("total", F.col("total").cast("double")).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query()
def nested_totals(spark, sf_dir):
    rows = event_rows(spark, sf_dir).select("table_id", F.col("row_order").cast("int").alias("row_order"), F.when(F.col("row_order") % 11 == 0, "DPG").otherwise(F.col("flag")).alias("flag"), "amt")
    return nested.nested_totals(rows)
