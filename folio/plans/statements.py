"""Queries of the whole-statement check over statements made from orders: their lines are items, totals are off by an amount that hangs on the key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.operators import total_check
from folio.operators.statement_check import check_lines, check_statements
from folio.plans.catalogue import money, query, read

OFF = [0, 1, -2, 0, 3]
_OFF = "[0, 1, -2, 0, 3]"


def off(n: int):
    return F.get(F.array(*[F.lit(x) for x in OFF]), (F.floor(F.col("l_orderkey") / n) % 5).cast("int"))


def _off(n: int) -> str:
    return f"{_OFF}[1 + (k // {n}) % 5]"


def lines(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.round(money("l_extendedprice")).cast("decimal(38,4)").alias("amt"))


def statement(kind: str, items: DataFrame, totals: DataFrame) -> DataFrame:
    """items (doc_id, section, row_order, label, datapoint, amt), totals (doc_id, section, row_order, datapoint, amt) as statement rows."""
    row = lambda df, flag: df.select("doc_id", F.lit(kind).alias("stmt_type"), F.lit("p1").alias("table_id"), "section", F.col("row_order").cast("int").alias("row_order"), F.lit(flag).alias("flag"), *([F.col("label")] if flag == "DP" else [F.col("datapoint").alias("label")]), "datapoint", F.lit("amount").alias("col"), F.lit(0).alias("col_pos"), F.col("amt").cast("decimal(38,4)").alias("amt"))
    return row(items, "DP").unionByName(row(totals, "CP"))


def columned(kind: str, section: str, rows: DataFrame, columns: list[str]) -> DataFrame:
    """rows (doc_id, row_order, flag, label, datapoint, amts: an amount for each column) as the lines of one section."""
    named, places = F.array(*[F.lit(c) for c in columns]), F.array(*[F.lit(k) for k in range(len(columns))])
    return rows.select("doc_id", F.lit(kind).alias("stmt_type"), F.lit("p1").alias("table_id"), F.lit(section).alias("section"), F.col("row_order").cast("int").alias("row_order"), "flag", "label", "datapoint", named.alias("cols"), places.alias("col_pos"), "amts")


def amounts(amts: list) -> Column:
    """An array without nulls."""
    return F.array(*[F.coalesce(a.cast("decimal(38,4)"), F.lit(0).cast("decimal(38,4)")) for a in amts])


def totalled(sums: DataFrame, *rows: tuple) -> DataFrame:
    """Totals of each row of sums (l_orderkey, ...): (row_order, datapoint, amounts), as rows of columned()."""
    each = F.array(*[F.struct(F.lit(at).alias("row_order"), F.lit("CP").alias("flag"), F.lit(name).alias("label"), F.lit(name).alias("datapoint"), amounts(amts).alias("amts")) for at, name, amts in rows])
    return sums.select(F.col("l_orderkey").alias("doc_id"), F.explode(each).alias("x")).select("doc_id", "x.*")


def made(sums: DataFrame, *rows: tuple) -> DataFrame:
    """Totals of each row of sums (l_orderkey, ...): (section, row_order, datapoint, amount)."""
    each = F.array(*[F.struct(F.lit(s).alias("section"), F.lit(at).alias("row_order"), F.lit(name).alias("datapoint"), amt.cast("decimal(38,4)").alias("amt")) for s, at, name, amt in rows])
    return sums.select(F.col("l_orderkey").alias("doc_id"), F.explode(each).alias("x")).select("doc_id", "x.*")


def result(checked: DataFrame) -> DataFrame:
    return checked.select("doc_id", "row_order", "status")


_GOV = f"""
WITH s AS (SELECT l_orderkey AS k, coalesce(sum(a) FILTER (f <> 'R'), 0) AS rev, coalesce(sum(a) FILTER (f = 'R'), 0) AS exp FROM (SELECT l_orderkey, l_returnflag AS f, round(CAST(l_extendedprice AS DECIMAL(18,2))) AS a FROM lineitem) GROUP BY 1),
o AS (SELECT *, {_off(1)} AS o1, {_off(3)} AS o2, {_off(7)} AS o3 FROM s), t AS (SELECT *, rev + o1 AS trev, rev + o1 - exp + o2 AS excess FROM o)
"""
_SAY = "CASE WHEN {} THEN 'PASS' ELSE 'amount: FAIL' END"


@query(_GOV + f"""
SELECT k AS doc_id, unnest([100, 101, 102, 103]) AS row_order, unnest([{_SAY.format('abs(o1) <= 1')}, 'PASS', {_SAY.format('abs(o2) <= 1')}, {_SAY.format('abs(o3) <= 1 OR abs(trev - (excess + o3)) <= 1')}]) AS status FROM t
""")
def statement_check_gov_is(spark, sf_dir):
    rows, revenue = lines(spark, sf_dir), F.col("l_returnflag") != "R"
    items = rows.select(F.col("l_orderkey").alias("doc_id"), F.when(revenue, "Revenues").otherwise("EXPENDITURES").alias("section"), F.col("l_linenumber").alias("row_order"), F.lit("item").alias("label"), F.lit("Item").alias("datapoint"), "amt")
    zero = F.lit(0)
    sums = rows.groupBy("l_orderkey").agg(F.coalesce(F.sum(F.when(revenue, F.col("amt"))), zero).alias("rev"), F.coalesce(F.sum(F.when(~revenue, F.col("amt"))), zero).alias("exp"))
    trev, excess = F.col("rev") + off(1), F.col("rev") + off(1) - F.col("exp") + off(3)
    totals = made(sums, ("Revenues", 100, "Total Operating Revenues", trev), ("EXPENDITURES", 101, "total operating expenses", F.col("exp")), ("Excess", 102, "Excess Of Revenues Over/Under Expenditures", excess), ("Change", 103, "Net Change In Fund Balances", excess + off(7)))
    return result(check_statements(statement("GOV_IS", items, totals)))


@query(f"""
WITH l AS (SELECT l_orderkey AS k, l_linenumber % 2 = 1 AS cur, round(CAST(l_extendedprice AS DECIMAL(18,2))) AS a FROM lineitem),
s AS (SELECT k, sum(a) AS whole, coalesce(sum(a) FILTER (cur), 0) AS current FROM l GROUP BY 1), o AS (SELECT *, {_off(1)} AS o1, {_off(3)} AS o2, {_off(7)} AS o3 FROM s)
SELECT k AS doc_id, unnest([100, 101, 102]) AS row_order, unnest([{_SAY.format('abs(o1) <= 1')}, {_SAY.format('abs(o2) <= 1')},
  {_SAY.format('abs(o3) <= 1')}]) AS status FROM o
""")
def statement_check_snp(spark, sf_dir):
    """Current assets by their labels, total assets by their section, and a sum with deferred outflows of which there are none."""
    rows, current = lines(spark, sf_dir), F.col("l_linenumber") % 2 == 1
    items = rows.select(F.col("l_orderkey").alias("doc_id"), F.lit("Assets").alias("section"), F.col("l_linenumber").alias("row_order"), F.when(current, "Current assets: cash").otherwise("Noncurrent assets").alias("label"), F.lit("Item").alias("datapoint"), "amt")
    sums = rows.groupBy("l_orderkey").agg(F.sum("amt").alias("whole"), F.coalesce(F.sum(F.when(current, F.col("amt"))), F.lit(0)).alias("current"))
    whole = F.col("whole") + off(3)
    totals = made(sums, ("Assets", 100, "Total Current Assets", F.col("current") + off(1)), ("Assets", 101, "Total Assets", whole), ("Assets", 102, "Total Assets and Deferred Outflows of Resources", whole + off(7)))
    return result(check_statements(statement("SNP", items, totals)))


@query(f"""
SELECT l_orderkey AS doc_id, row_number() OVER (PARTITION BY l_orderkey) * 10 + 5 AS row_order, {_SAY.format(f"abs({_off(1).replace('(k', '(l_orderkey')}) <= 1")} AS status FROM lineitem
""")
def statement_check_prop_is(spark, sf_dir):
    """After each line a rolling subtotal, which is the line with the total before it."""
    line = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_returnflag", "amt")
    rows = lines(spark, sf_dir).withColumn("l_linenumber", F.row_number().over(line))
    items = rows.select(F.col("l_orderkey").alias("doc_id"), F.lit("Operating Revenues").alias("section"), (F.col("l_linenumber") * 10).alias("row_order"), F.lit("item").alias("label"), F.lit("Item").alias("datapoint"), "amt")
    line = Window.partitionBy("l_orderkey").orderBy("l_linenumber")
    totals = rows.withColumn("upto", F.sum("amt").over(line)).select(F.col("l_orderkey").alias("doc_id"), F.lit("Operating Revenues").alias("section"), (F.col("l_linenumber") * 10 + 5).alias("row_order"), F.lit("Total Operating Revenues").alias("datapoint"), (F.col("upto") + off(1) * F.col("l_linenumber")).alias("amt"))
    return result(check_statements(statement("PROP_IS", items, totals)))


@query(f"""
WITH l AS (SELECT l_orderkey AS k, l_returnflag AS f, round(CAST(l_extendedprice AS DECIMAL(18,2))) AS a FROM lineitem), s AS (SELECT k, f, sum(a) AS a FROM l GROUP BY ALL), c AS (SELECT k, sum(a + {_off(1)}) AS net FROM s GROUP BY 1)
SELECT k AS doc_id, CASE f WHEN 'A' THEN 100 WHEN 'N' THEN 101 ELSE 102 END AS row_order, {_SAY.format(f'abs({_off(1)}) <= 1')} AS status FROM s UNION ALL SELECT k, 103, {_SAY.format(f'abs({_off(3)}) <= 1')} FROM c
""")
def statement_check_prop_cfs(spark, sf_dir):
    """Flows of three activities by return flag, and the net change of their totals."""
    rows = lines(spark, sf_dir)
    name = F.when(F.col("l_returnflag") == "A", "Operating Activities").when(F.col("l_returnflag") == "N", "Noncapital Financing Activities").otherwise("Investing Activities")
    at = F.when(F.col("l_returnflag") == "A", 100).when(F.col("l_returnflag") == "N", 101).otherwise(102)
    items = rows.select(F.col("l_orderkey").alias("doc_id"), F.concat(F.lit("Cash flows from "), name).alias("section"), F.col("l_linenumber").alias("row_order"), F.lit("item").alias("label"), F.lit("Item").alias("datapoint"), "amt")
    sums = rows.groupBy("l_orderkey", "l_returnflag").agg((F.sum("amt") + off(1)).alias("amt"))
    totals = sums.select(F.col("l_orderkey").alias("doc_id"), F.concat(F.lit("Cash flows from "), name).alias("section"), at.alias("row_order"), F.concat(F.lit("Total Cash Flows from "), name).alias("datapoint"), F.col("amt").cast("decimal(38,4)").alias("amt"))
    net = made(sums.groupBy("l_orderkey").agg(F.sum("amt").alias("net")), ("Net", 103, "Net Change in Cash and Cash Equivalents", F.col("net") + off(3)))
    return result(check_statements(statement("PROP_CFS", items, totals.unionByName(net))))


@query(f"""
WITH s AS (SELECT l_orderkey AS k, sum(round(CAST(l_extendedprice AS DECIMAL(18,2)))) AS a FROM lineitem GROUP BY 1) SELECT k AS doc_id, abs({_off(1)}) <= 1 AS passed FROM s
""")
def statement_files_pass(spark, sf_dir):
    """Whether all totals of a statement are accepted; one without a rule is."""
    rows = lines(spark, sf_dir)
    items = rows.select(F.col("l_orderkey").alias("doc_id"), F.lit("Fund balances").alias("section"), F.col("l_linenumber").alias("row_order"), F.lit("item").alias("label"), F.lit("Item").alias("datapoint"), "amt")
    totals = made(rows.groupBy("l_orderkey").agg(F.sum("amt").alias("whole")), ("Fund balances", 100, "Total Fund Balances", F.col("whole") + off(1)), ("Fund balances", 101, "Total of something else", F.lit(0)))
    checked = check_statements(statement("GOV_BS", items, totals)).withColumn("flag", F.lit("CP"))
    return total_check.file_passes(checked, ["doc_id"])


def _fails(*parts: tuple[str, str]) -> str:
    """The failing columns of (name, offset), in order."""
    return "coalesce(nullif(concat_ws(' | ', " + ", ".join(f"CASE WHEN abs({o}) > 1 THEN '{c}: FAIL' END" for c, o in parts) + "), ''), 'PASS')"


@query(f"""
WITH o AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
SELECT k AS doc_id, unnest([100, 101]) AS row_order, unnest([{_fails(("Governmental", _off(1)), ("Total", _off(3)))}, {_fails(("Total", _off(7)), ("Component Units", _off(2)))}]) AS status FROM o
""")
def statement_check_soa(spark, sf_dir):
    """Four columns, of which the one between Total and Component Units is never told; transfers are no part of the first total."""
    rows, moved, factors = lines(spark, sf_dir), F.col("l_returnflag") == "R", (1, 3, 1, 2)
    items = rows.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("row_order"), F.lit("DP").alias("flag"), F.when(moved, "Transfers in").otherwise("Taxes").alias("label"), F.when(moved, "Transfers").otherwise("Taxes").alias("datapoint"), amounts([F.col("amt") * f for f in factors]).alias("amts"))
    sums = rows.groupBy("l_orderkey").agg(F.coalesce(F.sum(F.when(~moved, F.col("amt"))), F.lit(0)).alias("own"), F.coalesce(F.sum(F.when(moved, F.col("amt"))), F.lit(0)).alias("transfers"))
    zero = F.lit(0)
    first = [F.col("own") * f + o for f, o in zip(factors, (off(1), off(3), off(7), zero), strict=True)]
    second = [a + F.col("transfers") * f + o for a, f, o in zip(first, factors, (zero, off(7), off(1), off(2)), strict=True)]
    totals = totalled(sums, (100, "Total General Revenues", first), (101, "Total General Revenues and Transfer", second))
    return result(check_lines(columned("SOA", "General Revenues", items.unionByName(totals), ["Governmental", "Total", "Reconciling", "Component Units"])))


@query(f"""
WITH o AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
SELECT k AS doc_id, unnest([100, 101, 102]) AS row_order, unnest([{_SAY.format(f"abs({_off(1)}) <= 1")}, {_SAY.format(f"abs({_off(3)}) <= 1")}, {_SAY.format(f"abs({_off(7)}) <= 1")}]) AS status FROM o
""")
def statement_check_gov_bs(spark, sf_dir):
    """Liabilities and fund balances with totals of their own, deferred inflows by their section, and the sum of the three."""
    rows = lines(spark, sf_dir)
    section = F.when(F.col("l_returnflag") == "R", "Liabilities").when(F.col("l_returnflag") == "A", "Fund Balances").otherwise("Deferred Inflows of Resources")
    items = rows.select(F.col("l_orderkey").alias("doc_id"), section.alias("section"), F.col("l_linenumber").alias("row_order"), F.lit("item").alias("label"), F.lit("Item").alias("datapoint"), "amt")
    of = lambda flag: F.coalesce(F.sum(F.when(F.col("l_returnflag") == flag, F.col("amt"))), F.lit(0))
    sums = rows.groupBy("l_orderkey").agg(of("R").alias("owed"), of("A").alias("held"), of("N").alias("deferred"))
    owed, held = F.col("owed") + off(1), F.col("held") + off(3)
    totals = made(sums, ("Liabilities", 100, "Total Liabilities", owed), ("Fund Balances", 101, "Total Fund Balances", held), ("Sum", 102, "Total Liabilities, Deferred Inflows of Resources, And Fund Balances", owed + held + F.col("deferred") + off(7)))
    return result(check_statements(statement("GOV_BS", items, totals)))


@query(f"""
WITH o AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
SELECT k AS doc_id, unnest([100, 101]) AS row_order, unnest([{_fails(("Principal", _off(1)), ("Interest", _off(3)), ("Total Debt Service", _off(7)))}, 'Skipped - no rule defined']) AS status FROM o
""")
def statement_check_dsr(spark, sf_dir):
    """A debt schedule: its premium isn't summed and counts towards the debt service; a section's second total has no rule."""
    rows, zero = lines(spark, sf_dir), F.lit(0)
    amt, premium = F.col("amt"), F.col("l_orderkey") % 9
    items = rows.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("row_order"), F.lit("DP").alias("flag"), F.lit("2024").alias("label"), F.lit("2024").alias("datapoint"), amounts([amt, amt * 2, zero, amt * 3]).alias("amts"))
    sums = rows.groupBy("l_orderkey").agg(F.sum("amt").alias("amt"))
    first = [amt + off(1), amt * 2 + off(3), premium, amt * 3 + premium + off(7)]
    totals = totalled(sums, (100, "Total", first), (101, "Grand total of all", [zero] * 4))
    return result(check_lines(columned("DSR", "Bonds", items.unionByName(totals), ["Principal", "Interest", "Premium/Discount", "Total Debt Service"])))
