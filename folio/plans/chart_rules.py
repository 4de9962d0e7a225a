"""Query of the label rules: orders as statement rows whose labels are put together from headings, items and terms by their keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators import chart_rules as m
from folio.plans.catalogue import query, read

HEADINGS = ["", "", "Restricted: ", "Noncurrent liabilities: ", "Receivables: ", "Noncurrent assets: ", "Bonds/notes payable, net: "]
ITEMS = [
    "Cash", "Cash and investments", "Accounts receivable", "Property tax receivable", "Interest", "Due from other governments", "Investment in subsidiaries", "Inventory of supplies", "Prepaid insurance", "Land",
    "Pension", "Bonds payable", "Leases", "Landfill closure", "Customer deposits", "Accrued interest", "Retainage", "Unearned revenue", "Other", "Performance bonds", "Total assets", "Total liabilities and deferred inflows", "Fund balance",
    "Net investment in capital assets", "Restricted for debt", "Unrestricted", "Deferred outflows of pensions", "Taxes and assessments", "Total net position", "Assets", "Something else", "Held by trustee", "Overdraft", "Claims and judgments",
]
TERMS = ["", "", ", net", " - non-current", " due within one year", " payable after one year", ", current", " and net position", " (long-term)", " with fiscal agent"]
FLAGS = ["DP", "DP", "DP", "DP", "CP", "DPG"]
SECTIONS = ["Assets", "Liabilities", "Net Position", "Deferred Inflows of Resources", "Deferred Outflows of Resources"]


def _pick(values: list[str], at):
    return F.get(F.array(*[F.lit(x) for x in values]), (at % len(values)).cast("int"))


def _held(phrase: str, text: str) -> str:
    return f"contains(' ' || {text}, ' {phrase}')"


def _any(phrases, text: str) -> str:
    return "(" + " OR ".join(_held(p, text) for p in phrases) + ")"


def _when(r: m.Rule) -> str:
    tests = [f"flag = '{r.flag}'"] + ([f"section = '{r.section}'"] if r.section else []) + [_any(g, r.part) for g in r.groups]
    tests += ([f"{r.part} IN ({', '.join(repr(x) for x in r.exact)})"] if r.exact else []) + ([f"NOT {_any(r.without, r.part)}"] if r.without else []) + ([_any(r.under, 'prefix')] if r.under else [])
    return f"WHEN {' AND '.join(tests)} THEN ['{r.name}', '{r.outcome}']"


def _case(stage: int) -> str:
    return "CASE " + " ".join(_when(r) for r in m.POSITION_RULES if r.stage == stage) + " END"


_FOLD = "regexp_replace(trim(regexp_replace(lower(%s), '[^a-z0-9]+', ' ', 'g')), '\\bnon current\\b', 'noncurrent', 'g')"


@query(f"""
WITH c AS (SELECT DISTINCT {FLAGS}[1 + CAST(p_partkey % {len(FLAGS)} AS INT)] AS flag, {SECTIONS}[1 + CAST(p_partkey % {len(SECTIONS)} AS INT)] AS section, {ITEMS}[1 + CAST(p_partkey * 5 % {len(ITEMS)} AS INT)] || ' (chart)' AS datapoint FROM part WHERE p_partkey % 3 = 0),
o AS (SELECT o_orderkey, {FLAGS}[1 + CAST(o_custkey % {len(FLAGS)} AS INT)] AS flag, {SECTIONS}[1 + CAST(o_orderkey % {len(SECTIONS)} AS INT)] AS section,
  {HEADINGS}[1 + CAST((o_orderkey + o_custkey) % {len(HEADINGS)} AS INT)] || {ITEMS}[1 + CAST(o_custkey * 3 % {len(ITEMS)} AS INT)] || CASE WHEN o_orderkey % 11 = 3 THEN ' (chart)' ELSE {TERMS}[1 + CAST((o_orderkey * 7 + o_custkey) % {len(TERMS)} AS INT)] END AS text FROM orders),
f AS (SELECT *, {_FOLD.replace('%s', 'text')} AS label, {_FOLD.replace('%s', "string_split(text, ':')[-1]")} AS suffix, {_FOLD.replace('%s', "array_to_string(string_split(text, ':')[:-2], ' ')")} AS prefix FROM o),
n AS (SELECT flag, section, {_FOLD.replace('%s', 'datapoint')} AS n, min(datapoint) AS d FROM c GROUP BY ALL), a AS (SELECT flag, n, min(d) AS d FROM n GROUP BY ALL),
g AS (SELECT *, {_case(1)} AS one, {_case(2)} AS two FROM f),
r AS (SELECT f.*, coalesce(n1.d, a1.d) AS own, coalesce(n2.d, a2.d) AS own2 FROM g AS f
  LEFT JOIN n n1 ON n1.flag = f.flag AND n1.section = f.section AND n1.n = label LEFT JOIN a a1 ON a1.flag = f.flag AND a1.n = label
  LEFT JOIN n n2 ON n2.flag = f.flag AND n2.section = f.section AND n2.n = suffix LEFT JOIN a a2 ON a2.flag = f.flag AND a2.n = suffix)
SELECT o_orderkey, text AS label, coalesce(one[2], own, own2, two[2], CASE flag WHEN 'DP' THEN 'Other_' || replace(section, ' ', '_') WHEN 'DPG' THEN 'Other_DPG' ELSE '' END) AS datapoint,
  coalesce(one[1], CASE WHEN own IS NOT NULL THEN 'chart' WHEN own2 IS NOT NULL THEN 'suffix' END, two[1], 'last') AS rule FROM r
""")
def chart_datapoints(spark, sf_dir):
    k = F.col("p_partkey")
    chart = read(spark, sf_dir, "part").where(k % 3 == 0).select(_pick(FLAGS, k).alias("flag"), _pick(SECTIONS, k).alias("section"), F.concat(_pick(ITEMS, k * 5), F.lit(" (chart)")).alias("datapoint")).distinct()
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    term = F.when(o % 11 == 3, " (chart)").otherwise(_pick(TERMS, o * 7 + c))
    rows = read(spark, sf_dir, "orders").select("o_orderkey", _pick(FLAGS, c).alias("flag"), _pick(SECTIONS, o).alias("section"), F.concat(_pick(HEADINGS, o + c), _pick(ITEMS, c * 3), term).alias("label"))
    return m.datapoints(rows, chart).select("o_orderkey", "label", "datapoint", "rule")
