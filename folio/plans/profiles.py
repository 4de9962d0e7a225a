"""Queries of profiles, presence and chart texts: orders as files whose lines are columns, parts as lines of charts."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators import profiles as m
from folio.plans.catalogue import query, read

_COLUMNS = ["Section", "COA Flag", "Row Items", "COA Datapoint", "2023", "Note Items", "2022", " ", "Unnamed: 3", "Page No", "_chain_used", "2021"]
_VALUES = ["1,234", "$ (5)", "-", "", "n/a", "12.5", "1.2.3", " 7 ", "—", "."]


def _pick(values, at):
    return F.get(F.array(*[F.lit(x) for x in values]), (at % len(values)).cast("int"))


def _cells(spark, sf_dir):
    """Each line of an order is a column of the file; its place hangs on the keys."""
    k = F.col("l_orderkey") + F.col("l_linenumber")
    return read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("file"), _pick(_COLUMNS, F.col("l_linenumber") * 2 + F.col("l_orderkey") % 3).alias("column"), F.col("l_linenumber").cast("long").alias("place"), _pick(_VALUES, k * 3 + F.col("l_suppkey")).alias("value"))


_CELLS = f"""
c AS (SELECT l_orderkey AS file, {_COLUMNS}[1 + CAST((l_linenumber * 2 + l_orderkey % 3) % {len(_COLUMNS)} AS INT)] AS "column", l_linenumber AS place, {_VALUES}[1 + CAST(((l_orderkey + l_linenumber) * 3 + l_suppkey) % {len(_VALUES)} AS INT)] AS value FROM lineitem),
p AS (SELECT file, "column", min(place) AS place, count(*) AS n, count(*) FILTER (trim(value) <> '') AS filled,
  count(*) FILTER (trim(value) NOT IN ('', '-', '–', '—') AND regexp_full_match(regexp_replace(trim(value), '[$,\\s()\\-]', '', 'g'), '[0-9]+\\.?[0-9]*|\\.[0-9]+')) AS numeric FROM c GROUP BY ALL)
"""


@query(f"""WITH {_CELLS} SELECT file, "column", CAST(place AS BIGINT) AS place, n, filled, numeric FROM p WHERE numeric > 0 AND "column" NOT IN {tuple(m.NOT_NUMERIC)}""")
def numeric_columns(spark, sf_dir):
    """Profiled in two parts, by even and odd lines, that are merged."""
    cells = _cells(spark, sf_dir)
    parts = [m.column_profiles(cells.where(f"place % 2 = {i}"), ["file"]) for i in (0, 1)]
    return m.numeric_columns(m.merged_profiles(parts[0].unionByName(parts[1]), ["file"])).select("file", "column", "place", "n", "filled", "numeric")


@query(f"""
WITH {_CELLS}, s AS (SELECT file, min(place) AS start FROM p WHERE "column" = 'COA Datapoint' GROUP BY 1), a AS (SELECT p.*, trim("column") AS name FROM p JOIN s USING (file) WHERE place > start),
e AS (SELECT file, coalesce(min(place) FILTER (name = 'Total Check Status' OR starts_with(name, '_')), max(place) + 1) AS stop FROM a GROUP BY 1)
SELECT file, "column", CAST(place AS BIGINT) AS place FROM a JOIN e USING (file) WHERE place < stop AND name NOT IN {tuple(m.META)} AND name <> '' AND NOT starts_with(lower(name), 'unnamed') AND NOT ends_with(name, ' Items') AND name <> 'Row Items'
""")
def reporting_columns(spark, sf_dir):
    return m.reporting_columns(m.column_profiles(_cells(spark, sf_dir), ["file"]), ["file"]).select("file", "column", "place")


_NAMES = [*m.SECTIONS, "Notes", "Other"]


@query(f"""
WITH c AS (SELECT DISTINCT l_orderkey AS file, {_NAMES}[1 + CAST((l_partkey + l_linenumber) % {len(_NAMES)} AS INT)] AS section FROM lineitem)
SELECT file, array_to_string(list_filter({m.SECTIONS}, lambda x: NOT list_contains(list(section), x)), '|') AS missing, coalesce(array_to_string(list_sort(list_filter(list(section), lambda x: NOT list_contains({m.SECTIONS}, x))), '|'), '') AS extra FROM c GROUP BY file
""")
def sections_missing(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("file"), _pick(_NAMES, F.col("l_partkey") + F.col("l_linenumber")).alias("section"))
    return m.presence(rows, ["file"], "section", m.SECTIONS).select("file", F.array_join("missing", "|").alias("missing"), F.array_join("extra", "|").alias("extra"))


@query("SELECT l_orderkey AS file, count(DISTINCT l_returnflag) AS sections, count(*) AS rows FROM lineitem GROUP BY 1")
def section_counts(spark, sf_dir):
    return m.section_counts(read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("file"), F.col("l_returnflag").alias("section")), ["file"])


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def status_tally(spark, sf_dir):
    return m.tally(read(spark, sf_dir, "orders"), "o_orderstatus")


@query("SELECT p_size AS template_id, p_retailprice AS sequence, p_partkey AS id, row_number() OVER (ORDER BY p_size, p_retailprice, p_partkey) AS at FROM part")
def chart_order(spark, sf_dir):
    """The sorted chart, with the place of each row that the sort gave it: ranges in order, numbered by what stands before them."""
    from folio.operators.upsert import numbered

    chart = read(spark, sf_dir, "part").select(F.col("p_size").alias("template_id"), F.col("p_retailprice").alias("sequence"), F.col("p_partkey").alias("id"))
    return m.chart_order(numbered(chart, ["template_id", "sequence", "id"], "at"))


_PROMPTS = ["SNP", "SOA", "GOV_BS", "DEBT", "DSR"]


@query(f"""
WITH w AS (SELECT user_id, list(DISTINCT event_type ORDER BY event_type) AS wanted FROM events GROUP BY 1), a AS (SELECT list(DISTINCT event_type) AS available FROM events WHERE event_id % 2 = 0 AND event_type <> 'click')
SELECT user_id, array_to_string(list_filter(wanted, lambda x: list_contains(available, x)), '|') AS usable, array_to_string(list_filter(wanted, lambda x: NOT list_contains(available, x)), '|') AS skipped FROM w, a
""")
def allowed_tables(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    wanted = events.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("wanted"))
    available = events.where("event_id % 2 = 0 and event_type <> 'click'").agg(F.collect_set("event_type").alias("available"))
    usable, skipped = m.allowed(F.col("wanted"), F.col("available"))
    return wanted.join(F.broadcast(available)).select("user_id", F.array_join(usable, "|").alias("usable"), F.array_join(skipped, "|").alias("skipped"))


def _chart_text(spark, sf_dir):
    """Parts of one size are a chart's lines in the order of their keys."""
    kinds = F.concat(_pick(_PROMPTS, F.col("p_partkey")), F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("|"), _pick(_PROMPTS, F.col("p_partkey") + 2))).otherwise(""))
    text = F.when(F.col("p_partkey") % 13 == 0, " ").otherwise(F.concat_ws(" | ", kinds, "p_brand", "p_name", "p_type", F.when(F.col("p_partkey") % 3 > 0, F.col("p_brand"))))
    return read(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("chart"), (F.col("p_partkey") % 5).alias("line"), text.alias("text"))


_CHART = f"""
t AS (SELECT p_partkey, p_size AS chart, p_partkey % 5 AS line, CASE WHEN p_partkey % 13 = 0 THEN ' ' ELSE concat_ws(' | ', {_PROMPTS}[1 + CAST(p_partkey % 5 AS INT)] || CASE WHEN p_partkey % 4 = 0 THEN '|' || {_PROMPTS}[1 + CAST((p_partkey + 2) % 5 AS INT)] ELSE '' END, p_brand, p_name, p_type, CASE WHEN p_partkey % 3 > 0 THEN p_brand END) END AS text FROM part)
"""


@query(f"WITH {_CHART} SELECT p_partkey, text FROM t WHERE line = 0 OR trim(text) <> '' AND list_contains(list_transform(string_split(string_split(text, ' | ')[1], '|'), lambda x: trim(x)), 'SOA')")
def chart_lines(spark, sf_dir):
    return m.chart_lines_for(_chart_text(spark, sf_dir), F.lit("SOA")).select("p_partkey", "text")


@query(f"WITH {_CHART} SELECT p_partkey, string_split(text, ' | ')[2] || ' | ' || string_split(text, ' | ')[3] AS text FROM t WHERE line > 0 AND trim(text) <> '' AND len(string_split(text, ' | ')) >= 5")
def chart_compressed(spark, sf_dir):
    return m.compressed_chart(_chart_text(spark, sf_dir)).select("p_partkey", "text")


_STEPS = ["G1-1", "G1-2", "G1-3", "G1-4"]


@query(f"""
WITH s AS (SELECT l_orderkey AS doc, {_STEPS}[1 + CAST(l_linenumber % 4 AS INT)] AS step, CASE WHEN l_suppkey % 7 > 0 THEN 'PASS' END AS status, (l_quantity::INT % 100)::DOUBLE AS score, CASE WHEN l_partkey % 9 = 0 THEN 'ValueError' END AS error FROM lineitem),
w AS (SELECT doc, step, min(error) AS error, arg_max(coalesce(status, ''), struct_pack(a := score, b := coalesce(status, ''))) AS status, max(score) AS score FROM s GROUP BY ALL)
SELECT d.doc, d.step, CASE WHEN error IS NOT NULL OR coalesce(status, '') = '' THEN 'FAIL' ELSE status END AS status, CASE WHEN error IS NOT NULL OR coalesce(status, '') = '' THEN 0.0 ELSE score END AS score,
  CASE WHEN error IS NOT NULL THEN 'crashed: ' || error WHEN coalesce(status, '') = '' THEN 'no result' ELSE '' END AS note
FROM (SELECT DISTINCT doc, unnest({_STEPS}) AS step FROM s) d LEFT JOIN w ON w.doc = d.doc AND w.step = d.step
""")
def gate_steps(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem")
    steps = line.select(F.col("l_orderkey").alias("doc"), _pick(_STEPS, F.col("l_linenumber")).alias("step"), F.when(F.col("l_suppkey") % 7 > 0, "PASS").alias("status"), (F.col("l_quantity").cast("int") % 100).cast("double").alias("score"), F.when(F.col("l_partkey") % 9 == 0, "ValueError").alias("error"))
    return m.settled_steps(steps, _STEPS, ["doc"])
