"""Queries of the verdicts on documents, over the documents' lines, 20 to a page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.operators import document_checks as checks
from folio.plans.catalogue import query, read


def lines(spark, sf_dir) -> DataFrame:
    rows = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("i", "text"))
    return rows.select("doc_id", F.floor(F.col("i") / 20).cast("int").alias("page"), (F.col("i") % 20).alias("line"), "text")


_LINES = """
l AS (SELECT doc_id, i - 1 AS i, (i - 1) // 20 AS page, (i - 1) % 20 AS line, parts[i] AS text FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)))
"""
_WORDS = "list_distinct(list_filter(string_split(trim(regexp_replace(lower(%s), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' '), lambda x: x <> ''))"


def _pct(text: str, wanted: list[str]) -> str:
    return f"round(100.0 * len(list_intersect({_WORDS.replace('%s', text)}, {wanted})) / {len(wanted)}, 2)"


@query(f"""
WITH {_LINES}, n AS (SELECT *, coalesce(sum(regexp_matches(text, '[.?!]\\s*$')::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sentence FROM l WHERE page < 30),
c AS (SELECT doc_id, page, 1 AS tier, line AS place, {_pct('text', ['tion', 'ment'])} AS pct FROM l WHERE page < 5 AND line < 10
  UNION ALL SELECT doc_id, max(page), 2, sentence, {_pct("string_agg(text, ' ' ORDER BY i)", ['tion', 'ment'])} FROM n GROUP BY doc_id, sentence),
b AS (SELECT doc_id, page, pct, row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN pct >= 100 THEN tier ELSE 3 END, pct DESC, tier, page, place) AS k FROM c WHERE pct >= 90)
SELECT d.doc_id, CASE WHEN pct >= 100 THEN 'PASS' WHEN pct >= 90 THEN 'REVIEW' ELSE 'FAIL' END AS status, coalesce(pct, 0) AS score, CAST(page AS INT) AS page FROM documents d LEFT JOIN b ON d.doc_id = b.doc_id AND k = 1
""")
def entity_name_check(spark, sf_dir):
    wanted = read(spark, sf_dir, "documents").select("doc_id", F.lit("The Tion & Ment, Inc.").alias("entity"))
    return checks.entity_name(lines(spark, sf_dir), wanted)


@query(f"""
WITH {_LINES}, t AS (SELECT doc_id, page, line, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS a, lower(trim(regexp_replace(concat_ws(' ', text, lead(text) OVER w), '\\s+', ' ', 'g'))) AS b, lead(text) OVER w IS NOT NULL AS more FROM l WHERE line < 12 WINDOW w AS (PARTITION BY doc_id, page ORDER BY line)),
h AS (SELECT doc_id, page, line, 1 AS span, a AS chunk FROM t UNION ALL SELECT doc_id, page, line, 2, b FROM t WHERE more),
f AS (SELECT doc_id, page, line, span, unnest(list_filter([CASE WHEN regexp_matches(chunk, 'of the') THEN 'english' END, CASE WHEN regexp_matches(chunk, '^der') THEN 'german' END], lambda x: x IS NOT NULL)) AS title FROM h)
SELECT doc_id, page, title, line, span FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page, title ORDER BY line, span) AS k FROM f) WHERE k = 1
""")
def title_windows(spark, sf_dir):
    return checks.title_windows(lines(spark, sf_dir), {"english": "of the", "german": "^der"}, span=2)


@query("""
WITH p AS (SELECT user_id AS doc_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS page, count(*) OVER (PARTITION BY user_id) AS n, event_id % 100 AS chars, event_id % 3 = 0 AS raster FROM events),
s AS (SELECT * FROM p WHERE n <= 40 OR page IN (SELECT unnest([CAST(floor(i * n / 40.0) AS BIGINT) FOR i IN range(0, 40)])))
SELECT doc_id, count(*) FILTER (chars >= 50 OR raster) > 0 AND count(*) FILTER (chars < 50 AND raster) >= 0.6 * count(*) FILTER (chars >= 50 OR raster) AS ocr FROM s GROUP BY 1
""")
def ocr_needed(spark, sf_dir):
    from pyspark.sql import Window

    k = F.col("event_id")
    pages = read(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), (F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1).alias("page"), (k % 100).alias("n_chars"), (k % 3 == 0).alias("raster"))
    return checks.requires_ocr(pages)


_STATUS = "['PASS', 'PASS', 'REVIEW', 'FAIL', 'NOT APPLICABLE', 'PASS']"


@query(f"""
WITH s AS (SELECT l_orderkey AS doc_id, 'G3-' || (1 + l_linenumber % 6) AS step, {_STATUS}[1 + (l_partkey + l_linenumber) % 6] AS status FROM lineitem WHERE l_linenumber % 6 > 0 OR l_partkey % 5 = 0),
g AS (SELECT doc_id, bool_or(step = 'G3-1' AND status IN ('PASS', 'REVIEW')) AS one,
  CASE WHEN count(*) FILTER (step IN ('G3-2', 'G3-3', 'G3-4', 'G3-5')) = 0 OR bool_or(status IN ('FAIL', 'NOT APPLICABLE')) FILTER (step IN ('G3-2', 'G3-3', 'G3-4', 'G3-5')) THEN 'FAIL' WHEN bool_or(status = 'REVIEW') FILTER (step IN ('G3-2', 'G3-3', 'G3-4', 'G3-5')) THEN 'REVIEW' ELSE 'PASS' END AS lg,
  CASE WHEN count(*) FILTER (step IN ('G3-2', 'G3-4', 'G3-6')) = 0 OR bool_or(status IN ('FAIL', 'NOT APPLICABLE')) FILTER (step IN ('G3-2', 'G3-4', 'G3-6')) THEN 'FAIL' WHEN bool_or(status = 'REVIEW') FILTER (step IN ('G3-2', 'G3-4', 'G3-6')) THEN 'REVIEW' ELSE 'PASS' END AS other FROM s GROUP BY 1)
SELECT doc_id, CASE WHEN one THEN 'PASS' WHEN doc_id % 2 = 1 THEN other WHEN 'PASS' IN (lg, other) THEN 'PASS' WHEN 'REVIEW' IN (lg, other) THEN 'REVIEW' ELSE 'FAIL' END AS gate FROM g
""")
def third_gate(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem").where("l_linenumber % 6 > 0 or l_partkey % 5 = 0")
    status = F.get(F.array(*[F.lit(x) for x in ("PASS", "PASS", "REVIEW", "FAIL", "NOT APPLICABLE", "PASS")]), ((F.col("l_partkey") + F.col("l_linenumber")) % 6).cast("int"))
    steps = line.select(F.col("l_orderkey").alias("doc_id"), F.concat(F.lit("G3-"), (1 + F.col("l_linenumber") % 6).cast("string")).alias("step"), status.alias("status"))
    sectors = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.when(F.col("o_orderkey") % 2 == 0, "lg").otherwise("NONLG").alias("sector"))
    return checks.third_gate(steps, sectors)


@query("""
WITH c AS (SELECT user_id AS doc_id, event_id % 7 AS off, count(*) AS n, min(event_id) AS first FROM events GROUP BY ALL)
SELECT doc_id, off AS "offset" FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) AS k FROM c) WHERE k = 1
""")
def modal_offset(spark, sf_dir):
    return checks.modal_offset(read(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("at"), (F.col("event_id") % 7).alias("offset")))


_MONTHS = ["January", "June", "September", "December"]


@query(f"""
WITH {_LINES}, w AS (SELECT *, doc_id % 4 AS m, 2019 + doc_id % 5 AS y FROM l),
t AS (SELECT doc_id, page, line, CASE WHEN i % 31 = 7 THEN CASE WHEN page < 10 AND i % 4 = m AND 2019 + i % 5 = y THEN 0 WHEN i % 4 = m AND 2019 + i % 5 = y THEN 2 WHEN i % 4 = m THEN 3 WHEN 2019 + i % 5 = y THEN 4 END END AS tier FROM w),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tier, page, line) AS k FROM t WHERE tier IS NOT NULL)
SELECT d.doc_id, CASE WHEN tier <= 1 THEN 'PASS' WHEN tier IS NOT NULL THEN 'REVIEW' ELSE 'FAIL' END AS status, CASE tier WHEN 0 THEN 100.0 WHEN 2 THEN 90.0 WHEN 3 THEN 80.0 WHEN 4 THEN 70.0 ELSE 0.0 END::DOUBLE AS score, CAST(page AS INT) AS page FROM documents d LEFT JOIN b ON d.doc_id = b.doc_id AND k = 1
""")
def fiscal_year_check(spark, sf_dir):
    """Every 31st line is replaced by a date that hangs on its place; the others are without digits."""
    months = lambda k: F.get(F.array(*[F.lit(m) for m in _MONTHS]), (k % 4).cast("int"))
    i = F.col("page") * 20 + F.col("line")
    dated = F.concat(F.lit("Year ended "), months(i), F.lit(" 30, "), (2019 + i % 5).cast("string"))
    own = lines(spark, sf_dir).withColumn("text", F.when(i % 31 == 7, dated).otherwise(F.translate("text", "0123456789", "")))
    k = F.col("doc_id")
    month = F.get(F.array(F.lit(1), F.lit(6), F.lit(9), F.lit(12)), (k % 4).cast("int"))
    wanted = read(spark, sf_dir, "documents").select("doc_id", F.struct(month.alias("month"), (2019 + k % 5).cast("int").alias("year")).alias("fye"))
    return checks.fiscal_year(own, wanted)


@query()
def auditor_names(spark, sf_dir):
    """Each document is asked for a name that is a stretch of its own text with a character left out; no SQL has the likeness, so
    tests/test_near_names.py holds the join against all pairs."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " ")
    asked = read(spark, sf_dir, "documents").select("doc_id", F.concat(F.substring(text, 11, 10), F.substring(text, 22, 14)).alias("auditor"))
    return checks.auditor(lines(spark, sf_dir), asked)
