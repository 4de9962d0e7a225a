"""Query of the statement finder: over the documents' lines with three lines of statements before each, ten to a page, that hang on their place."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators import statement_finder as m
from folio.plans.catalogue import query, read
from folio.plans.opinions import _PLAIN, _has, _q

#: Lines that are planted; a line's neighbour is one place on within a document's page.
PLANTED = [
    "Statement of Cash Receipts", "and Expenditures", "Statement of Revenues, Expenditures and Changes", "in Fund Balances", "Total assets 1,000", "revenues", "Balance Sheet", "Governmental Funds of the city",
    "liabilities", "expenditures 2,500", "fund balance", "cash receipts", "June 30, 2021", "Current Fund", "Statement of Operations and change in fund balance", "supplementary schedule",
    "Combined", "Total governmental funds", "year ended December 31, 2020", "Table 1", "assets and reserves", "change in fund balances", "Budgetary data for", "liability",
]
PER_PAGE = 10


def planted_lines(spark, sf_dir):
    lines = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("at", "own"))
    # digits of the documents' own lines don't count, so that the planted dates alone decide
    lines = lines.select("doc_id", F.regexp_replace("own", "[0-9]+", "").alias("own"), F.explode(F.sequence(F.col("at") * 4, F.col("at") * 4 + 3)).alias("i"))
    i, doc = F.col("i"), F.col("doc_id")
    k = ((doc + i + F.floor(i / PER_PAGE) * (doc % 5)) % len(PLANTED)).cast("int")
    text = F.when(i % 4 < 3, F.get(F.array(*[F.lit(x) for x in PLANTED]), k)).otherwise(F.col("own"))
    return lines.select("doc_id", F.floor(i / PER_PAGE).cast("int").alias("page"), (i % PER_PAGE).alias("line"), text.alias("text"))


def _bits(s: m.Statement) -> str:
    return " + ".join(f"{1 << i} * ({_has(m.spaced((p,)).removeprefix('(?i)'), 't')})::INT" for i, p in enumerate(s.rows))


def _one(s: m.Statement) -> str:
    title, column = m.spaced(s.titles).removeprefix("(?i)"), (m.spaced(s.columns) if s.columns else m.AMOUNT).removeprefix("(?i)")
    due = "TRUE" if len(s.sectors) == 2 else "doc_id % 3 > 0"
    return f"""
SELECT doc_id, {_q(s.step)} AS step, {due} AS due, f FROM (SELECT doc_id, min((start, CASE WHEN exact THEN 100.0 WHEN partial THEN 85.0 ELSE 80.0 END, last)) AS f FROM (
  SELECT doc_id, start, last, bool_or(exact) AS exact, bool_or(partial) AS partial FROM (
    SELECT r.doc_id, r.start, r.last, e.exact, e.partial FROM (
      SELECT doc_id, start, min(page) FILTER (state = 0) AS last, bool_or(col) AS col FROM (
        SELECT doc_id, start, page, col, CASE WHEN stopped THEN -1 ELSE list_reduce([{(1 << len(s.rows)) - 1}] || flatten(list(hits) OVER (PARTITION BY doc_id, start ORDER BY page)), lambda a, h: a - ((a & h) & -(a & h))) END AS state FROM (
          SELECT t.doc_id, t.page AS start, p.page, coalesce(list(h.bits ORDER BY h.pos) FILTER (h.pos >= CASE WHEN p.page = t.page THEN 8 ELSE 0 END AND h.pos < CASE WHEN p.page = t.page THEN 68 ELSE 60 END), []) AS hits, bool_or(h.col) AS col,
            coalesce(bool_or(bool_or(x.page IS NOT NULL AND p.page > t.page)) OVER (PARTITION BY t.doc_id, t.page ORDER BY p.page), FALSE) AS stopped
          FROM (SELECT DISTINCT doc_id, page FROM chunks WHERE {_has(title, "chunk")}) t JOIN (SELECT DISTINCT doc_id, page FROM n) p ON p.doc_id = t.doc_id AND p.page BETWEEN t.page AND t.page + 5
          JOIN (SELECT doc_id, page, pos, {_bits(s)} AS bits, {_has(column, "t")} AS col FROM n) h ON h.doc_id = p.doc_id AND h.page = p.page LEFT JOIN x ON x.doc_id = p.doc_id AND x.page = p.page
          GROUP BY t.doc_id, t.page, p.page)) GROUP BY ALL) r
    JOIN y e ON e.doc_id = r.doc_id AND e.page BETWEEN r.start AND r.last WHERE r.col AND r.last IS NOT NULL) GROUP BY ALL) GROUP BY 1) RIGHT JOIN documents USING (doc_id)"""


@query(f"""
WITH l AS (SELECT doc_id, CAST(i // {PER_PAGE} AS INT) AS page, i % {PER_PAGE} AS line,
  CASE WHEN i % 4 < 3 THEN [{", ".join(_q(x) for x in PLANTED)}][1 + CAST((doc_id + i + (i // {PER_PAGE}) * (doc_id % 5)) % {len(PLANTED)} AS INT)] ELSE translate(parts[i // 4 + 1], '0123456789', '') END AS text
  FROM (SELECT doc_id, parts, unnest(range(0, 4 * len(parts))) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
n AS (SELECT doc_id, page, lower({_PLAIN % "translate(text, '–—“”', '--\"\"')"}) AS t, row_number() OVER (PARTITION BY doc_id, page ORDER BY line) - 1 AS pos FROM l WHERE {_PLAIN % "text"} <> ''),
tops AS (SELECT doc_id, page, {_PLAIN % "text"} AS t, row_number() OVER (PARTITION BY doc_id, page ORDER BY line) - 1 AS top FROM l
  WHERE length({_PLAIN % "text"}) >= 3 AND NOT {_has("^(?:" + "|".join([r"(?:exhibit|schedule|table|note|section)\s+\w+\s*", r"\d{1,3}", "[ivxlc]{1,6}", r"page\s+\d+(?:\s+of\s+\d+)?"]) + ")$", _PLAIN % "text")} QUALIFY top < 8),
x AS (SELECT doc_id, page FROM tops GROUP BY ALL HAVING NOT bool_or({_has(m.ALLOWED, "t")}) AND bool_or(top < 3 AND length(t) < 80 AND NOT {_has(m.BREAKS_OFF.removeprefix("(?i)"), "t")} AND {_has(m.EXCLUDED, "t")})),
chunks AS (SELECT doc_id, page, unnest([t, CASE WHEN b IS NOT NULL THEN t || ' ' || b END, CASE WHEN c IS NOT NULL THEN t || ' ' || b || ' ' || c END]) AS chunk
  FROM (SELECT *, lead(t) OVER w AS b, lead(t, 2) OVER w AS c FROM tops WINDOW w AS (PARTITION BY doc_id, page ORDER BY top))),
d AS (SELECT *, CASE doc_id % 4 WHEN 0 THEN (6, 2021) WHEN 1 THEN (6, 2020) WHEN 2 THEN (12, 2020) ELSE (1, 1999) END AS fye, CASE t WHEN 'june 30, 2021' THEN (6, 2021) WHEN 'year ended december 31, 2020' THEN (12, 2020) END AS day FROM n),
y AS (SELECT doc_id, page, coalesce(bool_or(day = fye), FALSE) AS exact, coalesce(bool_or(day <> fye AND (day[1] = fye[1] OR day[2] = fye[2])), FALSE) AS partial FROM d GROUP BY ALL),
f AS ({" UNION ALL ".join(_one(s) for s in m.STATEMENTS)})
SELECT doc_id, step, CASE WHEN NOT due THEN 'NOT APPLICABLE' WHEN f IS NULL THEN 'FAIL' WHEN f[2] = 100 THEN 'PASS' ELSE 'REVIEW' END AS status, CASE WHEN due AND f IS NOT NULL THEN f[2] ELSE 0 END::DOUBLE AS score,
  CASE WHEN due THEN f[1] END AS page, CASE WHEN due THEN f[3] END AS last FROM f
""")
def statement_finder(spark, sf_dir):
    k = F.col("doc_id")
    ends = F.array(*[F.struct(F.lit(a).alias("month"), F.lit(b).alias("year")) for a, b in ((6, 2021), (6, 2020), (12, 2020), (1, 1999))])
    wanted = read(spark, sf_dir, "documents").select("doc_id", F.when(k % 3 == 0, "NONLG").otherwise("LG").alias("sector"), F.get(ends, (k % 4).cast("int")).alias("fye"))
    return m.find_statements(planted_lines(spark, sf_dir), wanted)
