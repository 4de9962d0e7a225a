"""Queries of the auditor's opinion: over the documents' lines with lines of reports between them that hang on their place, six to a page."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators import opinions as m
from folio.plans.catalogue import query, read
from folio.shared import written

#: Lines that are planted: a title above every other page, the others below; a line's neighbour is seven places on.
TITLES = ["INDEPENDENT AUDITOR ' S REPORT", "comINDEPENDENT AUDITORS’ REPORT", "State Auditor's Reports", "Independent Auditor's Report on the Audit of the Financial Statements", "Report on the Audit of the Financial Statements"]
PLANTED = [
    "Opinions", "In our opinion, the statements present fairly, in all", "year ended June 30,", "Basis for Qualified Opinion", "Qualified opinion of the auditor", "Unmodified Opinion on Regulatory Basis of Accounting",
    "Table of Contents", "Adverse Opinion on U.S. Generally Accepted Accounting Principles", "the balance  sheet as of December 31, 2020", "2021", "Opinion:", "Other Information", "Page 3 of 9",
    "Report on Compliance", "a disclaimer", "we have audited the books", "fiscal year 2022 and 12/31/2019", "in a true and fair way", "Opinion", "the statements, qualified",
]


def planted_lines(spark, sf_dir):
    """Each line of a document comes after three that are planted."""
    lines = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("at", "own"))
    lines = lines.select("doc_id", "own", F.explode(F.sequence(F.col("at") * 4, F.col("at") * 4 + 3)).alias("i"))
    place = lambda k, of: F.get(F.array(*[F.lit(x) for x in of]), (k % len(of)).cast("int"))
    i, doc = F.col("i"), F.col("doc_id")
    text = F.when(i % 12 == 0, place(doc + F.floor(i / 12) * 3, TITLES)).when(i % 4 < 3, place(doc * 5 + i * 7 + F.floor(i / 6) * doc, PLANTED)).otherwise(F.col("own"))
    return lines.select("doc_id", F.floor(i / 6).cast("int").alias("page"), (i % 6).alias("line"), text.alias("text"))


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _has(patterns: list[str] | str, text: str = "text") -> str:
    return f"regexp_matches({text}, {_q('(?i)' + (patterns if isinstance(patterns, str) else '(?:' + '|'.join(patterns) + ')'))})"


_PLAIN = "trim(regexp_replace(translate(%s, '’‘', ''''''), '[\\s ]+', ' ', 'g'))"
#: A review's phrase without the look-ahead, which DuckDB doesn't have.
_REVIEW = rf"({_has(chr(92) + 'bqualified' + chr(92) + 'b')} AND NOT {_has('qualified opinion is not')})"
_BLOCKS = f"""
l AS (SELECT doc_id, CAST(i // 6 AS INT) AS page, CAST(i % 6 AS INT) AS line,
  CASE WHEN i % 12 = 0 THEN [{", ".join(_q(x) for x in TITLES)}][1 + CAST((doc_id + (i // 12) * 3) % {len(TITLES)} AS INT)]
       WHEN i % 4 < 3 THEN [{", ".join(_q(x) for x in PLANTED)}][1 + CAST((doc_id * 5 + i * 7 + (i // 6) * doc_id) % {len(PLANTED)} AS INT)] ELSE parts[i // 4 + 1] END AS text
  FROM (SELECT doc_id, parts, unnest(range(0, 4 * len(parts))) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
a AS (SELECT *, regexp_replace({_PLAIN % "regexp_replace(text, '([a-z0-9])([A-Z])', '\\1 \\2', 'g')"}, '\\s*''\\s*', '''', 'g') AS t FROM l
  WHERE length({_PLAIN % "text"}) >= 3 AND NOT {_has("^(?:" + "|".join(m.MARGINS) + ")$", _PLAIN % "text")}),
b AS (SELECT *, min(line) FILTER ({_has(m.BODY, "t")}) OVER (PARTITION BY doc_id, page) AS body FROM a),
c AS (SELECT doc_id, page, string_agg(t, ' ' ORDER BY line) AS title FROM b WHERE body IS NULL OR line < body GROUP BY ALL),
d AS (SELECT doc_id, page AS report, {_has(m.REPORT_ON_STATEMENTS, "title")} AS stated FROM c WHERE {_has(m.REPORT, "title")} AND NOT {_has(m.CONTENTS, "title")} AND NOT {_has(m.OTHER_REPORTS, "title")}),
r AS (SELECT doc_id, report FROM d QUALIFY stated OR NOT bool_or(stated) OVER (PARTITION BY doc_id)),
n AS (SELECT r.doc_id, report, page, line, {_PLAIN % "text"} AS text FROM r JOIN l ON r.doc_id = l.doc_id AND l.page BETWEEN report AND report + 2 WHERE {_PLAIN % "text"} <> ''),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id, report ORDER BY page, line) AS n, {_has("^(?:" + "|".join(m.STOPS) + r")\b")} AS stop, {_has(m.HEADING)} AS head, {_has(m.SENTENCE)} AS told FROM n),
h AS (SELECT doc_id, report, min(n) FILTER (head) AS head, min(n) FILTER (told) AS told FROM o GROUP BY ALL),
s AS (SELECT h.doc_id, h.report, CASE WHEN bool_or(n = h.head + 1 AND NOT stop) THEN h.head + 1 WHEN h.told < 3 THEN 1 ELSE h.told - 2 END AS start FROM o JOIN h USING (doc_id, report) GROUP BY h.doc_id, h.report, h.head, h.told),
e AS (SELECT s.doc_id, s.report, s.start, min(n) FILTER (stop AND n > start) AS stopped FROM o JOIN s USING (doc_id, report) GROUP BY ALL),
g AS (SELECT o.* EXCLUDE (head, told), {_has(m.REGULATORY_HEAD)} AS own, {_has(m.GENERAL_HEAD)} AS other,
  {_has(m.GENERAL_HEAD)} OR {_has(chr(92) + "badverse" + chr(92) + "b")} OR ({_has(m.FAILS)} AND {_has(m.GENERAL)}) AS dropped
  FROM o JOIN e USING (doc_id, report) WHERE n BETWEEN start AND start + 39 AND (stopped IS NULL OR n < stopped)),
x AS (SELECT doc_id, report, {_has(m.REGULATORY, "string_agg(text, ' ' ORDER BY n)")} AND {_has(m.GENERAL, "string_agg(text, ' ' ORDER BY n)")} AS dual, min(n) FILTER (g.own) AS own, min(n) FILTER (g.other) AS other, bool_and(dropped) AS none FROM g GROUP BY ALL),
k AS (SELECT g.doc_id, g.report, g.page, g.line, g.n, g.text, dual AND (x.own <> coalesce(x.other, 0) AND x.own IS NOT NULL OR NOT none) AS regulatory,
  {_has(m.PASSES)} AS passed, {_REVIEW} AS review, {_has(m.FAILS)} AS failed FROM g JOIN x USING (doc_id, report)
  WHERE NOT dual OR CASE WHEN x.own IS NOT NULL AND x.own <> coalesce(x.other, 0) THEN n >= x.own AND (x.other IS NULL OR x.other < x.own OR n < x.other) ELSE none OR NOT dropped END),
p AS (SELECT doc_id, report, min((n, page, text)) FILTER (failed) AS f, min((n, page, text, CASE WHEN passed THEN 'PASS' ELSE 'REVIEW' END)) FILTER (passed OR review) AS h, max((n, page, text)) FILTER (review) AS v, bool_or(regulatory) AS regulatory FROM k GROUP BY ALL),
u AS (SELECT doc_id, min((report, CASE WHEN f IS NOT NULL THEN 'FAIL' ELSE h[4] END, CASE WHEN f IS NOT NULL THEN (f[2], f[3]) ELSE (h[2], h[3]) END)) FILTER (f IS NOT NULL OR h IS NOT NULL) AS first,
  min((report, f[2], f[3])) FILTER (f IS NOT NULL) AS f, max((report, v[2], v[3])) FILTER (v IS NOT NULL) AS v, min(report) FILTER (regulatory) AS basis FROM p GROUP BY 1),
w AS (SELECT doc_id, basis, CASE WHEN first[2] = 'REVIEW' AND f IS NOT NULL THEN 'FAIL' ELSE first[2] END AS status, CASE WHEN first[2] <> 'REVIEW' THEN first[3][1] WHEN f IS NOT NULL THEN f[2] ELSE v[2] END AS page,
  CASE WHEN first[2] <> 'REVIEW' THEN first[3][2] WHEN f IS NOT NULL THEN f[3] ELSE v[3] END AS text, CASE WHEN first[2] <> 'REVIEW' THEN first[1] ELSE f[1] END AS until FROM u)
"""
_LABEL = "CASE " + " ".join(f"WHEN {_has(p, 'phrase')} THEN {_q(label)}" for p, label in m.LABELS) + " END"


@query(f"""
WITH {_BLOCKS},
y AS (SELECT *, lower(CASE status WHEN 'FAIL' THEN regexp_extract(text, {_q(m.one_of(m.FAILS))}) WHEN 'PASS' THEN regexp_extract(text, {_q(m.one_of(m.PASSES))}) WHEN 'REVIEW' THEN 'qualified' END) AS phrase FROM w)
SELECT q.doc_id, coalesce(status, 'FAIL') AS status, CASE status WHEN 'PASS' THEN 100.0 WHEN 'REVIEW' THEN 90.0 WHEN 'FAIL' THEN 50.0 ELSE 0.0 END::DOUBLE AS score, page,
  {_LABEL} || CASE WHEN basis <= coalesce(until, basis) THEN ' - Regulatory Basis' ELSE '' END AS classification, until FROM documents q LEFT JOIN y USING (doc_id)
""")
def opinion_check(spark, sf_dir):
    blocks = m.operative(m.sections(planted_lines(spark, sf_dir)))
    return m.opinion(blocks, read(spark, sf_dir, "documents"))


#: What the planted dates say, by line: whole, or the part that a line holds.
_WHOLE = "CASE k.text WHEN 'the balance sheet as of December 31, 2020' THEN (12, 2020) WHEN 'fiscal year 2022 and 12/31/2019' THEN (12, 2019) END"


@query(f"""
WITH {_BLOCKS},
z AS (SELECT k.doc_id, k.report, n, k.page, k.text, {_WHOLE} AS day, lead(k.text) OVER (PARTITION BY k.doc_id ORDER BY k.report, n) AS next,
  (CASE k.doc_id % 3 WHEN 0 THEN 12 WHEN 1 THEN 6 ELSE 3 END, 2019 + k.doc_id % 4) AS fye FROM k LEFT JOIN w ON k.doc_id = w.doc_id WHERE w.until IS NULL OR k.report <= w.until),
t AS (SELECT doc_id, min((report, n, page)) FILTER (day[1] = fye[1] AND day[2] = fye[2]) AS exact, bool_or(fye[1] = 6 AND fye[2] = 2021 AND text = 'year ended June 30,' AND next = '2021') AS across,
  min((report, n, page)) FILTER (contains(text, fye[2]::VARCHAR) AND fye[1] = 6 AND contains(lower(text), 'june')) AS month_too, min((report, n, page)) FILTER (contains(text, fye[2]::VARCHAR)) AS year, min((report, n, page)) FILTER (day[1] = fye[1] OR day[2] = fye[2]) AS part FROM z GROUP BY 1)
SELECT q.doc_id, CASE WHEN exact IS NOT NULL OR across THEN 'PASS' WHEN part IS NOT NULL THEN 'REVIEW' ELSE 'FAIL' END AS status,
  CASE WHEN exact IS NOT NULL OR across THEN 100.0 WHEN part IS NOT NULL THEN 80.0 ELSE 0.0 END::DOUBLE AS score, CASE WHEN exact IS NOT NULL THEN exact[3] WHEN across THEN coalesce(month_too, year)[3] ELSE part[3] END AS page
FROM documents q LEFT JOIN t USING (doc_id)
""")
def opinion_year_check(spark, sf_dir):
    """Digits of the documents' own lines don't count, so that the planted dates alone decide."""
    lines = planted_lines(spark, sf_dir).withColumn("text", F.when((F.col("page") * 6 + F.col("line")) % 4 < 3, F.col("text")).otherwise(F.regexp_replace("text", "[0-9]+", "")))
    documents = read(spark, sf_dir, "documents")
    # read twice: for the opinion and for its year
    blocks = written(m.operative(m.sections(lines)).select("doc_id", "report", "block", "regulatory"), "blocks")
    k = F.col("doc_id")
    month = F.when(k % 3 == 0, 12).when(k % 3 == 1, 6).otherwise(3)
    wanted = documents.select("doc_id", F.struct(month.alias("month"), (2019 + k % 4).cast("int").alias("year")).alias("fye"))
    return m.opinion_year(blocks, m.opinion(blocks, documents), wanted)
