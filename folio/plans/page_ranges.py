"""Queries of the page finders: over the documents' lines, every other one replaced by a line of a statement that hangs on its place, and
over the events as pages whose tests hang on their numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators import page_ranges as m
from folio.plans.catalogue import query, read

#: Lines that are planted, three to a page with the text's own.
PLANTED = [
    "Statement of Net Position", "Total assets 1,234,567", "Total liabilities 12,345", "Net position", "Component units", "Page 2 of 3", "Statement of Activities", "Program revenues",
    "General revenues", "Governmental activities", "Table of contents", "Assets", "Charges for services", "Condensed statement of activities", "Unrestricted", "Statement of Net Position and assets",
]


def planted_pages(spark, sf_dir):
    lines = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("i", "line"))
    own = F.get(F.array(*[F.lit(x) for x in PLANTED]), ((F.col("doc_id") * 7 + F.col("i") * 13 + F.floor(F.col("i") / 6)) % len(PLANTED)).cast("int"))
    lines = lines.withColumn("line", F.when(F.col("i") % 3 < 2, own).otherwise(F.col("line")))
    pages = lines.groupBy("doc_id", (1 + F.floor(F.col("i") / 3)).cast("int").alias("page")).agg(F.array_sort(F.collect_list(F.struct("i", "line"))).alias("x"))
    return pages.select("doc_id", "page", F.array_join(F.transform("x", lambda x: x["line"]), "\n").alias("text"))


def _first(n: int) -> str:
    return f"array_to_string(string_split(text, chr(10))[1:{n}], chr(10))"


def _has(pattern: str, text: str = "text") -> str:
    quoted = pattern.replace("'", "''").replace(r"\A", "^")
    return f"regexp_matches({text}, '{quoted}')"


_PAGES = f"""
l AS (SELECT doc_id, i, CASE WHEN i % 3 < 2 THEN {PLANTED}[1 + CAST((doc_id * 7 + i * 13 + i // 6) % {len(PLANTED)} AS INT)] ELSE parts[i + 1] END AS line
  FROM (SELECT doc_id, parts, unnest(range(0, len(parts))) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
p AS (SELECT doc_id, CAST(1 + i // 3 AS INT) AS page, string_agg(line, chr(10) ORDER BY i) AS text FROM l GROUP BY ALL)
"""
_TESTS = f"""
t AS (SELECT doc_id, page, {_has(m.SNP_EXCLUDED, _first(10))} AS excluded, {_has(m.SNP_TITLE, _first(25))} AS title, {_has(m.phrases("assets"))} AS assets,
  {" + ".join(f"{1 << i} * {_has(p)}::INT" for i, p in enumerate(m.SNP_ROWS))} AS bits,
  {_has(m.SNP_UNIT, "ltrim(text, chr(10))")} OR {_has(m.SNP_GOES_ON, _first(15))} OR {_has(m.PAGE_OF, _first(15))} AS goes_on,
  len(list_filter(string_split({_first(25)}, chr(10)), lambda x: {_has(m.SOA_TITLE, "x")} AND NOT {_has(m.SOA_FALSE, "x")})) > 0 AND {" + ".join(f"{_has(p)}::INT" for p in m.SOA_KEYWORDS)} >= 2 AS activities,
  {" OR ".join(_has(p, _first(30)) for p in m.SOA_GOES_ON)} AS activities_on FROM p)
"""


@query(f"""
WITH RECURSIVE {_PAGES}, {_TESTS},
s AS (
  SELECT doc_id, 'SNP' AS statement, 0 AS page, 0 AS state, FALSE AS taken FROM (SELECT DISTINCT doc_id FROM t)
  UNION ALL SELECT doc_id, 'SOA', 0, 0, FALSE FROM (SELECT DISTINCT doc_id FROM t)
  UNION ALL
  SELECT s.doc_id, s.statement, t.page,
    CASE WHEN s.statement = 'SOA' THEN CASE s.state WHEN 0 THEN CASE WHEN activities AND NOT excluded THEN 1 ELSE 0 END WHEN 1 THEN CASE WHEN NOT title AND activities_on THEN 1 ELSE 2 END ELSE 2 END
         WHEN s.state = 0 THEN CASE WHEN NOT excluded AND title AND assets THEN 1 + bits ELSE 0 END
         WHEN s.state < 8 THEN CASE WHEN excluded THEN s.state WHEN bits > 0 THEN 1 + ((s.state - 1) | bits) WHEN goes_on THEN 8 ELSE 9 END
         WHEN s.state = 8 THEN CASE WHEN excluded OR goes_on THEN 8 ELSE 9 END ELSE 9 END,
    CASE WHEN s.statement = 'SOA' THEN s.state = 0 AND activities AND NOT excluded OR s.state = 1 AND NOT title AND activities_on
         WHEN s.state = 0 THEN NOT excluded AND title AND assets WHEN s.state < 8 THEN NOT excluded AND (bits > 0 OR goes_on) WHEN s.state = 8 THEN NOT excluded AND goes_on ELSE FALSE END
  FROM s JOIN t ON t.doc_id = s.doc_id AND t.page = s.page + 1
)
SELECT doc_id, statement, min(page) AS first_page, max(page) AS last_page, count(*) AS n_pages FROM s WHERE taken GROUP BY ALL
""")
def statement_page_ranges(spark, sf_dir):
    taken = m.statement_pages(planted_pages(spark, sf_dir), first_page=1, statements=("SNP", "SOA"))
    return m.ranges(taken, ["doc_id", "statement"])


_FLAGS = {"excluded": (11, 3), "anchor": (5, 1), "complete": (7, 2), "stop": (23, 4), "titled_on": (6, 5), "overflow": (9, 0), "goes_on": (2, 1), "next_title": (29, 6)}


@query(f"""
WITH RECURSIVE p AS (SELECT user_id AS doc_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS page, {", ".join(f"event_id % {n} = {k} AS {name}" for name, (n, k) in _FLAGS.items())} FROM events),
s AS (
  SELECT DISTINCT doc_id, kind, CAST(0 AS BIGINT) AS page, 0 AS state, FALSE AS taken FROM p, (VALUES ('governmental'), ('proprietary')) AS k(kind)
  UNION ALL
  SELECT s.doc_id, s.kind, p.page,
    CASE s.state WHEN 3 THEN 3
      WHEN 0 THEN CASE WHEN NOT excluded AND anchor THEN CASE WHEN complete THEN 2 ELSE 1 END ELSE 0 END
      ELSE CASE WHEN excluded OR stop OR next_title THEN 3 WHEN s.state = 1 AND titled_on THEN CASE WHEN complete THEN 2 ELSE 1 END
                WHEN overflow THEN CASE WHEN NOT complete THEN 1 WHEN s.kind = 'governmental' THEN 3 ELSE 2 END
                WHEN s.state = 1 AND goes_on THEN CASE WHEN complete THEN 2 ELSE 1 END ELSE 3 END END,
    CASE s.state WHEN 3 THEN FALSE WHEN 0 THEN NOT excluded AND anchor ELSE NOT (excluded OR stop OR next_title) AND (s.state = 1 AND (titled_on OR goes_on) OR overflow) END
  FROM s JOIN p ON p.doc_id = s.doc_id AND p.page = s.page + 1
)
SELECT doc_id, kind, CAST(page AS BIGINT) AS page FROM s WHERE taken
""")
def fund_statement_walk(spark, sf_dir):
    """Numbering the events of a user makes the pages of this query; the walk itself goes by blocks."""
    from pyspark.sql import Window

    flags = {name: F.col("event_id") % n == k for name, (n, k) in _FLAGS.items()}
    pages = read(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).cast("long").alias("page"), *[c.alias(n) for n, c in flags.items()])
    own = {name: F.col(name) for name in flags}
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), m.fund_step(own, k == "governmental").alias("s")) for k in ("governmental", "proprietary")])).alias("x")
    return m.taken_pages(pages.select("doc_id", "page", kinds).select("doc_id", "x.kind", "page", "x.s.to", "x.s.take"), ["doc_id", "kind"])
