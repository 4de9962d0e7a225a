"""Where a document's financial statements stand: rows (doc_id, page, line, text), pages and lines from 0; blank lines don't count.

A statement starts on a page whose top has its title. Its rows are looked for line by line, on at most SPAN_PAGES pages: a line takes the
first kind of row that is still missing and that it shows, so the kinds still missing are a bitmask that a line may clear one bit of. A line is one number (which kinds
it shows), a page an array of at most TOP_LINES + ROW_LINES of them, made from its lines in one pass; SPAN_PAGES pages come together by a window.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions import dates
from folio.operators.opinions import MARGIN, one_of, plain

#: Lines of a page's top and of a title, lines searched for rows, pages of a statement, scores by the year end that is found.
TOP_LINES, TITLE_SPAN, ROW_LINES, SPAN_PAGES = 8, 3, 60, 6
EXACT, PARTIAL, NONE = 100.0, 85.0, 80.0
#: What a page of another kind says in its first EXCLUDED_LINES lines if they are short and don't break off, and what overrules it.
EXCLUDED_LINES, EXCLUDED_CHARS = 3, 80
EXCLUDED = [
    r"\bcontents?\b", r"\bmanagement(?:'?s)?\s+discussion\s+and\s+analysis\b", r"\bmd\s?&\s?a\b", r"\bnon[-\s]?major\b", r"\bcondensed?\b", r"\bbudget(?:ary)?\b",
    r"\bsupplement(?:ary|al)?\b", r"\bstatistical\b", r"\bfoundation\b",
]
ALLOWED = [r"\bcombined\b", r"\bconsolidated\b", r"\bgroup(?:ed)?\b"]
BREAKS_OFF = r"(?i)(?:[,;]|\b(?:and|or|to|of|in|for|the|a|an)\s*)$"
AMOUNT = r"\$?\s*[0-9,]{3,}"


@dataclass(frozen=True)
class Statement:
    """titles, kinds of rows and columns are patterns in which a space is any white space; without columns an amount will do."""

    step: str
    sectors: tuple[str, ...]
    titles: tuple[str, ...]
    rows: tuple[str, ...]
    columns: tuple[str, ...] = ()


def spaced(patterns: tuple[str, ...]) -> str:
    return one_of([p.replace(" ", r"\s+") for p in patterns])


_LIST = r"[\s,]+(?:and|&)?\s*"
#: Titles, rows and columns of the statements.
STATEMENTS = (
    Statement("G3-1", ("LG", "NONLG"), (r"\bstatements? of cash receipts? (?:and|&) (?:disbursements?|expenditures?)\b",), (r"\breceipts?\b", r"\b(?:disbursements?|expenditures?)\b")),
    Statement(
        "G3-3", ("LG",),
        (r"\bbalances? sheets?\b.*\b(?:govt|governmental?)\b.*\bfunds?\b", r"\bgovernmental funds? balances? sheets?\b", r"current funds?[\s\S]*?balances? sheets?", r"balances? sheets?[\s\S]*?current funds?"),
        (r"\bassets?\b", r"\bliabilit(?:y|ies)\b", r"\bfund balances?\b|\b(?:total )?reserves?\b"),
        (r"\btotal governmental funds?\b", r"\baggregat(?:e|ed) funds?\b", "regulatory basis", "december 31", r"\b20\d{2}\b"),
    ),
    Statement(
        "G3-5", ("LG",), (rf"\bstatements? of revenues?{_LIST}expenditures?{_LIST}changes? in fund balances?\b", r"current funds?[\s\S]*?statements? of operations?[\s\S]*?changes? in funds? balances?"),
        (r"\brevenues?\b", r"\bexpenditures?\b", r"\b(?:increase|decrease|change|net change) in fund balances?\b|\bbalance december 31\b|\bstatutory excess\b|\bfund balances?\b"),
    ),
)


#: A pattern that may fit a few lines but not more lines around them.
_BOUND = re.compile(r"[\^$]|\(\?<?[=!]|\\[AZzGB]")


def _titled(tops: Column, statement: Statement) -> Column:
    """Whether one to TITLE_SPAN neighbouring lines of a page's top have a title. What a line has, longer stretches around it have too, unless the
    pattern is bound to ends, so that the longest stretches do, and only where the whole top has it."""
    title, n = spaced(statement.titles), F.size(tops)
    bound = any(_BOUND.search(p) for p in statement.titles)
    joined = lambda i, k: F.array_join(F.slice(tops, i, F.lit(k)), " ").rlike(title)
    tests = lambda i: reduce(lambda x, y: x | y, [((i + k - 1) <= n) & joined(i, k) for k in range(1, TITLE_SPAN + 1)]) if bound else joined(i, TITLE_SPAN)
    found = F.exists(F.sequence(F.lit(1), n if bound else F.greatest(F.lit(1), n - TITLE_SPAN + 1)), tests)
    return (n > 0) & (found if bound else F.array_join(tops, " ").rlike(title) & found)


def _pages(lines: DataFrame, statements: tuple[Statement, ...]) -> DataFrame:
    """Rows (doc_id, page, hits, columns, ends, other, titled): of each statement, by its place, the kinds of rows that each line shows, whether a line has
    a column and whether the page's top has a title; the year ends on the page; whether its top names another kind of page. Lines are read and shuffled once.
    """
    # blank lines by their raw text: a filter on what is made of it would make it twice
    of = lines.where(F.col("text").rlike("[^\\s\u00a0]")).select("doc_id", "page", "line", plain(F.col("text")).alias("p"))
    low = F.lower(F.when(F.col("p").rlike("[–—“”]"), F.translate("p", "–—“”", '--""')).otherwise(F.col("p")))
    of = of.select("doc_id", "page", "line", F.when((F.length("p") >= 3) & ~F.col("p").rlike(MARGIN), F.col("p")).alias("top"), low.alias("t"))
    bits = [sum((F.col("t").rlike(spaced((p,))).cast("int") * (1 << i) for i, p in enumerate(s.rows)), F.lit(0)) for s in statements]
    column = [F.col("t").rlike(spaced(s.columns) if s.columns else AMOUNT) for s in statements]
    ends = F.when(F.col("t").rlike("[0-9]"), F.transform(dates.line_dates(F.col("t")), lambda d: F.struct(d["month"].alias("month"), d["year"].alias("year"))))
    of = of.select("doc_id", "page", F.struct("line", "top", F.array(*bits).alias("of"), F.array(*column).alias("columns"), ends.alias("ends")).alias("x"))
    of = of.groupBy("doc_id", "page").agg(F.sort_array(F.collect_list("x")).alias("x"))
    tops = F.slice(F.filter(F.transform("x", lambda x: x["top"]), lambda t: t.isNotNull()), 1, TOP_LINES)
    held = lambda k: F.exists("x", lambda x: x["columns"][k])
    hits = F.transform(F.slice("x", 1, TOP_LINES + ROW_LINES), lambda x, i: F.struct(i.alias("at"), x["of"].alias("of")))
    of = of.select(
        "doc_id", "page", tops.alias("tops"), F.filter(hits, lambda h: F.exists(h["of"], lambda b: b > 0)).alias("hits"),
        F.array(*[held(k) for k in range(len(statements))]).alias("columns"),
        F.flatten(F.filter(F.transform("x", lambda x: x["ends"]), lambda e: F.size(e) > 0)).alias("ends"),
    )
    bad = F.exists(F.slice("tops", 1, EXCLUDED_LINES), lambda t: (F.length(t) < EXCLUDED_CHARS) & t.rlike(one_of(EXCLUDED)) & ~t.rlike(BREAKS_OFF))
    other = bad & ~F.exists("tops", lambda t: t.rlike(one_of(ALLOWED)))
    low = F.transform("tops", lambda t: F.lower(t))
    of = of.select("doc_id", "page", "hits", "columns", "ends", other.alias("other"), low.alias("tops"))
    return of.select("doc_id", "page", "hits", "columns", "ends", "other", F.array(*[_titled(F.col("tops"), s) for s in statements]).alias("titled"))


def _left(missing: Column, shown: Column) -> Column:
    """The kinds still missing after a line: the lowest of those that it shows is taken."""
    both = missing.bitwiseAND(shown)
    return missing - both.bitwiseAND(-both)


def find_statements(lines: DataFrame, wanted: DataFrame, statements: tuple[Statement, ...] = STATEMENTS, scanned: DataFrame | None = None) -> DataFrame:
    """Rows (doc_id, step, status, score, page, last); wanted: doc_id (each once), sector, fye (month, year); scanned: doc_id, page of images only.

    The first page with the title, all kinds of rows from below its top to the last page needed, and a column on any page of the statement's counts: PASS if
    one of these pages has the year end, else REVIEW. Rows end before an excluded page. A scanned page with the title ends the search as OCR REQUIRED. Steps of
    another sector are NOT APPLICABLE; no page is FAIL. Cases: null texts are blank; a missing year end matches nothing.
    """
    of = _pages(lines, statements).join(wanted.select("doc_id", "fye"), "doc_id")
    is_ = lambda *kinds: F.exists("ends", lambda e: dates.compare(F.col("fye"), e).isin(*kinds))
    page = F.struct("page", "hits", "columns", is_("EXACT").alias("exact"), is_("MONTH", "YEAR").alias("partial"), "other")
    span = F.collect_list("of").over(Window.partitionBy("doc_id").orderBy("page").rangeBetween(0, SPAN_PAGES - 1))
    of = of.select("doc_id", "page", "titled", page.alias("of")).select("doc_id", F.col("page").alias("start"), "titled", span.alias("span"))
    places = F.filter(F.sequence(F.lit(0), F.lit(len(statements) - 1)), lambda k: F.get("titled", k))
    of = of.select("doc_id", "start", "span", F.explode(places).alias("k")).withColumn("step", F.get(F.array(*[F.lit(s.step) for s in statements]), F.col("k")))
    if scanned is None:
        of = of.withColumn("image", F.lit(None).cast("boolean"))
    else:
        scans = scanned.select("doc_id", F.col("page").alias("start")).distinct()
        of = of.join(scans.withColumn("image", F.lit(True)), ["doc_id", "start"], "left")

    def seen_from(p: Column) -> Column:
        """A page of a statement: rows count from below the first page's top."""
        first = F.when(p["page"] == F.col("start"), TOP_LINES).otherwise(0)
        inside = F.filter(p["hits"], lambda h: (h["at"] >= first) & (h["at"] < first + ROW_LINES))
        shown = F.filter(F.transform(inside, lambda h: F.get(h["of"], F.col("k"))), lambda b: b > 0)
        return F.struct(p["page"].alias("page"), shown.alias("shown"), F.get(p["columns"], F.col("k")).alias("column"), p["exact"].alias("exact"), p["partial"].alias("partial"), (p["other"] & (p["page"] > F.col("start"))).alias("stop"))

    of = of.select("doc_id", "step", "start", "k", "image", F.transform(F.sort_array("span"), seen_from).alias("pages"))
    stop = F.array_min(F.transform(F.filter("pages", lambda p: p["stop"]), lambda p: p["page"]))
    of = of.withColumns({"own": F.filter("pages", lambda p: stop.isNull() | (p["page"] < stop)), "all": F.get(F.array(*[F.lit((1 << len(s.rows)) - 1) for s in statements]), F.col("k"))})
    walk = lambda a, p: F.when(a["missing"] == 0, a).otherwise(F.struct(F.aggregate(p["shown"], a["missing"], _left).alias("missing"), p["page"].alias("last")))
    of = of.withColumn("end", F.aggregate("own", F.struct(F.col("all").alias("missing"), F.col("start").alias("last")), walk))
    found = F.coalesce("image", F.lit(False)) | ((F.col("end.missing") == 0) & F.exists("pages", lambda p: p["column"]))
    seen = lambda c: F.exists("own", lambda p: (p["page"] <= F.col("end.last")) & p[c])
    score = F.when(F.col("image"), 0.0).when(seen("exact"), EXACT).when(seen("partial"), PARTIAL).otherwise(NONE)
    best = of.where(found).groupBy("doc_id", "step").agg(F.min(F.struct("start", score.alias("score"), F.when(F.col("image"), F.col("start")).otherwise(F.col("end.last")).alias("last"))).alias("b"))
    steps = F.array(*[F.struct(F.lit(s.step).alias("step"), F.array(*[F.lit(x) for x in s.sectors]).alias("sectors")) for s in statements])
    asked = wanted.select("doc_id", "sector", F.explode(steps).alias("s")).select("doc_id", "s.step", F.coalesce(F.array_contains("s.sectors", F.upper("sector")), F.lit(False)).alias("due"))
    status = F.when(~F.col("due"), "NOT APPLICABLE").when(F.col("b").isNull(), "FAIL").when(F.col("b.score") == 0, "OCR REQUIRED").when(F.col("b.score") == EXACT, "PASS").otherwise("REVIEW")
    kept = lambda c: F.when(F.col("due"), F.col(c))
    return asked.join(best, ["doc_id", "step"], "left").select("doc_id", "step", status.alias("status"), F.coalesce(kept("b.score"), F.lit(0.0)).alias("score"), kept("b.start").alias("page"), kept("b.last").alias("last"))
