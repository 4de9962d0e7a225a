"""The auditor's opinion in a document's lines: rows (doc_id, page, line, text), pages and lines from 0; blank lines don't count.

A report page has the report's title above its text. Its section is what follows the heading of the opinion, or the sentence that gives it,
up to the next heading, at most SECTION_LINES lines of SECTION_PAGES pages. Sections are cut by windows over (document, report page), so
that no task walks a document; a section is an array of at most SECTION_LINES lines from there on. What is best of a document's sections is
a minimum or maximum, which Spark combines before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions import dates

#: Lines that are looked at above a page's text, lines and pages of a section, lines kept before the sentence that gives the opinion.
TITLE_LINES, SECTION_LINES, SECTION_PAGES, LINES_BEFORE = 15, 40, 3, 2
#: Scores.
SCORES = {"PASS": 100.0, "REVIEW": 90.0, "FAIL": 50.0}
YEAR_SCORE = 80.0
#: Short lines that a page's top is judged without.
MARGINS = [r"(?:exhibit|schedule|table|note|section)\s+\w+\s*", r"\d{1,3}", r"[ivxlc]{1,6}", r"page\s+\d+(?:\s+of\s+\d+)?"]
#: Titles of the report, with the letters that scans confuse.
REPORT = [
    r"\b(?:independent|state)\s+a[ua]dit[o0]r(?:'?s|s'?)?\s*reports?\b",
    r"\breports?\s+of\s+(?:independent|state)\s+a[ua]dit[o0]r(?:s|'?s|s'?)?\b",
    r"\breports?\s+of\s+independent\s+(?:registered\s+public|certified\s+public)\s+accountant(?:s|'?s|s'?)?\b",
]
REPORT_ON_STATEMENTS = [r"audit\s+of\s+the\s+financial\s+statements?"]
BODY = [r"\bwe\s+have\s+audited\b", r"\bin\s+our\s+opinion\b"]
CONTENTS = [r"\btable\s+of\s+contents?\b"]
#: Titles of reports that give no opinion on the statements.
OTHER_REPORTS = [
    r"report\s+on\s+compliance", r"for\s+each\s+major", r"uniform\s+guidance", r"internal\s+control", r"\bcompliance\b", r"other\s+matters?",
    r"(?:federal|state)\s+(?:and\s+(?:federal|state)\s+)?(?:financial\s+assistance\s+)?program", r"(?:federal|state)\s+(?:financial\s+)?award",
    r"schedule\s+of\s+(?:findings|expenditures)", r"single\s+audit",
]
MARGIN = rf"(?i)^(?:{'|'.join(MARGINS)})$"
HEADING = r"^\s*opinions?\b[:\s\-–—]*$"
SENTENCE = r"\bin\s+our\s+opinion\b"
#: Headings that end a section.
STOPS = [
    r"basis\s+for\b.*\bopinions?", r"emphasis\s+of\s+matters?", r"(?:management(?:'?s)?|responsibilit(?:y|ies))\s+.*\bfinancial\s+statement", r"responsibilit(?:y|ies)\s+of\s+management",
    r"auditor(?:'?s|s'?)?\s+responsibilit(?:y|ies)", r"other\s+matters?", r"other\s+information", r"report\s+on\s+other\s+legal", r"other\s+reporting\s+required",
    r"required\s+supplementary\s+information", r"supplementary\s+information", r"report\s+on\s+internal\s+control", r"report\s+on\s+compliance",
]
#: Phrases of opinions.
PASSES = [r"\bpresent(?:s|ed)?\s+fairly\b", r"\btrue\s+and\s+fair\b", r"\bunmodified\b", r"\bunqualified\b"]
REVIEWS = [r"\bqualified\b(?!\s+opinion\s+is\s+not)"]
FAILS = [r"\bdoes\s+not\s+present\s+fairly\b", r"\badverse\b", r"\bdisclaimer\b"]
#: A word of each phrase above, of the opinion's sentence and of the start of a report's text; lines without one aren't searched for the rest.
OPINION_WORDS, SENTENCE_WORDS, BODY_WORDS = ["fair", "adverse", "disclaimer", "unmodified", "qualified"], ["opinion"], ["audited", "opinion"]
#: Bases of accounting that come with an opinion of their own beside the one on general principles, and the headings of both.
REGULATORY = [
    r"regulatory\s+basis", r"prescribed\s+or\s+permitted\s+by\s+the\s+division", r"modified\s+cash\s+basis", r"statutory\s+basis\s+of\s+accounting",
    r"other\s+comprehensive\s+basis\s+of\s+accounting",
]
GENERAL = [r"u\.?s\.?\s+generally\s+accepted\s+accounting\s+principles", r"accounting\s+principles\s+generally\s+accepted"]
REGULATORY_HEAD = [r"opinions?\s+on\s+(?:the\s+)?regulatory\s+basis"]
GENERAL_HEAD = [r"\bopinions?\s+on\b.{0,60}?generally\s+accepted", r"\bopinions?\s+on\b.{0,60}?accounting\s+principles", r"\badverse\s+opinion\b"]
#: What an opinion is called by the words in its phrase, the first that fits.
LABELS = [
    (r"does not present fairly", "Does Not Present Fairly"), (r"present.*fairly", "Present Fairly"), (r"true and fair", "True and Fair"), (r"unmodified", "Unmodified"),
    (r"unqualified", "Unqualified"), (r"qualified", "Qualified"), (r"adverse", "Adverse"), (r"disclaimer", "Disclaimer"),
]


def one_of(patterns: list[str]) -> str:
    return f"(?i)(?:{'|'.join(patterns)})"


def plain(text: Column) -> Column:
    """Runs of white space, no-break spaces among them, as one space; curly apostrophes straight; trimmed. Only texts that have what is replaced are
    searched by patterns."""
    straight = F.when(text.contains("’") | text.contains("‘"), F.translate(text, "’‘", "''")).otherwise(text)
    spaced = reduce(lambda c, x: c | text.contains(x), ["\t", "\n", "\v", "\f", "\r", "\u00a0"], text.contains("  "))
    return F.trim(F.when(spaced, F.regexp_replace(straight, r"[\s\u00a0]{2,}|[\t-\r\u00a0]", " ")).otherwise(straight))


def plain_lines(lines: DataFrame) -> DataFrame:
    """Rows (doc_id, page, line, text): the lines that aren't blank, as plain(), dealt out by page once for all that reads them."""
    there = lines.where(F.col("doc_id").isNotNull() & F.col("page").isNotNull() & F.col("text").rlike(r"[^\s\u00a0]"))
    return there.select("doc_id", "page", "line", plain(F.col("text")).alias("text")).repartition("doc_id", "page")


def unglued(text: Column) -> Column:
    """A plain() text, words parted where a small letter or digit meets a capital, apostrophes closed up."""
    parted = F.regexp_replace(text, r"(?<=[a-z0-9])(?=[A-Z])", " ")
    return F.when(text.contains("'"), F.regexp_replace(parted, r"\s*'\s*", "'")).otherwise(parted)


def top_lines(lines: DataFrame, n: int, word: str) -> DataFrame:
    """Adds top, from 0, to plain_lines(): the first n lines of each page that aren't margins and have three characters or more; pages whose
    lines don't have the word, in large or small letters, are left out."""
    page = Window.partitionBy("doc_id", "page").orderBy("line")
    above, whole = page.rowsBetween(Window.unboundedPreceding, Window.currentRow), page.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = lines.withColumns({"seen": (F.length("text") >= 3) & ~F.col("text").rlike(MARGIN), "has": F.col("text").rlike(f"(?i){word}")})
    seen = seen.withColumns({"top": (F.count(F.when(F.col("seen"), 1)).over(above) - 1).cast("int"), "has": F.max("has").over(whole)})
    return seen.where(F.col("seen") & F.col("has") & (F.col("top") < n)).select(*lines.columns, "top")


def report_pages(lines: DataFrame) -> DataFrame:
    """Rows (doc_id, page) of plain_lines(): pages with the title of a report on the statements; those that say so in full, if a document has any.
    Pages of contents and titles of other reports don't count; a title ends where the report's text begins. Every title has the word report."""
    tops = top_lines(lines, TITLE_LINES, "report").withColumn("t", unglued(F.col("text")))
    whole = Window.partitionBy("doc_id", "page").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    body = F.min(F.when(F.col("t").rlike(one_of(BODY_WORDS)) & F.col("t").rlike(one_of(BODY)), F.col("top"))).over(whole)
    pages = tops.withColumns({"body": body, "x": F.collect_list("t").over(whole)}).where(F.col("top") == 0)
    pages = pages.select("doc_id", "page", F.array_join(F.slice("x", F.lit(1), F.coalesce("body", F.size("x"))), " ").alias("title"))
    held = pages.where(F.col("title").rlike(one_of(REPORT)) & ~F.col("title").rlike(one_of(CONTENTS)) & ~F.col("title").rlike(one_of(OTHER_REPORTS)))
    full = F.col("title").rlike(one_of(REPORT_ON_STATEMENTS))
    held = held.select("doc_id", "page", full.alias("full")).withColumn("any", F.bool_or("full").over(Window.partitionBy("doc_id")))
    return held.where(F.col("full") | ~F.col("any")).select("doc_id", "page")


def sections(lines: DataFrame) -> DataFrame:
    """Rows (doc_id, report, section): the lines of each report page's opinion as an array of (page, line, text), empty where there is none.

    From the first heading of the opinion on; if nothing stands between that and the next heading, from LINES_BEFORE lines before the
    first sentence that gives an opinion.
    """
    lines = plain_lines(lines)
    reports = report_pages(lines)
    cover = reports.select("doc_id", F.col("page").alias("report"), F.explode(F.sequence(F.col("page"), F.col("page") + SECTION_PAGES - 1)).alias("page"))
    of = lines.join(cover, ["doc_id", "page"])
    group = Window.partitionBy("doc_id", "report").orderBy("page", "line")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = lambda c: F.min(F.when(c, F.col("n"))).over(whole)
    of = of.withColumns({"n": F.row_number().over(group), "stop": F.col("text").rlike(rf"(?i)^(?:{'|'.join(STOPS)})\b")})
    of = of.withColumns({"head": first(F.col("text").rlike("(?i)" + HEADING)), "told": first(F.col("text").rlike(one_of(SENTENCE_WORDS)) & F.col("text").rlike("(?i)" + SENTENCE))})
    of = of.withColumns({"after": first(F.col("n") > F.col("head")), "from": F.when(F.col("told").isNotNull(), F.greatest(F.lit(1), F.col("told") - LINES_BEFORE))})
    headed = F.max((F.col("n") == F.col("after")) & ~F.col("stop")).over(whole)
    of = of.withColumn("start", F.when(headed, F.col("after")).otherwise(F.col("from")))
    # the first line of a section that a sentence gives may be a heading itself
    of = of.withColumn("end", first(F.col("stop") & (F.col("n") > F.col("start"))))
    inside = F.col("n").between(F.col("start"), F.col("start") + SECTION_LINES - 1) & (F.col("end").isNull() | (F.col("n") < F.col("end")))
    cut = of.where(inside).groupBy("doc_id", "report").agg(F.array_sort(F.collect_list(F.struct("page", "line", "text"))).alias("section"))
    empty = F.array().cast("array<struct<page:int,line:int,text:string>>")
    cut = cut.withColumn("section", F.col("section").cast("array<struct<page:int,line:int,text:string>>"))
    return reports.withColumnRenamed("page", "report").join(cut, ["doc_id", "report"], "left").withColumn("section", F.coalesce("section", empty))


def operative(cut: DataFrame) -> DataFrame:
    """Adds block and regulatory: where a section of sections() gives an opinion on a regulatory basis beside one on general principles, the
    lines of the former; else the section. Without a heading for the former, the lines that don't speak of the latter."""
    of = cut.withColumn("blob", F.array_join(F.transform("section", lambda x: x["text"]), " "))
    of = of.withColumn("both", F.col("blob").rlike(one_of(REGULATORY)) & F.col("blob").rlike(one_of(GENERAL)))
    at = lambda p: F.when(F.col("both"), F.array_position(F.transform("section", lambda x: x["text"].rlike(one_of(p))), True))
    general = lambda t: t.rlike(one_of(GENERAL_HEAD)) | t.rlike(r"(?i)\badverse\b") | (t.rlike(one_of(FAILS)) & t.rlike(one_of(GENERAL)))
    of = of.withColumns({"own": at(REGULATORY_HEAD), "other": at(GENERAL_HEAD), "rest": F.when(F.col("both"), F.filter("section", lambda x: ~general(x["text"])))})
    rest = F.col("rest")
    size = F.when(F.col("other") > F.col("own"), F.col("other") - F.col("own")).otherwise(F.size("section"))
    block = F.when(~F.col("both"), F.col("section")).when((F.col("own") > 0) & (F.col("own") != F.col("other")), F.slice("section", F.greatest(F.col("own"), F.lit(1)).cast("int"), size.cast("int")))
    block = block.when(F.size(rest) > 0, rest).otherwise(F.col("section"))
    headed = (F.col("own") > 0) & (F.col("own") != F.col("other"))
    return of.select("doc_id", "report", "section", block.alias("block"), (F.col("both") & (headed | (F.size(rest) > 0))).alias("regulatory"))


def _kind(text: Column) -> Column:
    return F.when(text.rlike(one_of(PASSES)), "PASS").when(text.rlike(one_of(REVIEWS)), "REVIEW")


def _label(hit: Column, kind: Column) -> Column:
    phrase = F.lower(F.when(kind == "FAIL", F.regexp_extract(hit, one_of(FAILS), 0)).when(kind == "PASS", F.regexp_extract(hit, one_of(PASSES), 0)).otherwise(F.regexp_extract(hit, one_of(REVIEWS), 0)))
    out = F.when(phrase.rlike(LABELS[0][0]), LABELS[0][1])
    for pattern, label in LABELS[1:]:
        out = out.when(phrase.rlike(pattern), label)
    return out


def opinion(blocks: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (doc_id, status, score, page, classification, until) of the blocks of operative(); wanted: doc_id, each once.

    Report pages count in order. In a block a failing phrase comes before the others, of which the first counts. A pass or failure ends the search; after a review
    only a failing phrase on a later report page changes it, and the last line with a review is the one told. until is the last report page that was
    read, null if all were. Without a report page, a section or a phrase: FAIL, score 0.
    """
    line = lambda x: F.struct(x["page"].alias("page"), x["line"].alias("line"), x["text"].alias("text"))
    having = lambda test: F.filter("said", lambda x: test(x["text"]))
    of = blocks.withColumn("said", F.filter("block", lambda x: x["text"].rlike(one_of(OPINION_WORDS))))
    of = of.withColumns({"fails": having(lambda t: t.rlike(one_of(FAILS))), "others": having(lambda t: _kind(t).isNotNull()), "reviews": having(lambda t: t.rlike(one_of(REVIEWS)))})
    failed, told = F.get("fails", F.lit(0)), F.get("others", F.lit(0))
    last = F.element_at(F.when(F.size("reviews") > 0, F.col("reviews")), -1)
    of = of.select("doc_id", "report", "regulatory", F.when(failed.isNotNull(), F.struct("report", line(failed).alias("at"))).alias("failed"),
                       F.when(failed.isNotNull(), F.struct("report", F.lit("FAIL").alias("kind"), line(failed).alias("at"))).when(told.isNotNull(), F.struct("report", _kind(told["text"]).alias("kind"), line(told).alias("at"))).alias("first"),
                       F.when(last.isNotNull(), F.struct("report", line(last).alias("at"))).alias("last"), F.when(F.col("regulatory"), F.col("report")).alias("basis"))
    best = of.groupBy("doc_id").agg(F.min("first").alias("first"), F.min("failed").alias("failed"), F.max("last").alias("last"), F.min("basis").alias("basis"))
    kind = F.when(F.col("first.kind") != "REVIEW", F.col("first.kind")).when(F.col("failed").isNotNull(), "FAIL").otherwise(F.col("first.kind"))
    hit = F.when(F.col("first.kind") != "REVIEW", F.col("first.at")).when(F.col("failed").isNotNull(), F.col("failed.at")).otherwise(F.col("last.at"))
    until = F.when(F.col("first.kind") != "REVIEW", F.col("first.report")).otherwise(F.col("failed.report"))
    best = best.select("doc_id", kind.alias("status"), hit.alias("hit"), until.alias("until"), "basis")
    score = F.when(F.col("status") == "PASS", SCORES["PASS"]).when(F.col("status") == "REVIEW", SCORES["REVIEW"]).when(F.col("status") == "FAIL", SCORES["FAIL"]).otherwise(0.0)
    label = F.concat(_label(F.col("hit.text"), F.col("status")), F.when(F.col("basis") <= F.coalesce("until", "basis"), " - Regulatory Basis").otherwise(""))
    return wanted.select("doc_id").join(best, "doc_id", "left").select("doc_id", F.coalesce("status", F.lit("FAIL")).alias("status"), score.alias("score"), F.col("hit.page").alias("page"), label.alias("classification"), "until")


def opinion_year(blocks: DataFrame, verdicts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (doc_id, status, score, page): whether the blocks that opinion() read give the year end; wanted: doc_id, fye (month, year).

    In order: a line with the very month and year; a date that runs over lines, told of the first line with its year (and month, if one has
    both); a line with the month or year only. A missing year end, or no block, is a failure.
    """
    read = blocks.join(verdicts.select("doc_id", "until"), "doc_id").where(F.col("until").isNull() | (F.col("report") <= F.col("until")))
    joined = read.groupBy("doc_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("report", "block"))), lambda x: x["block"])).alias("block"))
    of = joined.join(wanted, "doc_id").where(F.col("fye").isNotNull())
    of = of.withColumn("dated", F.transform("block", lambda x: F.struct(x["page"].alias("page"), F.transform(dates.line_dates(x["text"]), lambda d: dates.compare(F.col("fye"), d)).alias("kinds"))))
    found = lambda kinds: F.get(F.filter("dated", lambda x: F.arrays_overlap(x["kinds"], F.array(*[F.lit(k) for k in kinds]))), F.lit(0))
    of = of.withColumns({"exact": found(["EXACT"]), "part": found(["MONTH", "YEAR"])})
    # only documents without the very date in a line are searched over lines, and only if they have the year's last two digits
    joined = F.when(F.col("exact").isNull(), F.array_join(F.transform("block", lambda x: x["text"]), " "))
    of = of.withColumn("joined", joined).withColumn("joined", F.when(F.contains("joined", F.right(F.col("fye.year").cast("string"), F.lit(2))), F.col("joined")))
    across = F.filter(dates.line_dates(F.col("joined")), lambda d: dates.compare(F.col("fye"), d) == "EXACT")
    of = of.withColumn("raw", F.get(across, F.lit(0))["raw"])
    month = F.regexp_extract("raw", r"^\p{L}+", 0)
    year = F.col("fye.year").cast("string")
    on = lambda test: F.get(F.filter("block", test), F.lit(0))["page"]
    place = F.coalesce(on(lambda x: x["text"].contains(year) & F.lower(x["text"]).contains(F.lower(month))), on(lambda x: x["text"].contains(year)), F.get("block", F.lit(0))["page"])
    of = of.select("doc_id", F.when(F.col("exact").isNotNull() | F.col("raw").isNotNull(), "PASS").when(F.col("part").isNotNull(), "REVIEW").alias("status"),
                   F.coalesce(F.col("exact.page"), F.when(F.col("raw").isNotNull(), place), F.col("part.page")).alias("page"))
    score = F.when(F.col("status") == "PASS", SCORES["PASS"]).when(F.col("status") == "REVIEW", YEAR_SCORE).otherwise(0.0)
    return wanted.select("doc_id").join(of, "doc_id", "left").select("doc_id", F.coalesce("status", F.lit("FAIL")).alias("status"), score.alias("score"), "page")
