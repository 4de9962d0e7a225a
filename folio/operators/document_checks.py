"""Verdicts on documents from their lines: rows (doc_id, page, line, text), pages and lines from 0.

A document's lines are one window partition, as long as a document is. Where a verdict is the best of several findings, it
is a minimum over (tier, page, line), which Spark combines before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions import dates, names
from folio.functions.text import match_pct
from folio.operators.near_names import best_near
from folio.operators.pages import best_hit

#: Pages and lines looked at, and the shares and scores that pass.
FIRST_PAGES, COVER_PAGES, COVER_LINES, FYE_PAGES, FYE_LINES = 30, 5, 10, 10, 5
PASS_PCT, REVIEW_PCT, NAME_SCORE = 100.0, 90.0, 85.0
TITLE_LINES, TITLE_SPAN = 12, 3
OCR_PAGES, OCR_SHARE, OCR_CHARS = 40, 0.60, 50
LG_STEPS, NONLG_STEPS = ["G3-2", "G3-3", "G3-4", "G3-5"], ["G3-2", "G3-4", "G3-6"]
#: Phrases that place an organisation in a state, # for its name.
STATE_PHRASES = [
    r"# nonprofit corporation", r"# (?:non-?profit|not-?for-?profit)", r"state of #", r"organized (?:under|in) (?:the )?(?:laws? of )?(?:the state of )?#",
    r"incorporated (?:in|under (?:the )?laws? of) (?:the state of )?#", r"(?:domiciled|located|headquartered) in (?:the state of )?#", r"hospitals? in #", r"throughout #",
    r"facilities (?:in|throughout|across) #", r"operates? (?:in|throughout) #", r"# department of (?:health|education|revenue)",
]


def in_reading_order(words: DataFrame) -> DataFrame:
    """line_idx of each line (doc_id, page, x0, y0) by its place on the page: y0, then x0."""
    return words.withColumn("line_idx", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("y0", "x0")) - 1)


def numbered_lines(lines: DataFrame) -> DataFrame:
    """n, the line's place in the document."""
    return lines.withColumn("n", F.row_number().over(Window.partitionBy("doc_id").orderBy("page", "line")))


def sentences(lines: DataFrame) -> DataFrame:
    """Rows (doc_id, sentence, page, last_line, text): lines joined by spaces up to one that ends in . ? or !; the page is that of the last line."""
    line = Window.partitionBy("doc_id").orderBy("page", "line")
    ends = F.col("text").rlike(r"[.?!]\s*$").cast("long")
    of = lines.withColumn("sentence", F.coalesce(F.sum(ends).over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    of = of.groupBy("doc_id", "sentence").agg(F.array_sort(F.collect_list(F.struct("page", "line", "text"))).alias("parts"))
    last = F.element_at("parts", -1)
    return of.select("doc_id", "sentence", last["page"].alias("page"), last["line"].alias("last_line"), F.array_join(F.transform("parts", lambda p: p["text"]), " ").alias("text"))


def entity_name(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (doc_id, status, score, page): the best share of an entity's words (wanted: doc_id, entity) in a line at the top of a cover
    page, or in a sentence of the first pages. A full match on a cover counts before one in a sentence, either before a part."""
    tokens = wanted.select("doc_id", names.entity_tokens(F.col("entity")).alias("tokens"))
    cover = lines.where((F.col("page") < COVER_PAGES) & (F.col("line") < COVER_LINES)).select("doc_id", "page", F.lit(1).alias("tier"), F.col("line").alias("at"), "text")
    told = sentences(lines.where(F.col("page") < FIRST_PAGES)).select("doc_id", "page", F.lit(2).alias("tier"), F.col("sentence").cast("int").alias("at"), "text")
    scored = cover.unionByName(told).join(tokens, "doc_id").withColumn("pct", match_pct(F.col("tokens"), F.col("text"))).where(F.col("pct") >= REVIEW_PCT)
    rank = F.when(F.col("pct") >= PASS_PCT, F.col("tier")).otherwise(3)
    best = scored.groupBy("doc_id").agg(F.min(F.struct(rank.alias("rank"), (-F.col("pct")).alias("less"), "tier", "page", "at")).alias("b"))
    score = F.coalesce(-F.col("b.less"), F.lit(0.0))
    return wanted.select("doc_id").join(best, "doc_id", "left").select("doc_id", F.when(score >= PASS_PCT, "PASS").when(score >= REVIEW_PCT, "REVIEW").otherwise("FAIL").alias("status"), score.alias("score"), "b.page")


def state(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (doc_id, status, score, page): where a document names its state; wanted: doc_id, code, name, and page and line of its entity's name, null if not found.

    In order: a line of the first pages with the state only; the first line with the state at or after the entity's, at most two
    lines on; a phrase that places an organisation in the state; else a failure, scored by the lines between.
    """
    of = numbered_lines(lines).where(F.col("page") < FIRST_PAGES).join(wanted.withColumnsRenamed({"page": "e_page", "line": "e_line"}), "doc_id")
    held = names.has_state(F.col("text"), F.col("code"), F.col("name"))
    phrase = F.concat(*[x for p in [rf"(?i)\b(?:{'|'.join(STATE_PHRASES)})\b".replace(" ", r"\s+").split("#")] for i, part in enumerate(p) for x in ([F.lit(part)] if i == 0 else [F.lit(r"\Q"), F.col("name"), F.lit(r"\E"), F.lit(part)])])
    anchor = F.max(F.when((F.col("page") == F.col("e_page")) & (F.col("line") == F.col("e_line")), F.col("n"))).over(Window.partitionBy("doc_id"))
    of = of.withColumn("far", F.col("n") - anchor).withColumn("far", F.when(held & (F.col("far") >= 0), F.col("far")))
    nearest = F.min("far").over(Window.partitionBy("doc_id"))
    of = of.withColumn("near", F.when(F.col("far") == nearest, F.col("far")))
    tier = F.when(names.names_state_only(F.col("text"), F.col("code"), F.col("name")), 0).when(F.col("near") <= 2, 1).when(F.rlike("text", phrase), 2).when(F.col("near").isNotNull(), 3).when(F.col("e_page").isNull() & held, 4)
    best = best_hit(of, ["doc_id"], tier, ["page", "line"], ["page", "near"])
    score = F.when(F.col("tier") == 0, 100.0).when(F.col("tier") == 1, 100.0 - 5 * F.col("near")).when(F.col("tier") == 2, 95.0).when(F.col("tier") == 3, F.greatest(F.lit(0.0), 100.0 - 5 * F.col("near"))).when(F.col("tier") == 4, 50.0).otherwise(0.0)
    passed = (F.col("tier") == 0) | (F.col("tier") == 2) | ((F.col("tier") == 1) & (F.col("near") < 2))
    return wanted.select("doc_id").join(best, "doc_id", "left").select("doc_id", F.when(passed, "PASS").when(F.col("tier") == 1, "REVIEW").otherwise("FAIL").alias("status"), score.cast("double").alias("score"), "page")


def fiscal_year(lines: DataFrame, wanted: DataFrame, statement_pages: DataFrame | None = None) -> DataFrame:
    """Rows (doc_id, status, score, page): where a document's lines give its year end; wanted: doc_id, fye (month, year).

    In order: the latest date of a line on a cover page; of a top line of a statement page (doc_id, page); any date of any line; then
    the same month only, then the same year only.
    """
    of = lines.where(F.col("text").rlike("[0-9]")).withColumn("dates", dates.line_dates(F.col("text"))).where(F.size("dates") > 0).join(wanted, "doc_id")
    pages = of.select("doc_id").limit(0).withColumn("page", F.lit(0)) if statement_pages is None else statement_pages.select("doc_id", "page").distinct()
    of = of.join(pages.withColumn("stated", F.lit(True)), ["doc_id", "page"], "left")
    latest = dates.compare(F.col("fye"), F.get("dates", F.lit(0))) == "EXACT"
    any_is = lambda kind: F.exists("dates", lambda d: dates.compare(F.col("fye"), d) == kind)
    tier = F.when((F.col("page") < FYE_PAGES) & latest, 0).when(F.coalesce("stated", F.lit(False)) & (F.col("line") < FYE_LINES) & latest, 1).when(any_is("EXACT"), 2).when(any_is("MONTH"), 3).when(any_is("YEAR"), 4)
    best = best_hit(of, ["doc_id"], tier, ["page", "line"], ["page"])
    score = F.when(F.col("tier") <= 1, 100.0).when(F.col("tier") == 2, 90.0).when(F.col("tier") == 3, 80.0).when(F.col("tier") == 4, 70.0).otherwise(0.0)
    return wanted.select("doc_id").join(best, "doc_id", "left").select("doc_id", F.when(F.col("tier") <= 1, "PASS").when(F.col("tier").isNotNull(), "REVIEW").otherwise("FAIL").alias("status"), score.alias("score"), "page")


def auditor(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (doc_id, status, score): whether a document names its auditor; wanted: doc_id, auditor as 'firm (contact)'.

    A line that holds the firm's normal name scores 100; else the best likeness of the firm's or the contact's name to a line counts.
    """
    parts = names.firm_and_contact(F.col("auditor"))
    asked = wanted.select("doc_id", names.auditor_name(parts["firm"]).alias("firm"), names.auditor_name(parts["contact"]).alias("contact"))
    # no filter on own: it would be pushed below the projection, and each line's name be made twice
    of = lines.select("doc_id", names.auditor_name(F.col("text")).alias("own")).join(asked, "doc_id")
    found = best_near(of, "doc_id", ["firm", "contact"], "own", NAME_SCORE)
    return wanted.select("doc_id").join(found, "doc_id", "left").select("doc_id", F.when(F.col("score").isNotNull(), "PASS").otherwise("FAIL").alias("status"), F.coalesce("score", F.lit(0.0)).alias("score"))


def title_windows(lines: DataFrame, patterns: dict[str, str], top: int = TITLE_LINES, span: int = TITLE_SPAN) -> DataFrame:
    """Rows (doc_id, page, title, line, span): for each pattern the first one to `span` neighbouring top lines of a page that hold it."""
    head = lines.where(F.col("line") < top)
    by = Window.partitionBy("doc_id", "page").orderBy("line")
    joined, windows = F.col("text"), []
    for k in range(span):
        if k:
            joined = F.concat_ws(" ", joined, F.lead("text", k).over(by))
        there = F.lit(True) if k == 0 else F.lead("text", k).over(by).isNotNull()
        windows.append(F.when(there, F.struct(F.lit(k + 1).alias("span"), F.lower(F.trim(F.regexp_replace(joined, r"[\s ]+", " "))).alias("chunk"))))
    cut = head.withColumn("w", F.array_compact(F.array(*windows))).select("doc_id", "page", "line", F.explode("w").alias("w")).select("doc_id", "page", "line", "w.*")
    hits = cut.select("*", F.explode(F.array_compact(F.array(*[F.when(F.col("chunk").rlike(p), F.lit(t)) for t, p in patterns.items()]))).alias("title"))
    return hits.groupBy("doc_id", "page", "title").agg(F.min(F.struct("line", "span")).alias("b")).select("doc_id", "page", "title", "b.line", "b.span")


def requires_ocr(pages: DataFrame) -> DataFrame:
    """Rows (doc_id, ocr): whether most of a document's pages with content are images only; pages: doc_id, page, n_chars, raster.

    At most OCR_PAGES evenly spaced pages of a document are looked at. Blank pages don't count.
    """
    n = F.count("*").over(Window.partitionBy("doc_id"))
    at = F.ceil(F.col("page") * OCR_PAGES / F.col("n"))
    chosen = (F.col("n") <= OCR_PAGES) | ((at < OCR_PAGES) & (F.floor(at * F.col("n") / OCR_PAGES) == F.col("page")))
    text = F.col("n_chars") >= OCR_CHARS
    of = pages.withColumn("n", n).withColumn("chosen", chosen).groupBy("doc_id").agg(F.count_if(F.col("chosen") & ~text & F.col("raster")).alias("scanned"), F.count_if(F.col("chosen") & (text | F.col("raster"))).alias("seen"))
    return of.select("doc_id", ((F.col("seen") > 0) & (F.col("scanned") >= OCR_SHARE * F.col("seen"))).alias("ocr"))


def relabel(steps: DataFrame, ocr: DataFrame) -> DataFrame:
    """Steps (doc_id, step, status) with OCR REQUIRED for what failed in documents that need it (doc_id, ocr)."""
    out = steps.join(ocr, "doc_id", "left")
    return out.select("doc_id", "step", F.when(F.coalesce("ocr", F.lit(False)) & F.col("status").isin("FAIL", "NOT FOUND"), "OCR REQUIRED").otherwise(F.col("status")).alias("status"))


def third_gate(steps: DataFrame, sectors: DataFrame) -> DataFrame:
    """Rows (doc_id, gate) of steps (doc_id, step, status) and sectors (doc_id, sector): G3-1 passes at once; LG by its own steps or the others'."""
    s = F.col("status")

    def judged(own: list[str]) -> Column:
        mine = F.col("step").isin(own)
        bad, review, good = F.bool_or(F.when(mine, s.isin("FAIL", "NOT FOUND", "NOT APPLICABLE"))), F.bool_or(F.when(mine, s == "REVIEW")), F.bool_and(F.when(mine, s == "PASS"))
        return F.when(good.isNull() | bad, "FAIL").when(review, "REVIEW").when(good, "PASS").otherwise("REVIEW")

    of = steps.groupBy("doc_id").agg(F.coalesce(F.bool_or((F.col("step") == "G3-1") & s.isin("PASS", "REVIEW")), F.lit(False)).alias("one"), judged(LG_STEPS).alias("lg"), judged(NONLG_STEPS).alias("other"))
    both = reduce(lambda a, b: a | b, [F.col(c) == "PASS" for c in ("lg", "other")])
    lg = F.when(both, "PASS").when((F.col("lg") == "REVIEW") | (F.col("other") == "REVIEW"), "REVIEW").otherwise("FAIL")
    return of.join(sectors, "doc_id").select("doc_id", F.when(F.col("one"), "PASS").when(F.upper("sector") == "LG", lg).otherwise(F.col("other")).alias("gate"))


def modal_offset(found: DataFrame) -> DataFrame:
    """The most frequent offset of each document (doc_id, at, offset); of equally frequent ones the one seen first."""
    counts = found.groupBy("doc_id", "offset").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    return counts.groupBy("doc_id").agg(F.max_by("offset", F.struct("n", -F.col("first"))).alias("offset"))


def group_rows(words: DataFrame, tolerance: float = 6.0) -> DataFrame:
    """Adds row: words (doc_id, page, word_id, x0, y0) whose y0 is within the tolerance of the running mean of their row, in the order of y0 and x0.

    The mean changes with each word, so a page is walked in order; a group is one page.
    """

    def run(page):
        page = page.sort_values(["y0", "x0", "word_id"], kind="stable")
        rows, mean, n, row = [], None, 0, -1
        for y in page["y0"]:
            if mean is None or abs(y - mean) > tolerance:
                mean, n, row = y, 1, row + 1
            else:
                mean, n = (mean * n + y) / (n + 1), n + 1
            rows.append(row)
        return page.assign(row=rows)

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema)
    return words.groupBy("doc_id", "page").applyInPandas(run, f"{kind}, row int")


def indented_lines(words: DataFrame, gap: float = 10.0, unit: str = "  ") -> DataFrame:
    """Rows (doc_id, page, row, text): words (…, text) of each row by x0, indented by the place of the row's first x0 among the page's clusters of them."""
    from folio.operators.gates import islands

    rows = group_rows(words).groupBy("doc_id", "page", "row").agg(F.array_sort(F.collect_list(F.struct("x0", "word_id", "text"))).alias("w"))
    rows = rows.select("doc_id", "page", "row", F.get("w", F.lit(0))["x0"].alias("x0"), F.array_join(F.transform("w", lambda x: x["text"]), " ").alias("line"))
    level = islands(rows, ["doc_id", "page"], "x0", gap)
    return rows.join(level, ["doc_id", "page", "x0"]).select("doc_id", "page", "row", F.concat(F.expr(f"repeat('{unit}', cast(island as int))"), "line").alias("text"))
