"""Which pages of a document a statement stands on: an anchor page, and the pages after it until the statement stops or is complete.

Each page is judged alone by tests of its text, and what they say makes it a transition function over a few states (looking for the
anchor, inside, inside and complete, done). Functions compose associatively: FAN pages are composed into one block, blocks again, until a
document is one; then entry states go down the same way, and each page's own state says whether it is taken. So a document of
any length is walked by no task, and a page's text is read where it lies.

Pages are rows (doc_id, page from 1, text); lines end with a line feed. Cases: a null text is a blank page; a page number that is missing is
no page, and the ones around it are neighbours; only the first range of a statement counts; a statement that isn't found has no row.
A keyword that is split between two pages is not seen.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pages or blocks composed into one, and the first page on which a statement can begin.
FAN, FIRST_PAGE = 64, 4


# Composition


def entered(nodes: DataFrame, by: list[str], at: str, fan: int = FAN, largest: int | None = None) -> DataFrame:
    """The rows (by, at, to, ..) with `entry`, the state in which each is entered, starting in state 0 before the smallest `at`.

    to: for each state the state after the row. One group holds `fan` rows; a level of blocks comes for each power of fan up to the largest `at`.
    """
    if largest is None:
        largest = nodes.agg(F.max(at)).first()[0] or 0
    rest = [c for c in nodes.columns if c not in by]
    kids = F.array_sort(F.collect_list(F.struct(F.col(at).alias("at_"), F.struct(*rest).alias("kid_"))))
    blocks = nodes.groupBy(*by, F.floor(F.col(at) / fan).alias("block_")).agg(kids.alias("kids_"))
    if largest < fan:
        blocks = blocks.withColumn("entry", F.lit(0))
    else:
        states = F.sequence(F.lit(0), F.size(F.get("kids_", F.lit(0))["kid_"]["to"]) - 1).cast("array<int>")
        whole = F.aggregate("kids_", states, lambda done, kid: F.transform(done, lambda s: F.get(kid["kid_"]["to"], s)))
        blocks = entered(blocks.withColumn("to", whole), by, "block_", fan, largest // fan)
    start = F.struct(F.col("entry").alias("state"), F.array().cast("array<int>").alias("seen"))
    seen = F.aggregate("kids_", start, lambda done, kid: F.struct(F.get(kid["kid_"]["to"], done["state"]).alias("state"), F.concat(done["seen"], F.array(done["state"])).alias("seen")))["seen"]
    rows = blocks.select(*by, F.explode(F.arrays_zip(F.col("kids_").alias("kid"), seen.alias("entry"))).alias("x"))
    return rows.select(*by, *[F.col("x.kid.kid_")[c].alias(c) for c in rest], F.col("x.entry").alias("entry"))


def taken_pages(steps: DataFrame, by: list[str], fan: int = FAN, largest: int | None = None) -> DataFrame:
    """Rows (by, page) that the automaton takes, from rows (by, page, to, take): for each state the next state and whether the page is taken. largest: the last page, if known."""
    return entered(steps, by, "page", fan, largest).where(F.get("take", F.col("entry"))).select(*by, "page")


def step(*states: list[tuple[Column | None, object, object]]) -> Column:
    """A page's function: for each state a list of (condition, next state, taken), of which the first true one counts; the last has no condition."""

    def chosen(state, i):
        return reduce(lambda out, case: F.when(case[0], F.lit(case[i])).otherwise(out), reversed(state[:-1]), F.lit(state[-1][i]))

    return F.struct(F.array(*[chosen(s, 1) for s in states]).cast("array<int>").alias("to"), F.array(*[chosen(s, 2) for s in states]).alias("take"))


# Tests of a page


def phrases(*alternatives: str) -> str:
    """A pattern of any of the phrases, whole words in any case; * at the end leaves the last word open."""
    return "(?is)" + "|".join(r"\b" + x.rstrip("*").replace(" ", r"\s+") + ("" if x.endswith("*") else r"\b") for x in alternatives)


def openings(*alternatives: str) -> str:
    """The same at the start of a line."""
    return r"(?im)^\s*(?:" + "|".join(x.replace(" ", r"\s+") for x in alternatives) + r")\b"


def head(text: Column, n: int) -> Column:
    return F.substring_index(text, "\n", n)


def tail(text: Column, n: int) -> Column:
    return F.substring_index(text, "\n", -n)


def one_line(text: Column) -> Column:
    """Lines without the space around them, joined by single spaces."""
    return F.trim(F.regexp_replace(text, r"\s*\n\s*", " "))


def titled(text: Column, title: str, n: int = 25) -> Column:
    """Whether the title stands in the first or the last n lines, in a line or over several; banners of turned pages come last."""
    return one_line(head(text, n)).rlike(title) | one_line(tail(text, n)).rlike(title)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


#: Phrases and patterns by which pages are told apart.
AMOUNT = r"[0-9]{1,3}(?:,[0-9]{3})+"
SNP_TITLE = r"(?im)^\s*(?:(?:exhibit\s+[a-z]?\s*[-–—]?\s*)?statement\s+of\s+net\s+pos(?:i)?tion|government[-\s]*wide\s*[-–—]?\s*statement\s+of\s+net\s+pos(?:i)?tion)\b"
SNP_ROWS = (phrases("total assets"), phrases("total liabilit*"), phrases("net position"))
SNP_EXCLUDED = phrases("table of contents?", "foreword", "introduction", r"md\s*(?:&|and)\s*a", "management[\u2018\u2019']?s? discussion (?:&|and) analysis", "budget", "supplemental", "proprietary fund", "statistical", r"non[-\s]?major", "condensed")
SNP_GOES_ON = openings("deferred (?:inflows?|outflows?) of resources", "net position", "restricted (?:for|net position)", "unrestricted", "net (?:investment|restricted|unrestricted)")
SNP_UNIT = r"(?i)\A\s*component\s+unit"
PAGE_OF = r"(?i)\bpage\s+([2-9]|[0-9]{2,})\s+of\s+[0-9]+\b"
SOA_TITLE = phrases("statement of activities", "statement of revenues,? expenses,? and changes in net position", "statement of changes in net position")
SOA_FALSE = phrases("condensed", "analysis of", "following", "summary", "as shown in", "presents information", "designed to provide")
SOA_KEYWORDS = tuple(
    phrases(x)
    for x in (
        "expenses", "program revenues", "functions/programs", r"functions\s*/\s*programs", r"net \(expense\) revenue", "net expense revenue", "charges for services",
        "operating grants and contributions", "capital grants and contributions", "general revenues", "change in net position", "changes in net position",
        "governmental activities", r"business[-\s]*type activities",
    )
)
SOA_GOES_ON = (
    phrases("primary government\\b.*\\bcomponent units?", "component units?\\b.*\\bprimary government", r"net\s*\(?expense\)? revenues?", r"governmental business[-\s]*type"),
    openings("general revenues", "changes? in net position", "net position", "governmental activities", r"business[-\s]*type activities", "primary government", "component units?", "program revenues", "charges for services", "operating grants", "capital grants"),
)
EXCLUDED = phrases("table of contents?", "foreword", "introduction", r"md\s*(?:&|and)\s*a", "management[\u2018\u2019']?s? discussion (?:&|and) analysis", "budget", "statistical", "combining", "supplemental", "schedule", "custodial fund*", "fiduciary", "notes? to")
CONTENTS, RECONCILIATION = r"(?i)\A\s*contents?\b", phrases("reconciliation")
RECONCILED = phrases("amounts reported for governmental activities\\b.*\\bare different because", "reconciliation of (?:the )?(?:balance sheet|statement)", r"net change in fund balances?\s*[-–]\s*governmental funds", r"total (?:fund )?net position\s*[-–]\s*governmental activities")
FOOTER = r"(?im)^.*(?:" + phrases("see (?:accompanying )?notes? to (?:the )?(?:basic )?(?:financial|required)", "the accompanying notes? are an integral part", "notes? are an integral part")[5:] + r").*$\n?"
CONTINUED = r"(?i)\bcont(?:inued\b|\.|'d\b)|\bpage\s+[2-9][0-9]*\s+of\s+[0-9]+\b"
FROM_PREVIOUS = r"(?i)\bcontinued\s+from\s+previous\s+page\b|\(continued\)"
SPACED = r"(?m)^[^\S\n]*[A-Za-z][^\S\n][A-Za-z][^\S\n]+\S"
OTHER_TITLE = r"(?i)\bstatement\s+of\b|\breconciliation\b|\bschedule\b"
OWN_FUND = r"\b(?:proprietary|enterprise|internal\s+service)"
OVERFLOW_NOT = phrases("notes? to", "required supplementary", "supplementary", "statistical", "fiduciary", "balance sheet\\b.{0,60}\\bgovernmental funds", "governmental funds\\b.{0,60}\\bbalance sheet")
OVERFLOW_HEADS = phrases("totals?", r"business[-\s]*type activities", "enterprise funds?", "internal service funds?", "governmental activities", "proprietary funds?", "food service", "nonmajor", "adjustment")
CASH_TRIO = (
    phrases("cash flows? from operating activit*"),
    phrases("net (?:cash|change) (?:used|provided|in cash|from)"),
    r"(?i)\bcash[,\s]+(?:and\s+)?(?:cash\s+)?equivalents?\b[^\n]{0,60}?(?:at\s+)?(?:beginning|end)\s+of\s+(?:the\s+)?(?:fiscal\s+)?(?:year|period)",
)


@dataclass(frozen=True)
class Fund:
    """A fund-level statement. title, going_on, complete and next_title are patterns; stops are (pattern, first lines)."""

    name: str
    title: str
    wants: tuple[str, ...]
    scrambled: tuple[str, ...]
    stops: tuple[tuple[str, int], ...]
    going_on: str
    scrambled_on: tuple[str, ...]
    complete: str
    governmental: bool = False
    not_overflow: str = ""
    amounts: int = 0
    numbers: bool = False
    body: tuple[str, ...] = field(default=())


def _owned(what: str) -> str:
    """A statement's name with a fund's within 60 characters of it, before or after."""
    return f"(?is){what}[^.]{{0,60}}{OWN_FUND}\\b|{OWN_FUND}\\s+funds?\\b[^.]{{0,60}}{what}"


_REVENUES = r"statements?\s+of\s+revenues?,?\s+(?:and\s+)?(?:expens(?:es|e)|expenditures),?\s+and\s+changes\s+in\s+(?:fund\s+)?net\s+(?:pos(?:i)?tion|assets)"
_POSITION, _CASH = r"statements?\s+of\s+(?:fund\s+)?net\s+(?:pos(?:i)?tion|assets)", r"statements?\s+of\s+cash\s+flows?"
_NEXT = r"\b.{0,40}\b"
#: The five statements.
FUNDS = (
    Fund(
        "GOV_BS", r"(?is)balance\s+sheets?\b[^.]{0,120}governmental\s+fund|governmental\s+fund[^.]{0,120}balance\s+sheets?\b", (phrases("assets"), phrases("fund balance*")),
        (r"(?i)t\s*o\s*t\s*a\s*l\s+a\s*s\s*s\s*e\s*t\s*s", r"(?i)t\s*o\s*t\s*a\s*l\s+l\s*i\s*a\s*b\s*i\s*l", r"(?i)f\s*u\s*n\s*d\s+b\s*a\s*l\s*a\s*n\s*c\s*e"),
        ((phrases("reconciliation"), 12), (r"(?is)statement\s+of\s+revenues,?\s+expenditures.*changes\s+in\s+fund\s+balance", 25)),
        r"(?is)balance\s+sheets?\b.{0,60}(?:continued|cont\.?)|\bfund\s+balances?\b|\bliabilit|\btotal\s+assets\b", (phrases("fund balance*"), phrases("total (?:assets|liabilit)*")),
        r"(?is)\bTotal\s+(?:fund\s+balances?|liabilities[^$\n]{0,80}fund\s+balances?)\b", governmental=True, amounts=8,
    ),
    Fund(
        "GOV_IS", r"(?is)statement\s+of\s+revenues,?\s+expenditures|revenues,?\s+expenditures,?\s+and\s+changes\s+in\s+fund\s+balance", (phrases("expenditures"), phrases("revenues")),
        (phrases("expenditures"), phrases("revenues"), phrases("fund balance*"), phrases("governmental fund*")),
        ((phrases("reconciliation"), 12), (r"(?is)statement\s+of\s+net\s+position.{0,60}proprietary|proprietary.{0,60}statement\s+of\s+net\s+position", 25)),
        r"(?is)governmental\s+fund.*(?:continued|cont\.?)|\bexpenditures\b|\bfund\s+balance\b", (phrases("fund balance*"), phrases("expenditures")),
        r"(?i)\bFund\s+balances?\s*[-–,]\s*(?:ending|January|February|March|April|May|June|July|August|September|October|November|December)\b|\bFund\s+balances\b.{0,30}(?:20[0-9][0-9]|\bending\b)|\bNet\s+change\s+in\s+fund\s+balances?\b", governmental=True,
    ),
    Fund(
        "PROP_SNP", _owned(_POSITION), (phrases("assets"), phrases("net (?:position|assets)*")), (phrases("total assets"), phrases("total liabilit*"), phrases("net (?:position|assets)*"), phrases("proprietary fund*")),
        ((r"(?is)statement\s+of\s+revenues,?\s+expenses.*changes.*net\s+position.*proprietary|proprietary.*statement\s+of\s+revenues,?\s+expenses.*changes", 25), (phrases("statement of cash flow*"), 25)),
        r"(?is)proprietary\s+fund.*(?:continued|cont\.?)|\bnet\s+position\b|\bliabilit|\btotal\s+assets\b", (phrases("net position*"), phrases("total (?:assets|liabilit)*")),
        phrases("total (?:fund )?net position"), not_overflow=phrases(r"statement of revenues[,\s]+(?:and )?(?:expenses|expenditures)", "statement of revenues and expenses", "revenues,? expenses,? and changes in (?:fund )?net position", "statement of cash flows?", "operating revenues?", "operating expenses?", "charges for services\\b.{0,40}\\btotal"), numbers=True,
    ),
    Fund(
        "PROP_IS", _owned(_REVENUES), (phrases("expenses"), phrases("net (?:position|assets)*")), (phrases("operating revenues?"), phrases("operating expenses?"), phrases("net position*"), phrases("proprietary fund*")),
        ((phrases("statement of cash flow*"), 25),), r"(?is)proprietary\s+fund.*(?:continued|cont\.?)|\bnet\s+position\b|\boperating\s+(?:revenue|expense)", (phrases("net position*"), phrases("operating (?:revenue|expense)*")),
        phrases(r"net (?:position|assets)\s*[-–]\s*(?:end\w*|begin\w*|of year)", r"net (?:position|assets)\s*,?\s*(?:at )?end of (?:fiscal )?year", "net (?:position|assets) at (?:end|beginning) of (?:fiscal )?year", "change in net (?:position|assets) of business*"), not_overflow=phrases("statement of cash flows?"), numbers=True,
    ),
    Fund(
        "PROP_CFS", _owned(_CASH), (phrases("cash"), phrases("operating activit*")), (phrases("cash (?:flows?|provided|used)"), phrases("operating activit*"), phrases("proprietary fund*")),
        ((phrases("notes? to"), 12), (phrases("fiduciary"), 12), (phrases("balance sheet\\b.{0,40}\\bgovernmental"), 25)), r"(?is)proprietary\s+fund.*(?:continued|cont\.?)|\bcash\s+(?:provided|used|flow)|\bnoncash\b|\breconciliation\s+of\s+(?:operating|net)", (phrases("cash (?:provided|used|flows?)"), phrases("operating activit*")),
        phrases(r"cash (?:and )?(?:cash )?equivalents?(?:\s*[,\-–—]\s*|\s+(?:at\s+)?)end of (?:fiscal )?(?:year|period)", r"cash\s*,\s*cash equivalents?[^\n]{0,80}end of (?:fiscal )?(?:year|period)", r"non[-\s]?cash\b[^\n]{0,50}(?:investing|capital|financ)*", "net (?:increase|decrease) in cash and cash equivalents?", r"supplemental (?:schedule|disclosure) of (?:non[-\s]?cash|cash flow)", "reconciliation of operating (?:income|loss) to net cash"),
        not_overflow=phrases("statement of fiduciary", "notes? to", "required supplementary"), numbers=True, body=CASH_TRIO,
    ),
)


#: All statements that are found.
STATEMENTS = ("SNP", "SOA", *(fund.name for fund in FUNDS))


def _all(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def looks_scrambled(text: Column) -> Column:
    """Three of the first 20 lines of two characters at most, or one of single letters."""
    first = head(text, 20)
    short = F.size(F.filter(F.split(first, "\n"), lambda x: F.length(F.trim(x)) <= 2))
    return (short >= 3) | first.rlike(SPACED)


def fund_flags(fund: Fund, text: Column, before: Column) -> dict[str, Column]:
    """What a page says about a statement; before: the page in front of it."""
    title, scrambled = titled(text, fund.title), looks_scrambled(text)
    reconciles = head(F.regexp_replace(text, FOOTER, ""), 20)
    named = reconciles.rlike(RECONCILIATION) & ~(title & _all([text.rlike(w) for w in fund.wants]))
    excluded = ~scrambled & (text.rlike(RECONCILED) | reconciles.rlike(EXCLUDED) | reconciles.rlike(CONTENTS) | named)
    first40 = head(text, 40)
    anchor = title & (_any([first40.rlike(w) for w in fund.wants]) | first40.rlike(phrases("assets")))
    if fund.amounts:
        anchor &= _count(text, r"\b" + AMOUNT + r"\b") >= fund.amounts
    anchor |= scrambled & _all([text.rlike(w) for w in fund.scrambled])
    if fund.body:
        anchor |= (sum(text.rlike(p).cast("int") for p in fund.body) >= 2) & (_count(text, r"\b" + AMOUNT + r"\b") >= 5)
    stop = _any([head(text, n).rlike(p) for p, n in fund.stops])
    complete = text.rlike(fund.complete)
    if fund.numbers:
        complete &= F.exists(F.split(text, "\n"), lambda x: x.rlike(fund.complete) & x.rlike(AMOUNT))
    money_lines = F.size(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"\$\s*[0-9,]+")))
    on_scrambled = (scrambled | (money_lines >= 3)) & _all([text.rlike(w) for w in fund.scrambled_on])
    other = anchor & ~head(text, 5).rlike(CONTINUED) & ~tail(before, 5).rlike(CONTINUED)
    goes_on = ~excluded & ~stop & (head(text, 15).rlike(FROM_PREVIOUS) | ~other & (head(text, 30).rlike(fund.going_on) | on_scrambled))
    return {"excluded": excluded, "anchor": anchor, "complete": complete, "stop": stop, "titled_on": title & head(text, 6).rlike(CONTINUED), "overflow": overflows(fund, text), "goes_on": goes_on}


def overflows(fund: Fund, text: Column) -> Column:
    """Whether a page holds more columns of the statement before it."""
    lines = F.split(text, "\n")
    joined = lambda n: F.array_join(F.slice(lines, 1, n), " ")
    if fund.governmental:
        total = joined(8).rlike(r"(?i)\btotal\b.{0,80}\bgovernmental\b.{0,40}\bfunds?\b") if fund.name == "GOV_IS" else joined(8).rlike(r"(?i)\btotal\b") & joined(8).rlike(r"(?i)\bfunds?\b")
        early = head(text, 2).contains("$")
        numbers = F.exists(F.slice(lines, 3, 6), lambda x: x.rlike(r"\b[0-9][0-9,]{2,}\b"))
        return total | ~early & ~joined(8).rlike(OTHER_TITLE) & joined(12).rlike(r"(?i)\btotals?\b") & numbers
    forty = F.slice(lines, 1, 40)
    numeric = F.size(F.filter(forty, lambda x: x.rlike(r"\(?-?[0-9][0-9,]{2,}\)?")))
    dashes = F.size(F.filter(forty, lambda x: x.rlike(r"(^|\s)[-–—](\s|$)")))
    return ~joined(12).rlike(fund.not_overflow) & ~joined(12).rlike(OVERFLOW_NOT) & joined(25).rlike(OVERFLOW_HEADS) & ((numeric >= 2) | (dashes >= 3))


def fund_step(f: dict[str, Column], governmental: bool) -> Column:
    """States 0 looking, 1 inside, 2 inside and complete, 3 done."""
    on = F.when(f["complete"], 2).otherwise(1)
    wide = F.when(f["complete"], 3).otherwise(1) if governmental else on
    ends = f["excluded"] | f["stop"] | f.get("next_title", F.lit(False))
    return step(
        [(f["excluded"], 0, False), (f["anchor"], on, True), (None, 0, False)],
        [(ends, 3, False), (f["titled_on"], on, True), (f["overflow"], wide, True), (f["goes_on"], on, True), (None, 3, False)],
        [(ends, 3, False), (f["overflow"], wide, True), (None, 3, False)],
        [(None, 3, False)],
    )


def position_flags(text: Column) -> dict[str, Column]:
    bits = sum(F.when(text.rlike(p), 1 << i).otherwise(0) for i, p in enumerate(SNP_ROWS))
    below = F.regexp_replace(text, r"\A(?:\s*\n)+", "")
    goes_on = below.rlike(SNP_UNIT) | head(text, 15).rlike(SNP_GOES_ON) | head(text, 15).rlike(PAGE_OF)
    title = head(text, 25).rlike(SNP_TITLE)
    return {"excluded": head(text, 10).rlike(SNP_EXCLUDED), "title": title, "anchor": title & text.rlike(phrases("assets")), "rows": bits, "goes_on": goes_on}


def position_step(f: dict[str, Column]) -> Column:
    """The government-wide statement of net position. States 0 looking, 1 + the rows seen as bits (of total assets, liabilities, net
    position) while some are missing, 8 all seen, 9 done. An excluded page is passed over."""
    after = [(f["excluded"], 8, False), (f["goes_on"], 8, True), (None, 9, False)]
    inside = lambda seen: [(f["excluded"], 1 + seen, False), (f["rows"] > 0, 1 + F.lit(seen).bitwiseOR(f["rows"]), True), (f["goes_on"], 8, True), (None, 9, False)]
    return step([(f["excluded"] | ~f["anchor"], 0, False), (None, 1 + f["rows"], True)], *[inside(seen) for seen in range(7)], after, [(None, 9, False)])


def activities_flags(text: Column) -> dict[str, Column]:
    title = F.exists(F.split(head(text, 25), "\n"), lambda x: x.rlike(SOA_TITLE) & ~x.rlike(SOA_FALSE))
    anchor = title & (sum(text.rlike(p).cast("int") for p in SOA_KEYWORDS) >= 2) & ~head(text, 10).rlike(SNP_EXCLUDED)
    return {"anchor": anchor, "stop": head(text, 25).rlike(SNP_TITLE), "goes_on": _any([head(text, 30).rlike(p) for p in SOA_GOES_ON])}


def activities_step(f: dict[str, Column]) -> Column:
    """The government-wide statement of activities. States 0 looking, 1 inside, 2 done."""
    return step([(f["anchor"], 1, True), (None, 0, False)], [(f["stop"], 2, False), (f["goes_on"], 1, True), (None, 2, False)], [(None, 2, False)])


def page_tests(pages: DataFrame, first_page: int = FIRST_PAGE, statements: Iterable[str] = STATEMENTS) -> tuple[DataFrame, dict[str, list[str]]]:
    """The pages from first_page on with what each says about each of the statements, as columns STATEMENT_test, and the tests' names."""
    own = pages.where(F.col("page") >= first_page).select("doc_id", "page", F.regexp_replace(F.coalesce("text", F.lit("")), r"\n\z", "").alias("text"))
    funds = [(i, fund) for i, fund in enumerate(FUNDS) if fund.name in statements]
    if funds:
        last = own.select("doc_id", (F.col("page") + 1).alias("page"), tail(F.col("text"), 5).alias("before"))
        own = own.join(last, ["doc_id", "page"], "left").withColumn("before", F.coalesce("before", F.lit("")))
    text = F.col("text")
    found = {name: flags(text) for name, flags in (("SNP", position_flags), ("SOA", activities_flags)) if name in statements}
    for i, fund in funds:
        found[fund.name] = fund_flags(fund, text, F.col("before"))
        found[fund.name]["next_title"] = titled(text, FUNDS[i + 1].title) if i + 1 < len(FUNDS) else F.lit(False)
    columns = [c.alias(f"{name}_{test}") for name, tests in found.items() for test, c in tests.items()]
    return own.select("doc_id", "page", *columns), {name: list(tests) for name, tests in found.items()}


def statement_pages(pages: DataFrame, first_page: int = FIRST_PAGE, fan: int = FAN, statements: Iterable[str] = STATEMENTS) -> DataFrame:
    """Rows (doc_id, statement, page) of the pages that hold each of the statements, from rows (doc_id, page, text). Each is found by its
    own tests, so only those of the wanted ones are made, and the last page is read off the pages before any is."""
    statements = set(statements)
    if unknown := statements - set(STATEMENTS):
        raise ValueError(f"no such statements: {sorted(unknown)}")
    largest = pages.agg(F.max("page")).first()[0] or 0
    tested, names = page_tests(pages, first_page, statements)
    flags = {name: {t: F.col(f"{name}_{t}") for t in tests} for name, tests in names.items()}
    steps = {name: step_of(flags[name]) for name, step_of in (("SNP", position_step), ("SOA", activities_step)) if name in statements}
    steps |= {fund.name: fund_step(flags[fund.name], fund.governmental) for fund in FUNDS if fund.name in statements}
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("statement"), s["to"].alias("to"), s["take"].alias("take")) for n, s in steps.items()])).alias("x")
    return taken_pages(tested.select("doc_id", "page", each).select("doc_id", "x.statement", "page", "x.to", "x.take"), ["doc_id", "statement"], fan, largest)


def ranges(taken: DataFrame, by: list[str]) -> DataFrame:
    """Rows (by, first_page, last_page, n_pages) of the pages taken."""
    return taken.groupBy(*by).agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.count("*").alias("n_pages"))
