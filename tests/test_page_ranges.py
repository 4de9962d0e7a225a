"""Page finders held against a plain walk over each document's pages."""

import random
import re

import pytest

from folio.operators import page_ranges as m

LINES = [
    "Statement of Net Position", "Exhibit A - Statement of Net Position", "Total assets 1,234,567", "Total liabilities 12,345", "Net position", "Assets", "Component units", "Page 2 of 3", "Deferred inflows of resources",
    "Statement of Activities", "Condensed statement of activities", "Program revenues", "Charges for services 1,200", "General revenues", "Governmental activities", "Notes to the basic statements",
    "Balance Sheet", "Governmental Funds", "Balance Sheet of the Governmental Funds 1,000 2,000 3,000 4,000 5,000 6,000 7,000 8,000", "Fund balances 5,000 6,000 7,000 8,000", "Total fund balances 4,000 5,000 6,000 7,000 8,000", "Reconciliation", "Statement of Revenues, Expenditures and Changes in Fund Balances",
    "Expenditures", "Revenues", "Net change in fund balances", "Statement of Net Position - Proprietary Funds", "Total net position 9,876", "Statement of Cash Flows", "Proprietary Funds", "Enterprise Funds",
    "Statement of Revenues, Expenses and Changes in Net Position", "Enterprise Funds: Statement of Revenues, Expenses and Changes in Fund Net Position", "Operating revenues", "Operating expenses", "Net position - end of year 1,000", "Cash flows from operating activities", "Net cash provided 1,000 2,000 3,000",
    "Cash and cash equivalents, end of year 4,000 5,000", "(continued)", "Total 1,000", "Totals - - -", "$ 500", "a", "b", "", "T o t a l   a s s e t s", "text of no account", "See notes to the basic financial statements", "Table of contents", "budget",
]


def has(pattern, text):
    return re.search(pattern, text) is not None


def first(text, n):
    return "\n".join(text.split("\n")[:n])


def title_there(text, title):
    lines = text.split("\n")
    return any(has(title, " ".join(x.strip() for x in part if x.strip())) or any(has(title, x.strip()) for x in part) for part in (lines[:25], lines[-25:]))


def scrambled(text):
    lines = text.split("\n")[:20]
    return sum(len(x.strip()) <= 2 for x in lines) >= 3 or any(re.match(r"^([A-Za-z]\s){2,}", x.strip()) for x in lines)


def fund_pages(fund, following, texts):
    def excluded(t):
        if scrambled(t):
            return False
        if has(m.RECONCILED, t):
            return True
        clean = "\n".join([x for x in t.split("\n") if not has(m.FOOTER, x)][:20])
        if has(m.EXCLUDED, clean) or has(m.CONTENTS, clean):
            return True
        return has(m.RECONCILIATION, clean) and not (title_there(t, fund.title) and all(has(w, t) for w in fund.wants))

    def anchor(t):
        if title_there(t, fund.title) and not (fund.amounts and len(re.findall(r"\b\d{1,3}(?:,\d{3})+\b", t)) < fund.amounts):
            if any(has(w, first(t, 40)) for w in fund.wants) or has(r"(?i)\bassets\b", first(t, 40)):
                return True
        if scrambled(t) and all(has(w, t) for w in fund.scrambled):
            return True
        return bool(fund.body) and sum(has(p, t) for p in fund.body) >= 2 and len(re.findall(r"\b\d{1,3}(?:,\d{3})+\b", t)) >= 5

    def complete(t):
        return has(fund.complete, t) and (not fund.numbers or any(has(fund.complete, x) and has(m.AMOUNT, x) for x in t.split("\n")))

    def stop(t):
        return any(has(p, first(t, n)) for p, n in fund.stops)

    def overflow(t):
        lines = t.split("\n")
        if fund.governmental:
            top = " ".join(lines[:8])
            wide = has(r"(?i)\btotal\b.{0,80}\bgovernmental\b.{0,40}\bfunds?\b", top) if fund.name == "GOV_IS" else has(r"(?i)\btotal\b", top) and has(r"(?i)\bfunds?\b", top)
            if wide:
                return True
            if next((i for i, x in enumerate(lines) if "$" in x), 999) < 2 or has(m.OTHER_TITLE, top):
                return False
            return has(r"(?i)\btotals?\b", " ".join(lines[:12])) and any(has(r"\b\d[\d,]{2,}\b", x) for x in lines[2:8])
        if has(fund.not_overflow, " ".join(lines[:12])) or has(m.OVERFLOW_NOT, " ".join(lines[:12])) or not has(m.OVERFLOW_HEADS, " ".join(lines[:25])):
            return False
        return sum(has(r"\(?-?\d[\d,]{2,}\)?", x) for x in lines[:40]) >= 2 or sum(has(r"(^|\s)[-–—](\s|$)", x) for x in lines[:40]) >= 3

    def goes_on(t, before):
        if excluded(t) or stop(t):
            return False
        if has(m.FROM_PREVIOUS, first(t, 15)):
            return True
        if anchor(t) and not has(m.CONTINUED, first(t, 5)) and not has(m.CONTINUED, "\n".join(before.split("\n")[-5:])):
            return False
        if has(fund.going_on, first(t, 30)):
            return True
        money = sum(has(r"\$\s*[\d,]+", x) for x in t.split("\n"))
        return (scrambled(t) or money >= 3) and all(has(w, t) for w in fund.scrambled_on)

    for i, t in enumerate(texts):
        if excluded(t) or not anchor(t):
            continue
        out, done, j = [i], complete(t), i + 1
        while j < len(texts):
            t = texts[j]
            if excluded(t) or stop(t) or following and title_there(t, following.title):
                break
            if title_there(t, fund.title) and has(m.CONTINUED, first(t, 6)) and not done:
                out, done = [*out, j], complete(t)
            elif overflow(t):
                out, done = [*out, j], complete(t)
                if fund.governmental and done:
                    break
            elif done or not goes_on(t, texts[j - 1]):
                break
            else:
                out, done = [*out, j], complete(t)
            j += 1
        return out
    return []


def position_pages(texts):
    title = lambda t: any(has(m.SNP_TITLE, x.strip()) for x in t.split("\n")[:25])
    excluded = lambda t: has(m.SNP_EXCLUDED, first(t, 10))
    rows = lambda t: {i for i, p in enumerate(m.SNP_ROWS) if has(p, t)}
    for i, t in enumerate(texts):
        if excluded(t) or not title(t) or not has(r"(?i)\bassets\b", t):
            continue
        out, seen, j = [i], rows(t), i + 1
        while len(seen) < 3 and j < len(texts):
            if not excluded(texts[j]):
                if not rows(texts[j]):
                    break
                out, seen = [*out, j], seen | rows(texts[j])
            j += 1
        j = out[-1] + 1
        while j < len(texts):
            t = texts[j]
            if not excluded(t):
                line = next((x for x in t.split("\n") if x.strip()), "")
                if not (has(r"(?i)^\s*component\s+unit", line) or has(m.SNP_GOES_ON, first(t, 15)) or has(m.PAGE_OF, first(t, 15))):
                    break
                out.append(j)
            j += 1
        return out
    return []


def activities_pages(texts):
    title = lambda t: any(has(m.SOA_TITLE, x) and not has(m.SOA_FALSE, x) for x in t.split("\n")[:25])
    for i, t in enumerate(texts):
        if has(m.SNP_EXCLUDED, first(t, 10)) or not title(t) or sum(has(p, t) for p in m.SOA_KEYWORDS) < 2:
            continue
        out = [i]
        for j in range(i + 1, len(texts)):
            if any(has(m.SNP_TITLE, x.strip()) for x in texts[j].split("\n")[:25]) or not any(has(p, first(texts[j], 30)) for p in m.SOA_GOES_ON):
                break
            out.append(j)
        return out
    return []


def documents(seed, n, pages):
    rng = random.Random(seed)
    for d in range(n):
        some = rng.sample(LINES, rng.choice([6, 12, 20]))
        for p in range(1, rng.randrange(1, pages) + 1):
            yield d, p, "\n".join(rng.choice(some) for _ in range(rng.choice([2, 4, 7])))


@pytest.mark.parametrize(("seed", "pages", "fan"), [(1, 12, 64), (2, 30, 3), (3, 9, 2)])
def test_equals_a_walk(spark, seed, pages, fan):
    rows = list(documents(seed, 300, pages))
    of = {}
    for d, _, t in rows:
        of.setdefault(d, []).append(t)
    want = set()
    for d, texts in of.items():
        texts = texts[1:]  # statements begin on page 2 or later here
        want |= {(d, "SNP", i + 2) for i in position_pages(texts)} | {(d, "SOA", i + 2) for i in activities_pages(texts)}
        for k, fund in enumerate(m.FUNDS):
            want |= {(d, fund.name, i + 2) for i in fund_pages(fund, m.FUNDS[k + 1] if k < 4 else None, texts)}
    got = {tuple(r) for r in m.statement_pages(spark.createDataFrame(rows, "doc_id long, page int, text string"), 2, fan).collect()}
    assert got == want
    assert len({s for _, s, _ in want}) == 7 and len(want) > 300


def test_states_of_a_long_document_go_down_all_levels(spark):
    rng = random.Random(5)
    functions = [[rng.randrange(3) for _ in range(3)] for _ in range(500)]
    rows = [("x", i, f) for i, f in enumerate(functions) if i % 17]
    got = {r.page: r.entry for r in m.entered(spark.createDataFrame(rows, "doc string, page int, to array<int>"), ["doc"], "page", 3).collect()}
    state = 0
    for _, i, f in rows:
        assert got[i] == state
        state = f[state]


def test_cases(spark):
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, page int, text string")
    assert m.statement_pages(frame([])).count() == 0
    one = "Statement of Net Position\nAssets\nTotal assets 1\nTotal liabilities 2\nNet position 3"
    pages = [(1, 1, one), (1, 4, one), (1, 5, None), (2, 4, None), (3, 4, one + "\n"), (3, 5, "Page 2 of 2")]
    out = m.statement_pages(frame(pages))
    assert {tuple(r) for r in out.collect()} == {(1, "SNP", 4), (3, "SNP", 4), (3, "SNP", 5)}
    assert {tuple(r) for r in m.ranges(out, ["doc_id", "statement"]).collect()} == {(1, "SNP", 4, 4, 1), (3, "SNP", 4, 5, 2)}
