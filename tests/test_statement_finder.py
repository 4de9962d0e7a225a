"""The statement finder, by hand-made documents and against a plain walk over random ones."""

import random
import re

from folio.operators import statement_finder as m

LINES = "doc_id int, page int, line int, text string"
WANTED = "doc_id int, sector string, fye struct<month:int,year:int>"
YEAR = (6, 2021)


def table(spark, docs):
    return spark.createDataFrame([(d, p, k, t) for d, pages in docs.items() for p, texts in enumerate(pages) for k, t in enumerate(texts)], LINES)


def wanted(spark, docs, sector="LG"):
    return spark.createDataFrame([(d, sector, YEAR) for d in docs], WANTED)


def found(spark, docs, **more):
    return {(r.doc_id, r.step): (r.status, r.score, r.page, r.last) for r in m.find_statements(table(spark, docs), wanted(spark, docs), **more).collect()}


def test_statements(spark):
    top = ["Statement of Cash", "Receipts and Disbursements"] + ["a city line"] * 6
    docs = {
        1: [["cover"], top + ["Receipts 1,000", "Disbursements", "June 30, 2021"]],
        2: [top + ["Receipts and disbursements 1,000", "June 30, 2020"]],
        3: [top + ["Receipts and disbursements 1,000"], ["more disbursements", "June 30, 2020"]],
        4: [top + ["Receipts 1,000"], ["Budgetary schedule of one", "disbursements"]],
        5: [top + ["Receipts 1,000"], ["Combined budgetary schedule", "disbursements"]],
        6: [top + ["Receipts", "Disbursements"]],
        7: [top + ["Receipts 100"] + ["x y"] * 59 + ["Disbursements"]],
        8: [top + ["Receipts 100"]] + [["nothing here"]] * 5 + [["Disbursements"]],
        9: [["Balance Sheet", "Governmental Funds"] + ["a line"] * 6 + ["Assets", "Liabilities", "total  reserves", "December 31"]],
        10: [top + ["x"], top + ["Receipts 100", "Expenditures"]],
        11: [[None, ""]],
    }
    got = found(spark, docs)
    assert {d: got[d, "G3-1"] for d in docs} == {
        1: ("PASS", 100.0, 1, 1), 2: ("FAIL", 0.0, None, None), 3: ("REVIEW", 85.0, 0, 1), 4: ("FAIL", 0.0, None, None), 5: ("REVIEW", 80.0, 0, 1), 6: ("FAIL", 0.0, None, None),
        7: ("FAIL", 0.0, None, None), 8: ("FAIL", 0.0, None, None), 9: ("FAIL", 0.0, None, None), 10: ("REVIEW", 80.0, 0, 1), 11: ("FAIL", 0.0, None, None),
    }
    assert got[9, "G3-3"] == ("REVIEW", 80.0, 0, 0)
    scanned = spark.createDataFrame([(1, 1), (2, 5)], "doc_id int, page int")
    assert found(spark, docs, scanned=scanned)[1, "G3-1"] == ("OCR REQUIRED", 0.0, 1, 1)
    other = m.find_statements(table(spark, docs), wanted(spark, docs, "nonlg")).where("step = 'G3-3'").collect()
    assert {(r.status, r.score, r.page) for r in other} == {("NOT APPLICABLE", 0.0, None)}
    assert m.find_statements(spark.createDataFrame([], LINES), wanted(spark, [1])).where("status <> 'FAIL'").count() == 0


def plain_find(pages, s):
    """Status, page and last page of a statement, by a walk."""
    norm = lambda t: " ".join(t.split()).lower()
    has = lambda patterns, t: any(re.search(p.replace(" ", r"\s+"), t, re.I) for p in patterns)
    own = [[norm(t) for t in texts if norm(t)] for texts in pages]
    tops = [[t for t in texts if len(t) > 2][:8] for texts in own]
    for p in range(len(own)):
        if not any(has(s.titles, " ".join(tops[p][i:i + n])) for n in (1, 2, 3) for i in range(len(tops[p]) - n + 1)):
            continue
        missing, last, good = list(s.rows), p, False
        for q in range(p, min(p + 6, len(own))):
            bad = any(len(t) < 80 and not re.search(m.BREAKS_OFF, t) and has(m.EXCLUDED, t) for t in tops[q][:3])
            if q > p and bad and not any(has(m.ALLOWED, t) for t in tops[q]):
                break
            last = q
            for t in own[q][8:68] if q == p else own[q][:60]:
                hit = next((r for r in missing if has([r], t)), None)
                if hit:
                    missing.remove(hit)
                if not missing:
                    break
            if not missing:
                good = True
                break
        column = any(has(s.columns or [m.AMOUNT], t) for q in range(p, min(p + 6, len(own))) for t in own[q])
        if good and column:
            text = [t for q in range(p, last + 1) for t in own[q]]
            whole, half = any("june 30, 2021" in t for t in text), any("june 30, 2020" in t for t in text)
            return ("PASS", 100.0, p, last) if whole else ("REVIEW", 85.0 if half else 80.0, p, last)
    return ("FAIL", 0.0, None, None)


def test_find_equals_a_walk(spark):
    rng = random.Random(11)
    some = [
        "Statement of Cash Receipts", "and Expenditures", "Statement of Revenues, Expenditures and Changes", "in Fund Balance", "Balance Sheet", "of Governmental Funds", "assets and liabilities 1,000",
        "revenues, expenditures", "change in fund balance", "fund balance", "receipts", "liability", "x", "June 30, 2021", "June 30, 2020", "Budgetary schedule", "Combined", "supplementary and", "", "expenditure of 2020",
    ]
    docs = {d: [[rng.choice(some) for _ in range(rng.randint(1, 16))] for _ in range(rng.randint(1, 9))] for d in range(150)}
    want = {(d, s.step): plain_find(pages, s) for d, pages in docs.items() for s in m.STATEMENTS}
    got = found(spark, docs)
    assert got == want and {v[0] for v in want.values()} == {"PASS", "REVIEW", "FAIL"}
