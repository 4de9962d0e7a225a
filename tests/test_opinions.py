"""The auditor's opinion, by hand-made documents and against a plain walk over random ones."""

import random
import re

from pyspark.sql import functions as F

from folio.operators import opinions as m
from folio.plans.opinions import PLANTED, TITLES

LINES = "doc_id int, page int, line int, text string"
REPORT = ["Independent Auditor's Report", "We have audited the accounts of the city"]


def table(spark, docs):
    return spark.createDataFrame([(d, p, k, t) for d, pages in docs.items() for p, texts in enumerate(pages) for k, t in enumerate(texts)], LINES)


def verdicts(spark, docs):
    wanted = spark.createDataFrame([(d,) for d in docs], "doc_id int")
    got = m.opinion(m.operative(m.sections(table(spark, docs))), wanted)
    return {r.doc_id: (r.status, r.score, r.page, r.classification) for r in got.collect()}


def test_opinions(spark):
    fair = "In our opinion the statements present fairly, in all"
    docs = {
        1: [["cover"], REPORT + ["Opinion", fair, "Basis for Opinion", "adverse"]],
        2: [REPORT + ["Opinion", "Basis for Opinion", "an adverse line before", "more", fair, "Other Matter", "adverse"]],
        3: [REPORT + ["Opinions", "a qualified one"], ["text"], REPORT + ["Opinion", fair, "and a disclaimer"]],
        4: [REPORT + ["Opinions", "a qualified one"], ["text"], ["text"], REPORT + ["Opinion", fair, "except as qualified above"]],
        5: [["Table of Contents", "Independent Auditor's Report"], ["Independent Auditor's Report on Compliance", "Opinion", fair], ["INDEPENDENT AUDITOR ' S REPORT", "we have audited", "Opinion", "true and  fair"]],
        6: [REPORT + ["Opinion", fair], ["Independent Auditors' Report on the Audit of the Financial Statements", "Opinion", "unqualified"]],
        7: [REPORT + ["Opinions", "Unmodified Opinion on Regulatory Basis of Accounting", fair, "Adverse Opinion on U.S. Generally Accepted Accounting Principles", "does not present fairly"]],
        8: [REPORT + ["Opinions", "regulatory basis, adverse under accounting principles generally accepted", "unmodified otherwise"]],
        9: [REPORT + ["Opinion", "we can't say"]],
        10: [["nothing"]],
        11: [REPORT + ["Opinion"] + ["x1"] * 39 + ["is unmodified", "adverse"]],
        12: [REPORT + ["Opinion"] + ["x1"] * 40 + ["is unmodified"]],
        13: [REPORT + ["Opinion", "a qualified opinion is not given"]],
        14: [REPORT, ["x"], ["Opinion", "unmodified"], ["Opinion", "adverse"]],
        15: [REPORT, ["x"], ["x"], ["Opinion", "unmodified"]],
        16: [[None, "", "State Auditor’s Report"] + ["Opinion", " ", "unqualified"]],
    }
    none = ("FAIL", 0.0, None, None)
    assert verdicts(spark, docs) == {
        1: ("PASS", 100.0, 1, "Present Fairly"), 2: ("FAIL", 50.0, 0, "Adverse"), 3: ("FAIL", 50.0, 2, "Disclaimer"), 4: ("REVIEW", 90.0, 3, "Qualified"),
        5: ("PASS", 100.0, 2, "True and Fair"), 6: ("PASS", 100.0, 1, "Unqualified"), 7: ("PASS", 100.0, 0, "Unmodified - Regulatory Basis"), 8: ("PASS", 100.0, 0, "Unmodified - Regulatory Basis"),
        9: none, 10: none, 11: ("PASS", 100.0, 0, "Unmodified"), 12: none, 13: none, 14: ("PASS", 100.0, 2, "Unmodified"), 15: none, 16: ("PASS", 100.0, 0, "Unqualified"),
    }


def test_year(spark):
    head = REPORT + ["Opinion"]
    docs = {
        1: [head + ["unmodified as of", "June 30, 2021"]],
        2: [head + ["unmodified as of June 30,", "2021 and since"]],
        3: [head + ["unmodified since June 30, 2020", "and in 12/31/2021"]],
        4: [head + ["unmodified", "Other Information", "June 30, 2021"]],
        5: [head + ["a qualified one"], REPORT + ["Opinion", "is unmodified, June 30, 2021"]],
        6: [head + ["unmodified June 30, 2021"]],
        7: [head + ["unmodified"], REPORT + ["Opinion", "adverse, June 30, 2021"]],
    }
    wanted = spark.createDataFrame([(d, None if d == 6 else (6, 2021)) for d in docs], "doc_id int, fye struct<month:int,year:int>")
    blocks = m.operative(m.sections(table(spark, docs)))
    got = m.opinion_year(blocks, m.opinion(blocks, wanted), wanted)
    # the first report's window reaches the second's page, so that 5 finds its date there first and 7 is judged by the first report's own lines
    assert {r.doc_id: (r.status, r.score, r.page) for r in got.collect()} == {
        1: ("PASS", 100.0, 0), 2: ("PASS", 100.0, 0), 3: ("REVIEW", 80.0, 0), 4: ("FAIL", 0.0, None), 5: ("PASS", 100.0, 1), 6: ("FAIL", 0.0, None), 7: ("PASS", 100.0, 1),
    }


def plain_sections(pages):
    """Report pages and the opinion's lines, by a walk over the pages."""
    has = lambda patterns, t: re.search("|".join(patterns), t, re.I) is not None
    norm = lambda t: " ".join(t.replace("’", "'").replace("‘", "'").split())
    named = []
    for p, texts in enumerate(pages):
        title = []
        for t in [t for t in map(norm, texts) if len(t) > 2 and not re.fullmatch("|".join(m.MARGINS), t, re.I)][:15]:
            t = re.sub(r" ?' ?", "'", norm(re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", t)))
            if has(m.BODY, t):
                break
            title.append(t)
        title = " ".join(title)
        if has(m.REPORT, title) and not has(m.CONTENTS, title) and not has(m.OTHER_REPORTS, title):
            named.append((p, has(m.REPORT_ON_STATEMENTS, title)))
    chosen = [p for p, full in named if full] or [p for p, _ in named]
    out = {}
    for p in chosen:
        flat = [(q, k, norm(t)) for q in range(p, min(p + 3, len(pages))) for k, t in enumerate(pages[q]) if norm(t)]
        stop = lambda t: re.match(rf"(?:{'|'.join(m.STOPS)})\b", t, re.I)
        heads = [i for i, x in enumerate(flat) if re.search(m.HEADING, x[2], re.I)]
        told = [i for i, x in enumerate(flat) if re.search(m.SENTENCE, x[2], re.I)]
        start = None
        if heads and heads[0] + 1 < len(flat) and not stop(flat[heads[0] + 1][2]):
            start = heads[0] + 1
        elif told:
            start = max(0, told[0] - 2)
        got = []
        if start is not None:
            for x in flat[start:start + 40]:
                if got and stop(x[2]):
                    break
                got.append(x)
        out[p] = got
    return out


def test_sections_equal_a_walk(spark):
    rng = random.Random(5)
    some = PLANTED + TITLES + ["x", "iv", "Schedule B", "plain words", "", "  ", "In  our opinion"]
    docs = {d: [[rng.choice(TITLES if k == 0 and rng.random() < 0.6 else some) for k in range(rng.randint(1, 9))] for _ in range(rng.randint(1, 8))] for d in range(300)}
    want = {(d, p): lines for d, pages in docs.items() for p, lines in plain_sections(pages).items()}
    got = {(r.doc_id, r.report): [tuple(x) for x in r.section] for r in m.sections(table(spark, docs)).collect()}
    assert got == want and len(want) > 100 and any(not v for v in want.values())


def test_empty(spark):
    lines = spark.createDataFrame([], LINES)
    blocks = m.operative(m.sections(lines))
    assert blocks.count() == 0
    one = spark.createDataFrame([(1, (6, 2021))], "doc_id int, fye struct<month:int,year:int>").withColumn("status", F.lit("clash"))
    found = m.opinion(blocks, one)
    assert [tuple(r) for r in found.collect()] == [(1, "FAIL", 0.0, None, None, None)] and m.opinion_year(blocks, found, one).first().status == "FAIL"


def test_lines_are_dealt_out_once(spark):
    """The title, the cover and the section read one shuffle of the lines, and titles are put together without an aggregate of objects."""
    docs = {1: [REPORT + ["Opinion", "unmodified"]], 2: [["x y"]]}
    cut = m.sections(table(spark, docs))
    assert {(r.doc_id, len(r.section)) for r in cut.collect()} == {(1, 1)}
    plan = m.report_pages(m.plain_lines(table(spark, docs)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1 and "Aggregate" not in plan


def test_unglued_of_plain(spark):
    """unglued() takes texts that plain() has made, with the same result as cleaning them again."""
    texts = ["INDEPENDENT AUDITOR ' S  REPORT", "comINDEPENDENT\tAUDITORS’ REPORT", "a1B 'c ' ", "‘x’Y zZ", "", "AbC\n\n'"]
    t = spark.createDataFrame([(x,) for x in texts], "x string").select(m.unglued(m.plain(F.col("x"))).alias("u"), "x")
    for r in t.collect():
        norm = " ".join(r.x.replace("’", "'").replace("‘", "'").replace(" ", " ").split())
        assert r.u == re.sub(r"\s*'\s*", "'", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", norm))


def test_year_over_lines_of_two_digits(spark):
    """A date over lines with a year of two digits is found; the last two digits alone are none."""
    head = REPORT + ["Opinion"]
    docs = {1: [head + ["unmodified as of 6/30", "-21 and since"]], 2: [head + ["unmodified as of June", "30, 21"]], 3: [head + ["unmodified, 21 of them"]]}
    wanted = spark.createDataFrame([(d, (6, 2021)) for d in docs], "doc_id int, fye struct<month:int,year:int>")
    blocks = m.operative(m.sections(table(spark, docs)))
    got = {r.doc_id: r.status for r in m.opinion_year(blocks, m.opinion(blocks, wanted), wanted).collect()}
    assert got[2] == "PASS" and got[3] == "FAIL"
