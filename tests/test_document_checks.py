"""Verdicts on documents, on small hand-made lines."""

import random

import pytest
from pyspark.sql import functions as F

from folio.operators import document_checks as checks

LINES = "doc_id int, page int, line int, text string"


def lines(spark, docs):
    return spark.createDataFrame([(d, k // 5, k % 5, t) for d, texts in docs.items() for k, t in enumerate(texts)], LINES)


def test_state(spark):
    docs = {
        1: ["Report", "City of Dallas", "x", "TEXAS"],
        2: ["cover", "Lone Water Authority", "serves much of texas and more places"],
        3: ["Lone Water", "one more line", "serves all of texas since long ago"],
        4: ["Lone Water", "a", "b", "c", "d", "e", "it is a fund of texas as told"],
        5: ["Lone Water", "a", "b", "c", "d", "e", "which operates throughout  texas and is small"],
        6: ["nothing here"],
        7: ["we know texas well enough"],
        8: ["Lone Water of texas that serves many"],
    }
    anchors = {1: (0, 1), 2: (0, 1), 3: (0, 0), 4: (0, 0), 5: (0, 0), 6: (0, 0), 7: (None, None), 8: (0, 0)}
    wanted = spark.createDataFrame([(d, "TX", "Texas", *a) for d, a in anchors.items()], "doc_id int, code string, name string, page int, line int")
    got = {r.doc_id: (r.status, r.score, r.page) for r in checks.state(lines(spark, docs), wanted).collect()}
    assert got == {1: ("PASS", 100, 0), 2: ("PASS", 95, 0), 3: ("REVIEW", 90, 0), 4: ("FAIL", 70, 1), 5: ("PASS", 95, 1), 6: ("FAIL", 0, None), 7: ("FAIL", 50, 0), 8: ("PASS", 100, 0)}


def test_auditor(spark):
    docs = {1: ["By Müller & Co LLP", "x"], 2: ["signed by mueler and sons", "x"], 3: ["Signed: Ann Leee"], 4: ["nobody"], 5: ["text"]}
    wanted = spark.createDataFrame([(1, "Muller & Co., LLP (Bo)"), (2, "Mueller and Sons"), (3, "Zed LLP (Ann Lee)"), (4, "Zed Partners"), (5, "")], "doc_id int, auditor string")
    got = {r.doc_id: (r.status, r.score) for r in checks.auditor(lines(spark, docs), wanted).collect()}
    assert got[1] == ("PASS", 100) and got[2][0] == got[3][0] == "PASS" and 85 <= got[2][1] <= 100 and got[4] == got[5] == ("FAIL", 0)


def test_entity_name_tiers(spark):
    docs = {1: ["x", "The City of Austin Water"], 2: ["Austin", "City is a", "place for Water."], 3: ["nothing"], 4: ["Austin City Water Fund Power Light Gas Road Bridge"]}
    wanted = spark.createDataFrame([(1, "City of Austin Water"), (2, "City of Austin Water"), (3, "City"), (4, "Austin City Water Fund Power Light Gas Road Bridge Tunnel")], "doc_id int, entity string")
    got = {r.doc_id: (r.status, r.score) for r in checks.entity_name(lines(spark, docs), wanted).collect()}
    assert got == {1: ("PASS", 100), 2: ("PASS", 100), 3: ("FAIL", 0), 4: ("REVIEW", 90)}


def test_fiscal_year_tiers(spark):
    docs = {1: ["June 30, 2023 and 2022"], 2: ["x"] * 60 + ["for 6/30/2023"], 3: ["June 30, 2020"], 4: ["May 31, 2023"], 5: ["no date 1"], 6: ["x"] * 60 + ["June 30, 2023"]}
    wanted = spark.createDataFrame([(d,) for d in docs], "doc_id int").withColumn("fye", F.struct(F.lit(6).alias("month"), F.lit(2023).alias("year")))
    pages = spark.createDataFrame([(6, 12)], "doc_id int, page int")
    got = {r.doc_id: (r.status, r.score) for r in checks.fiscal_year(lines(spark, docs), wanted, pages).collect()}
    assert got == {1: ("PASS", 100), 2: ("REVIEW", 90), 3: ("REVIEW", 80), 4: ("REVIEW", 70), 5: ("FAIL", 0), 6: ("PASS", 100)}


def test_rows_by_running_mean_and_indents(spark):
    rng = random.Random(4)
    words = [(1, p, i, float(rng.choice([72, 84, 96, 300])), round(rng.uniform(0, 60), 1), f"w{i}") for p in range(3) for i in range(30)]
    df = spark.createDataFrame(words, "doc_id int, page int, word_id int, x0 double, y0 double, text string")
    want = {}
    for p in range(3):
        mean, n, row = None, 0, -1
        for _, _, i, x, y, _ in sorted((w for w in words if w[1] == p), key=lambda w: (w[4], w[3], w[2])):
            if mean is None or abs(y - mean) > 6:
                mean, n, row = y, 1, row + 1
            else:
                mean, n = (mean * n + y) / (n + 1), n + 1
            want[p, i] = row
    assert {(r.page, r.word_id): r.row for r in checks.group_rows(df).collect()} == want
    two = spark.createDataFrame([(1, 0, 1, 72.0, 10.0, "Assets"), (1, 0, 2, 90.0, 30.0, "Cash"), (1, 0, 3, 300.0, 31.0, "5"), (1, 0, 4, 72.5, 50.0, "Total")], df.schema)
    assert [r.text for r in checks.indented_lines(two).orderBy("row").collect()] == ["Assets", "  Cash 5", "Total"]


@pytest.mark.parametrize("n", [3, 40, 41, 97])
def test_sampled_pages(spark, n):
    """Document d has its one image on page d, so it needs OCR where that page is looked at."""
    pages = spark.createDataFrame([(d, p, 0, p == d) for d in range(n) for p in range(n)], "doc_id int, page int, n_chars int, raster boolean")
    want = set(range(n)) if n <= 40 else {int(i * (n / 40.0)) for i in range(40)}
    assert {r.doc_id for r in checks.requires_ocr(pages).where("ocr").collect()} == want


def test_relabel(spark):
    steps = spark.createDataFrame([(1, "a", "FAIL"), (1, "b", "PASS"), (2, "a", "NOT FOUND"), (3, "a", "FAIL")], "doc_id int, step string, status string")
    ocr = spark.createDataFrame([(1, True), (2, False)], "doc_id int, ocr boolean")
    assert sorted((r.doc_id, r.step, r.status) for r in checks.relabel(steps, ocr).collect()) == [(1, "a", "OCR REQUIRED"), (1, "b", "PASS"), (2, "a", "NOT FOUND"), (3, "a", "FAIL")]
