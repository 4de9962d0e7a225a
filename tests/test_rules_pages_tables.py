"""Rules over statements, page tests, coordinates, ratios and tables, on small hand-checked rows."""

import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from folio.functions import fuzzy
from folio.operators import coordinates, pages, statement_rules
from folio.sources import tables


def test_debt_class(spark):
    cases = [
        ("Unamortized bond premiums - County", 5, 1, "Premium/ Discount"), ("Net Pension Liability (1)", 5, 5, "Pension-OPEB Liability"),
        ("Right-to-use lease", 5, 1, "Lease Liability"), ("Lease revenue bonds", 5, 1, "Long-term Debt"), ("Lease note", 5, 1, "Lease Liability"),
        ("Commercial Paper", 5, 5, "Short-term Debt"), ("Commercial Paper", 0, 0, "Long-term Debt"), ("Bonds payable - See Note 7", 5, None, "Long-term Debt"),
        ("State loan payable", 5, 5, "State Loan"), ("Interfund loan", 5, 1, "Long-term Liability"), ("Compensated absences*", 5, 5, "Short-term Liability"),
        ("Workers' compensation", 5, 1, "Long-term Liability"), ("COPs", 5, 1, "Long-term Debt"), ("Scope", 5, 1, None), (None, None, None, None), ("", 1, 1, None),
    ]
    df = spark.createDataFrame([c[:3] for c in cases], "label string, e int, d int")
    assert [r[0] for r in df.select(statement_rules.debt_class(F.col("label"), F.col("e"), F.col("d"))).collect()] == [c[3] for c in cases]


def test_digit_drop(spark):
    cases = [(1676001, 16760001, (16760001, "repaired")), (100, 110, (100, "ok")), (10, 5000, (10, "fail")), (-1676001, -16760001, (-16760001, "repaired")), (D("1.5"), 15, (D("1.5"), "fail")), (0, 0, (0, "ok")), (None, 5, None), (5, None, None)]
    df = spark.createDataFrame([tuple(None if x is None else D(x) for x in c[:2]) for c in cases], "v decimal(38,4), t decimal(38,4)")
    got = [r[0] for r in df.select(statement_rules.digit_drop(F.col("v"), F.col("t"))).collect()]
    assert [None if g is None else (g.value, g.state) for g in got] == [c[2] for c in cases]


def test_arithmetic_rules(spark):
    funds = spark.createDataFrame([(1, 50, 5, 5, 40, 10), (1, 90, 5, 5, 40, 10), (1, None, 5, 5, 40, 10), (2, 1, 1, 1, 0, 0)], "g int, operating_income int, depreciation int, investment_income int, principal int, interest int")
    got = sorted(((r.g, r.coverage, r.low) for r in statement_rules.debt_coverage(funds, ["g"]).collect()), key=str)
    assert got == sorted([(1, 1.2, False), (1, 2.0, False), (1, None, False), (2, None, False)], key=str)
    row = spark.range(1).select(statement_rules.activity_shares(F.lit(75), F.lit(25), F.lit(80), F.lit(20)).alias("s"), statement_rules.activity_shares(F.lit(0), F.lit(0), F.lit(80), F.lit(None).cast("int")).alias("n"), statement_rules.roll_forward(F.lit(10), F.lit(5), F.lit(-3), F.lit(13), F.lit(None).cast("int")).alias("r"), statement_rules.weighs_on_fund(F.lit(-20), F.lit(-100)).alias("w")).first()
    assert tuple(row.s) == pytest.approx((0.6, 0.2, 0.2)) and row.n is None and row.r is True and row.w is True


def test_repair_shifts(spark):
    rows = [(1, "s", 0, "DP", "x", 10, None, 10), (1, "s", 1, "DP", "y", 7, None, 7), (1, "s", 2, "CP", "Total s", 10, 7, 17), (2, "s", 0, "DP", "x", 10, None, 10), (2, "s", 1, "CP", "Sum", 0, 10, 10), (3, "s", 0, "DP", "x", None, 4, 4), (3, "s", 1, "CP", "total", 4, 0, 4)]
    df = spark.createDataFrame([tuple(D(x) if k > 4 and x is not None else x for k, x in enumerate(r)) for r in rows], "table_id int, section string, row_order int, flag string, label string, a decimal(38,4), b decimal(38,4), total decimal(38,4)")
    got = {(r.table_id, r.row_order): (r.a, r.b, r.moved) for r in statement_rules.repair_shifts(df).collect()}
    assert got[1, 1] == (None, 7, True) and got[1, 0] == (10, None, False) and got[2, 0] == (10, None, False) and got[3, 0] == (4, None, True)
    assert statement_rules.repair_shifts(df.where("false")).count() == 0


def test_coordinates_equal_a_plain_loop(spark):
    rng = random.Random(1)
    cells = [(d, k, k % 4, 4, rng.choice(["1,234", "(56)", "$7", "-", None])) for d in (1, 2) for k in range(30)]
    words = [(d, rng.randrange(3), k, rng.choice(["1,234", "56", "7", "x"]), float(rng.randrange(612))) for d in (1, 2) for k in range(40)]
    used, want = set(), {}
    for d, k, i, n, v in cells:
        digits = "".join(x for x in v or "" if x.isdigit())
        free = [(abs(x - 612 * (i + 0.5) / n), p, w) for dd, p, w, t, x in words if digits and dd == d and "".join(c for c in t if c.isdigit()) == digits and (dd, w) not in used]
        best = min(free, default=None)
        want[d, k] = best and best[2]
        used |= {(d, best[2])} if best else set()
    got = coordinates.attach(spark.createDataFrame(cells, "doc_id int, cell_id int, col_index int, n_cols int, value string"), spark.createDataFrame(words, "doc_id int, page int, word_id int, text string, x0 double"))
    assert {(r.doc_id, r.cell_id): r.word_id for r in got.collect()} == want


def test_ratios(spark):
    cases = [("clifton larson allen", "by clifton larson allen llp", 100.0, 100.0), ("a b", "b a", None, 100.0), ("", "x", 0.0, 0.0), ("abcd", "abxd", 75.0, 75.0), ("x y", "x z", None, None), (None, "x", None, None)]
    df = spark.createDataFrame([c[:2] for c in cases], "a string, b string")
    got = df.select(fuzzy.partial_ratio("a", "b"), fuzzy.token_set_ratio("a", "b")).collect()
    for (a, _, p, t), g in zip(cases, got, strict=True):
        assert (p is None and a is not None) or g[0] == p
        assert (t is None and a is not None) or g[1] == t

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            out = [0]
            for j, y in enumerate(b):
                out.append(row[j] + 1 if x == y else max(row[j + 1], out[-1]))
            row = out
        return row[-1]

    rng = random.Random(2)
    for _ in range(200):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randrange(1, 90))) for _ in "ab")
        assert fuzzy.ratio(a, b) == 200.0 * lcs(a, b) / (len(a) + len(b))


def test_pages(spark):
    test = pages.PageTest("debt", every=("(?i)principal",), some=("(?i)interest", "(?i)total"), none=("(?i)contents",), least={r"\d{4}": 3})
    df = spark.createDataFrame([(1, "Principal Interest 2021 2022 2023"), (2, "Principal Interest 2021 2022"), (3, "Contents Principal total 2021 2022 2023"), (4, None)], "page int, t string")
    assert [r.debt for r in pages.page_flags(df, "t", [test]).orderBy("page").collect()] == [True, False, False, False]
    hits = spark.createDataFrame([(1, 3, "c"), (1, 2, "b"), (1, 9, "a"), (2, 1, "z")], "doc int, page int, kind string")
    tier = F.when(F.col("kind") == "a", 0).when(F.col("kind").isin("b", "c"), 1)
    assert [tuple(r) for r in pages.best_hit(hits, ["doc"], tier, ["page"], ["page", "kind"]).collect()] == [(1, 0, 9, "a")]
    spread = spark.createDataFrame([("d", p) for p in (4, 5, 5, 6, 9, 10)], "doc string, page int")
    assert sorted(r.page for r in pages.first_cluster(spread, ["doc"], "page").collect()) == [4, 5, 6]
    cleaned = pages.clean_map(spark.createDataFrame([("d", "s", p) for p in (0, 1, 1, 5)], "doc_id string, statement string, page int"), spark.createDataFrame([("d", 5)], "doc_id string, n_pages int"), 1)
    assert sorted(r.page for r in cleaned.collect()) == [1, 2]
    row = spark.range(1).select(pages.shredded(F.lit("T o t a l  a s s e t s")), pages.shredded(F.lit("plain words of a line with no marks")), pages.join_letters(F.lit("T o t a l  a s s e t s")), pages.shredded(F.lit(None).cast("string"))).first()
    assert tuple(row) == (True, False, "Total assets", False)


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(" ab ", "x", None), (None, " ", "")], "`Auditee UEI` string, state string, extra string")
    tables.write_csv(df, str(tmp_path / "c"), ["state", "Auditee UEI", "none"])
    back = tables.read_csv(spark, str(tmp_path / "c"), ["Auditee UEI", "state"], upper=["Auditee UEI"])
    assert sorted((r[0] or "", r[1] or "") for r in back.collect()) == [("", ""), ("AB", "x")]
    named = tables.by_alias(df, {"uei": ["uei"], "st": ["State"], "year": ["audit year"]})
    assert named.columns == ["uei", "st", "year"] and named.first().uei == " ab " and named.first().year is None
    assert [r.line for r in tables.pipe_text(df).collect()] == ["ab | x | "]
    assert tables.stack([df.select("state"), df.select("extra")], ["extra"]).columns == ["extra", "state"]
    assert df.where(tables.in_values(F.col("state"), [])).count() == 0 and df.where(tables.in_values(F.col("state"), ["x"])).count() == 1
