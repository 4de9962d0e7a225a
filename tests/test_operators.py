"""The operators on small hand-checked statements."""

import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from folio.functions import amounts, text
from folio.operators import coa, gates, nested, total_check, upsert
from folio.sources.statements import read_statements, tidy

ROWS = "table_id int, section string, row_order int, flag string, label string, datapoint string, col string, amt decimal(38,4)"


def statement(spark, reported, bta=150):
    rows = []
    for k, (flag, label, ga, b) in enumerate([("DPG", "Assets", None, None), ("DP", "Cash", 1000, 200), ("DP", "Receivables", 500, -50), ("CP", "Total assets", reported, bta)]):
        rows += [(1, "Assets", k, flag, label, label, "GA", None if ga is None else D(ga), 0), (1, "Assets", k, flag, label, label, "BTA", None if b is None else D(b), 1)]
    return spark.createDataFrame(rows, ROWS + ", col_pos int")


@pytest.mark.parametrize(("ga", "bta", "want"), [(1500, 150, "PASS"), (1501, 150, "PASS"), (1502, 150, "GA: FAIL"), (1502, 100, "GA: FAIL | BTA: FAIL"), (0, 150, "GA: FAIL")])
def test_section(spark, ga, bta, want):
    assert total_check.status_text(total_check.section_check(statement(spark, ga, bta))).first().status == want


def test_amounts(spark):
    cases = [(None, 0, 0, None), ("-", 0, 0, None), ("", 0, 0, None), ("–", 0, 0, None), ("1,234", 1234, 1234, 1234), ("(1,234.5)", -1234.5, -1234.5, -1234.5), ("$5", 0, 5, 5), ("null", 0, 0, None), ("###", 0, 0, None), ("(-5)", 0, -5, None), ("1 234", 0, 1234, None)]
    df = spark.createDataFrame([(c[0],) for c in cases], "t string")
    got = df.select(amounts.val_amount(F.col("t")), amounts.parse_amount(F.col("t")), amounts.to_dec(F.col("t"))).collect()
    assert [tuple(None if x is None else float(x) for x in r) for r in got] == [c[1:] for c in cases]


def test_positional(spark):
    amts = [("DP", 10), ("DP", 20), ("CP", 30), ("DP", 5), ("CP", 35), ("DP", 7), ("CP", 50)]
    rows = spark.createDataFrame([(1, "s", k, f, "", "", "c", D(a)) for k, (f, a) in enumerate(amts)], ROWS)
    assert [r.passed for r in total_check.positional_check(rows).orderBy("row_order").collect()] == [True, True, False]


@pytest.mark.parametrize(("outer", "want"), [(22, ["PASS", "PASS", "PASS"]), (23, ["PASS", "PASS", "PASS"]), (25, ["PASS", "PASS", ""])])
def test_nested(spark, outer, want):
    rows = [("DPG", None), ("DP", 10), ("DP", 5), ("CP", 15), ("DPG", None), ("DP", 7), ("CP", 7), ("CP", outer)]
    df = spark.createDataFrame([(1, k, f, None if a is None else D(a)) for k, (f, a) in enumerate(rows)], "table_id int, row_order int, flag string, amt decimal(38,4)")
    assert [r.status for r in nested.nested_totals(df).where("flag = 'CP'").orderBy("row_order").collect()] == want


def test_resolve(spark):
    chart = spark.createDataFrame([(11, 2, "Charges", "Governmental", 1), (13, 2, "Charges", "Business", 3), (14, 2, "Grants", "Business", 4)], "coa_id long, template int, name string, parent_name string, seq long")
    items = spark.createDataFrame([(0, 2, "Charges", "Governmental", None), (1, 2, "charges", "business", None), (2, 2, "Charges", None, "Business"), (3, 2, "Charges", "X", "Y"), (4, 2, "Grants", "X", "Y"), (5, 2, "Taxes", "X", "Y")], "k int, template int, datapoint string, parent string, section string")
    got = [(r.coa_id, r.status) for r in coa.resolve(items, chart).orderBy("k").collect()]
    assert got == [(11, "mapped"), (13, "mapped"), (13, "mapped"), (None, "ambiguous"), (14, "mapped"), (None, "unmapped")]


def test_gates(spark):
    df = spark.createDataFrame([(1, "PASS"), (1, "NOT APPLICABLE"), (2, "PASS"), (2, "REVIEW"), (3, "PASS"), (3, "NOT FOUND"), (4, "NOT APPLICABLE")], "g int, status string")
    assert {r.g: r.gate for r in gates.gate(df, ["g"]).collect()} == {1: "PASS", 2: "REVIEW", 3: "FAIL", 4: "REVIEW"}
    rows = spark.createDataFrame([("PASS", "REVIEW", "FAIL"), ("OCR REQUIRED", "FAIL", "PASS"), ("PASS", "x", "PASS")], "a string, b string, c string")
    assert [r[0] for r in rows.select(gates.overall(F.col("a"), F.col("b"), F.col("c"))).collect()] == ["FAIL", "OCR REQUIRED", "FAIL"]


def test_islands(spark):
    df = spark.createDataFrame([(1, x) for x in (72.0, 72.5, 84.0, 84.0, 96.0)], "d int, x double")
    assert sorted(r.centroid for r in gates.centroids(df, ["d"], "x", 9.9).collect()) == [72.25, 84.0, 96.0]


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, s string, n int")
    new = spark.createDataFrame([(2, None, 7), (3, "c", None)], "id int, s string, n int")
    assert sorted(upsert.upsert(old, new, "id").collect()) == sorted([(1, "a", 5), (2, "b", 7), (3, "c", None)])
    dim = spark.createDataFrame([(4, "x")], "id long, name string")
    names = spark.createDataFrame([("y",), ("x",), (None,), ("b",), ("y",)], "name string")
    assert sorted(upsert.get_or_create(dim, names, "id", "name").collect()) == [(4, "x"), (5, "b"), (6, "y")]


def test_statements(spark, tmp_path):
    doc = {"Metadata": {"Statement": "SNP"}, "Reporting Columns": ["GA", "BTA"], "Sections": {"Zeta": [{"COA Flag": "DP", "Row Items": "Cash", "COA Datapoint": "Cash", "GA": "1,000", "BTA": "-", "GA_coord": {"page": 1}}], "Alpha": [{"COA Flag": "cp", "Row Items": "Total", "COA Datapoint": "Total", "GA": "1,000", "BTA": "-"}]}}
    (tmp_path / "deal7_PROP_SNP_p3-4.json").write_text(json.dumps(doc))
    (tmp_path / "deal7_DSR_p9.json").write_text("{broken")
    rows = tidy(read_statements(spark, str(tmp_path))).orderBy("section_pos", "row_order", "col_pos").collect()
    assert [(r.deal, r.stmt_type, r.section, r.flag, r.label, r.col, r.raw) for r in rows][:2] == [("deal7", "PROP_SNP", "Zeta", "DP", "Cash", "GA", "1,000"), ("deal7", "PROP_SNP", "Zeta", "DP", "Cash", "BTA", "-")]
    assert rows[0].coord == '{"page":1}' and len(rows) == 4 and rows[2].flag == "CP"


def test_text(spark):
    df = spark.createDataFrame([("  City_of  X ", "03/31/2024")], "a string, b string")
    r = df.select(text.norm(F.col("a")), text.slug(F.col("a")), text.as_date(F.col("b")).cast("string")).first()
    assert tuple(r) == ("city of x", "city_of_x", "2024-03-31")


def test_stream(spark, tmp_path):
    from folio.streaming.logs import ingest

    src = str(tmp_path / "in")
    spark.createDataFrame([(1, "a"), (2, "b")], "pid int, v string").coalesce(1).write.parquet(src)
    version = str(tmp_path / "table")
    stream = lambda: spark.readStream.schema("pid int, v string").parquet(src)
    ingest(spark, stream(), version, "pid").awaitTermination()
    spark.createDataFrame([(2, "c")], "pid int, v string").coalesce(1).write.mode("append").parquet(src)
    ingest(spark, stream(), version, "pid").awaitTermination()
    assert sorted(spark.read.parquet(f"{version}/1").collect()) == [(1, "a"), (2, "c")]


def test_accepted_and_files(spark):
    rows = [(1, "CP", "PASS"), (1, "DP", "amount: FAIL"), (2, "cp ", "Skipped - no membership rule defined"), (2, "CP", None), (3, "CP", "GA: FAIL"), (4, "CP", "Skipped - self checked"), (5, "CP", "Skipped - no chain matched"), (6, "DP", "x")]
    df = spark.createDataFrame(rows, "file int, flag string, status string")
    assert {r.file for r in total_check.file_passes(df, ["file"]).where("passed").collect()} == {1, 2, 6}


def test_lookup_total(spark):
    names = ["Total assets and deferred outflows", "Total", "total assets", "Total Assets ", "Assets"]
    rows = spark.createDataFrame([(1, "s", k, "CP", n, n, "c", D(k)) for k, n in enumerate(names)], ROWS)
    assert total_check.lookup_total(rows, "Total Assets").first().amt == 3
    assert total_check.lookup_total(rows.where("row_order < 2"), "Total Assets").first().amt == 1
    assert total_check.lookup_total(rows.where("row_order = 0"), "Total Assets").count() == 0


def test_first_present_needs_all_columns(spark):
    rows = [(1, 0, "a", 5, 5), (1, 0, "b", 7, 9), (1, 1, "a", 5, 5), (1, 1, "b", 9, 9), (2, 0, "a", None, 5), (2, 0, "b", 9, 9), (2, 1, "a", 1, 5), (2, 1, "b", 9, 9), (3, 0, "a", None, 5)]
    df = spark.createDataFrame(rows, "table_id int, chain int, col string, computed int, reported int")
    assert {r.table_id: (r.chain, r.status) for r in total_check.first_present(df).collect()} == {1: (1, "PASS"), 2: (1, "a: FAIL"), 3: (None, "Skipped - no chain matched")}


def test_resolve_passes_blank_groups_over(spark):
    chart = spark.createDataFrame([(1, 1, "Cash", None, 1), (2, 1, "Cash", "Fund", 2), (3, 1, "", "Fund", 3)], "coa_id long, template int, name string, parent_name string, seq long")
    items = spark.createDataFrame([(0, 1, "Cash", None, " "), (1, 1, None, "Fund", None), (2, 1, " ", "Fund", "Fund"), (3, 1, "cash", "", "FUND")], "k int, template int, datapoint string, parent string, section string")
    assert [(r.coa_id, r.status) for r in coa.resolve(items, chart).orderBy("k").collect()] == [(None, "ambiguous"), (None, "unmapped"), (None, "unmapped"), (2, "mapped")]
