"""Cells of statements to facts: by hand, and by their plan."""

import re

from pyspark.sql import functions as F

from folio.operators import ingest

ROWS = "deal int, file int, stmt_type string, section string, section_pos int, row_order int, flag string, datapoint string, col string, col_pos int, raw string, coord string"


def tables(spark, rows):
    chart = spark.createDataFrame([(1, 0, "Cash", "Assets", 1), (2, 0, "Cash", "Other", 2), (3, 0, "Debt", "Owed", 3)], "coa_id int, template int, name string, parent_name string, seq int")
    return spark.createDataFrame(rows, ROWS), chart, spark.createDataFrame([("SNP", 0)], "stmt_type string, template int")


def cells(deal, file, kind, at, flag, name, *raws):
    return [(deal, file, kind, "S", 0, at, flag, name, f"c{k}", k, raw, None) for k, raw in enumerate(raws)]


LINES = [
    *cells(1, 7, "SNP", 0, "DPG", "Assets", None, None), *cells(1, 7, "SNP", 1, "DP", "Cash", "5", "6"), *cells(1, 7, "SNP", 2, "DP", "Debt", "-", "8"),
    *cells(1, 8, "XYZ", 0, "DP", "Cash", "9"), *cells(1, 6, "SNP", 0, "DP", "Cash", "3"), *cells(2, 9, "SNP", 0, "DP", "Rest", "-"), *cells(None, 9, "SNP", 0, "DP", "Cash", "1"),
]


def test_facts_and_counts(spark):
    rows, chart, templates = tables(spark, LINES)
    stored = ingest.facts(rows, chart, templates)
    got = sorted((r.deal, r.file, r.row_order, r.category, r.coa_id, r.value, r.disp_seq, r.status) for r in stored.collect())
    # items are numbered by file; cells of an item share its number, and one of two blank cells doesn't take the other with it
    want = [(1, 6, 0, "c0", None, "3", 1, "ambiguous"), (1, 7, 1, "c0", 1, "5", 2, "mapped"), (1, 7, 1, "c1", 1, "6", 2, "mapped"), (1, 7, 2, "c1", 3, "8", 3, "mapped")]
    assert got == want
    counts = {r.deal: tuple(r)[1:] for r in ingest.ingest_counts(stored, rows).collect()}
    assert counts[1] == (3, 4, 2, 1, 0) and counts[2] == (1, 0, 0, 0, 0)


def test_cells_are_sorted_once_and_not_joined_to_their_items(spark):
    rows, chart, templates = tables(spark, LINES)
    plan = ingest.facts(rows, chart, templates)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(deal#\d+, file#\d+", plan)) == 1 and "HashAggregate(keys=[deal" not in plan
    assert not re.search(r"Join.*\[deal#", plan)
    counts = ingest.ingest_counts(ingest.facts(rows, chart, templates).withColumn("status", F.col("status")), rows)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in counts
