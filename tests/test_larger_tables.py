"""Operators that have to grow no faster than their input: against plain walks and all pairs, and by their plans."""

import random
import re
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from folio.operators import document_checks, matching, opinions, page_ranges, statement_finder, statement_rules
from folio.operators.statement_check import check_statements
from folio.sources.store import KeyedStore


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def best(spark, wanted, there, **more):
    made = spark.createDataFrame(wanted, "row_id long, block int, w double"), spark.createDataFrame(there, "id long, block int, v double, c int")
    score = 50 + F.when(F.col("row_id") % 3 == F.col("id") % 3, 20).otherwise(0) + F.when(F.col("row_id") % 4 == F.col("c"), 5).otherwise(0) + F.when(F.col("v") > F.col("w"), 10).otherwise(0)
    return matching.best_scored(*made, "block", score, [F.col("v"), F.col("id")], ["id", "c"], **more)


def test_best_scored_by_first_candidates_equals_all_pairs(spark):
    rng = random.Random(5)
    some = lambda: rng.choice([None, float(rng.randrange(6))])
    wanted = [(i, rng.choice([0, 1, 2, None]), some()) for i in range(150)]
    there = [(i, rng.choice([0, 1, 3, None]), some(), rng.choice([0, 1, 2, None])) for i in range(90)]
    equal = [(F.col("row_id") % 3, F.col("id") % 3), (F.col("row_id") % 4, F.col("c"))]
    got, want = (sorted(map(tuple, best(spark, wanted, there, **m).collect())) for m in ({"equal": equal}, {}))
    assert got == want and len(want) > 50


def test_best_scored_makes_no_pairs(spark):
    """A block of 10^10 pairs."""
    wanted = spark.range(100_000).select(F.col("id").alias("row_id"), F.lit(1).alias("block"))
    there = spark.range(100_000).select("id", F.lit(1).alias("block"))
    score = F.when(F.col("row_id") % 10 == F.col("id") % 10, 1).otherwise(0)
    out = matching.best_scored(wanted, there, "block", score, [F.col("id")], ["id"], [(F.col("row_id") % 10, F.col("id") % 10)])
    assert out.agg(F.count("*"), F.sum(F.expr("score = 1 and id = 99990 + row_id % 10").cast("int"))).first() == (100_000, 100_000)


def walked(part):
    rows = sorted(([*r, False] for r in part), key=lambda r: r[0])
    for anchor in [r for r in rows if r[1] == "CP" and (r[2] or "").strip().lower().startswith("total") and r[3] is not None and r[4] is not None]:
        over = [sum(r[c] for r in rows if r[1] == "DP" and r[c] is not None) - anchor[c] for c in (3, 4)]
        if over[0] == -over[1]:
            for r in rows:
                here = 3 if r[4] is None else 4
                if r[1] == "DP" and (r[3] is None) != (r[4] is None) and r[here] == r[5] == over[here - 3]:
                    r[3], r[4], r[6] = r[4], r[3], True
                    break
    return rows


def test_repair_shifts_equals_a_walk_without_python(spark):
    rng, rows = random.Random(2), []
    for t in range(300):
        items = [(rng.choice("ab"), rng.randrange(4)) for _ in range(rng.randrange(5))]
        for k, (c, v) in enumerate(items):
            rows.append((t, None if t % 7 == 0 else "s", k, "DP", "x", v if c == "a" else None, v if c == "b" else rng.choice([None, None, None, 1]), rng.choice([v, v, v, None])))
        for k in range(rng.randrange(4)):
            off = rng.choice([-2, -1, 0, 1, 2])
            a, b = (sum(v for c, v in items if c == x) for x in "ab")
            rows.append((t, None if t % 7 == 0 else "s", 10 + k, "CP", rng.choice([" Total", "Sum", None]), rng.choice([a + off] * 5 + [None]), b - off, a + b))
    df = spark.createDataFrame([tuple(D(x) if k > 4 and x is not None else x for k, x in enumerate(r)) for r in rows], "table_id int, section string, row_order int, flag string, label string, a decimal(38,4), b decimal(38,4), total decimal(38,4)")
    out = statement_rules.repair_shifts(df)
    want = sorted(((t, *r) for t in range(300) for r in walked([r[2:] for r in rows if r[0] == t])), key=str)
    got = sorted(((r[0], *[int(x) if isinstance(x, D) else x for x in r[2:]]) for r in out.collect()), key=str)
    assert got == want and sum(r[-1] for r in got) > 10
    fresh = plan(statement_rules.repair_shifts(df))
    assert "Pandas" not in fresh and fresh.count("Exchange hashpartitioning") == 1


def test_statement_check_moves_rows_once(spark):
    rows = spark.createDataFrame([(1, "SNP", "A", "s", 0, "CP", "x", "Total Assets", "c", 0, D(1))], "doc_id long, stmt_type string, table_id string, section string, row_order int, flag string, label string, datapoint string, col string, col_pos int, amt decimal(38,4)")
    told = plan(check_statements(rows))
    assert told.count("Exchange hashpartitioning") == 1 and "Window" not in told and "Sort" not in told.replace("SortAggregate", "") and "SortAggregate" not in told


@pytest.mark.parametrize(("kind", "lows"), [("long", [-5, 0, 3, 3000000000]), ("int", [1]), ("int", []), ("string", ["", "a'b", "b\\", "ü"]), ("double", [-1.5, 0.1, 7.0])])
def test_a_range_is_found_by_halving(spark, tmp_path, kind, lows):
    keys = [None, *lows, *(["z", "A", "a"] if kind == "string" else [-9, 2, 10**9] if kind != "double" else [-9.0, 0.2, 1e300])]
    store = KeyedStore(spark, str(tmp_path), "k")
    got = spark.createDataFrame([(k,) for k in keys], f"k {kind}").select("k", store._place([None, *lows]).alias("p")).collect()
    assert [(r.k, r.p) for r in got] == [(k, 0 if k is None else sum(x <= k for x in lows)) for k in keys]


def test_many_ranges_take_few_steps(spark, tmp_path):
    """A million keys in 20,000 ranges."""
    place = KeyedStore(spark, str(tmp_path), "id")._place([None, *range(50, 1_000_000, 50)])
    assert spark.range(1_000_000).agg(F.count_if(place == F.floor(F.col("id") / 50))).first()[0] == 1_000_000


def test_only_the_wanted_statements_are_tested(spark):
    text = "Statement of Net Position\nTotal assets 1,234\nTotal liabilities 5\nNet position\n"
    pages = spark.createDataFrame([(1, 1, text), (1, 2, "Balance sheet, governmental funds\nAssets\nFund balances\n" + "1,234 " * 9), (1, 3, "Statement of Activities\nProgram revenues\nexpenses")], "doc_id long, page int, text string")
    every = sorted(map(tuple, page_ranges.statement_pages(pages, 1).collect()))
    some = page_ranges.statement_pages(pages, 1, statements=("SNP", "SOA"))
    assert sorted(map(tuple, some.collect())) == [r for r in every if r[1] in ("SNP", "SOA")] != [] and len(every) > len(some.collect())
    assert "Join" not in plan(page_ranges.statement_pages(pages, 1, statements=("SNP", "SOA")))
    with pytest.raises(ValueError):
        page_ranges.statement_pages(pages, 1, statements=("XYZ",))


def test_auditor_reads_lines_once(spark):
    lines = spark.createDataFrame([(1, 0, 0, "by Kpmg")], "doc_id int, page int, line int, text string")
    wanted = spark.createDataFrame([(1, "KPMG LLP (Ann Lee)")], "doc_id int, auditor string")
    told = plan(document_checks.auditor(lines, wanted))
    assert told.count("Exchange hashpartitioning") <= 5 and "explode" not in told and told.count("MapInPandas") == 1


def dropped(value, total):
    """A lost digit by trying every digit in every place."""
    if min(total * D("0.8"), total * D("1.2")) <= value <= max(total * D("0.8"), total * D("1.2")):
        return value, "ok"
    text, sign = str(abs(int(value))), -1 if value < 0 else 1
    fits = {x for p in range(len(text) + 1) for d in "0123456789" for x in [sign * D(text[:p] + d + text[p:])] if abs(x - total) <= 1}
    return (fits.pop(), "repaired") if value == int(value) and len(fits) == 1 else (value, "fail")


def test_digit_drop_equals_every_digit_tried_without_arrays(spark):
    rng, pairs = random.Random(4), []
    for _ in range(3000):
        n = rng.choice([0, 1, 2, 9, 10, 11, 99, 100, 1000, rng.randrange(10**6), rng.randrange(10**12), 10**25 + rng.randrange(10**9)])
        text = str(n)
        at = rng.randrange(len(text))
        short = int(rng.choice([text[:at] + text[at + 1 :], text, text[at:]]) or 0)
        sign = rng.choice([1, 1, -1])
        pairs.append((D(sign * short) + rng.choice([0, 0, 0, D("0.5")]), sign * rng.choice([1, 1, 1, -1]) * n + rng.choice([D(0), D(1), D(-1), D("0.5"), D("-0.75"), D("1.5")])))
    pairs += [(D(v), D(t)) for v in range(-12, 13) for t in range(-25, 26)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, v decimal(38,4), t decimal(38,4)")
    made = statement_rules.digit_drop(F.col("v"), F.col("t"))
    got = [tuple(r.x) for r in sorted(df.select("i", made.alias("x")).collect())]
    assert got == [dropped(*p) for p in pairs] and {s for _, s in got} == {"ok", "repaired", "fail"}
    assert "lambda" not in plan(df.select(made.alias("x")))
    assert spark.range(1).select(statement_rules.digit_drop(F.lit(None).cast("decimal(38,4)"), F.lit(1).cast("decimal(38,4)")).alias("x")).first().x is None


def test_finder_moves_lines_once(spark):
    lines = spark.createDataFrame([(1, 0, 0, "Balance Sheet")], "doc_id int, page int, line int, text string")
    wanted = spark.createDataFrame([(1, "LG", (6, 2021))], "doc_id int, sector string, fye struct<month:int,year:int>")
    told = plan(statement_finder.find_statements(lines, wanted))
    assert len(re.findall(r"Exchange hashpartitioning\(doc_id#\d+, page#\d+", told)) == 1


def test_titles_bound_to_ends_are_tried_in_every_stretch(spark):
    tops = spark.createDataFrame([(["x", "Balance", "Sheet", "y"],), (["x", "old Balance", "Sheet", "y"],), (["Balance Sheet"],), ([],)], "tops array<string>")
    for title, want in ((r"^balance sheet$", [True, False, True, False]), (r"\bbalance sheet\b", [True, True, True, False])):
        s = statement_finder.Statement("S", ("LG",), (title,), ("x",))
        assert [r[0] for r in tops.coalesce(1).select(statement_finder._titled(F.col("tops"), s)).collect()] == want


def test_plain_equals_its_full_form(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice("aB1  \t\n\u00a0'’‘é") for _ in range(rng.randrange(12))) for _ in range(2000)] + [None]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    full = F.trim(F.regexp_replace(F.translate("x", "’‘", "''"), "[\\s\u00a0]+", " "))
    assert df.where(~opinions.plain(F.col("x")).eqNullSafe(full)).count() == 0
