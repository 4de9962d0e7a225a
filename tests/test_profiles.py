"""Profiles, presence, chart texts and settled steps on small tables."""

import itertools

from folio.operators import profiles as m


def test_what_looks_like_a_number(spark):
    yes = ["1", "1,234", "$ 5", "(7)", "-3", "1.5", "5.", ".5", " 2 ", "1-2"]
    no = ["", " ", "-", "–", "—", "n/a", "1.2.3", ".", None, "5%", "12a"]
    rows = spark.createDataFrame([(x,) for x in yes + no], "v string").select("v", m.looks_numeric(m.F.col("v")).alias("n")).collect()
    assert {r.v for r in rows if r.n} == set(yes) and len(rows) == len(yes) + len(no)


def test_profiles_merge_in_any_order(spark):
    cells = [("f", c, p, v) for p, c in enumerate("abc") for v in ("1", "x", None, str(p))] + [("g", "a", 9, "")]
    whole = spark.createDataFrame(cells, "file string, column string, place int, value string")
    want = sorted(tuple(r)[:6] for r in m.column_profiles(whole, ["file"]).drop("sketch").collect())
    for order in itertools.permutations(range(3)):
        parts = [m.column_profiles(spark.createDataFrame(cells[i::3], whole.schema), ["file"]) for i in order]
        merged = m.merged_profiles(parts[0].union(parts[1]).union(parts[2]), ["file"])
        assert sorted(tuple(r)[:6] for r in merged.drop("sketch").collect()) == want
        assert {r[0] for r in merged.where("file = 'f' and column = 'b'").selectExpr("hll_sketch_estimate(sketch)").collect()} == {2}  # blanks aren't values
    assert m.column_profiles(whole.limit(0), ["file"]).count() == 0


def test_reporting_columns_end_at_the_status(spark):
    names = ["Section", "COA Flag", "Row Items", "COA Datapoint", "Governmental", "Total Items", " Unnamed: 2", "", "FYE", "Total", "Total Check Status", "Later"]
    cells = [("f", c, i, "1") for i, c in enumerate(names)] + [("none", "Total", 0, "1"), ("end", "COA Datapoint", 0, "1"), ("end", "A", 1, ""), ("end", "_x", 2, "1"), ("end", "B", 3, "1")]
    got = m.reporting_columns(m.column_profiles(spark.createDataFrame(cells, "file string, column string, place int, value string"), ["file"]), ["file"])
    assert sorted((r.file, r.column) for r in got.collect()) == [("end", "A"), ("f", "Governmental"), ("f", "Total")]
    numeric = m.numeric_columns(m.column_profiles(spark.createDataFrame(cells, "file string, column string, place int, value string"), ["file"]))
    assert "FYE" not in {r.column for r in numeric.collect()} and "A" not in {r.column for r in numeric.where("file = 'end'").collect()}


def test_presence_and_counts(spark):
    rows = spark.createDataFrame([("f", "Metadata"), ("f", "Odd"), ("f", "Odd"), ("g", "Sections"), ("g", "Metadata"), ("g", "Reporting Columns"), ("h", None)], "file string, section string")
    got = {r.file: (r.missing, r.extra) for r in m.presence(rows, ["file"], "section", m.TOP_KEYS).collect()}
    assert got == {"f": (["Reporting Columns", "Sections"], ["Odd"]), "g": ([], []), "h": (m.TOP_KEYS, [])}
    assert {tuple(r) for r in m.section_counts(rows, ["file"]).collect()} == {("f", 2, 3), ("g", 3, 3), ("h", 0, 1)}
    assert [tuple(r) for r in m.tally(rows, "file").collect()] == [("f", 3), ("g", 3), ("h", 1)]


def test_chart_texts(spark):
    text = ["Statement | Flag | Name | A | B", "SNP|SOA | DP | Cash | 1 | 2", "SOA | CP | Total | 1", " ", "SNPX | DP | No | 1 | 2", "DEBT | SNP | x | y | z"]
    lines = spark.createDataFrame(list(enumerate(text)), "line int, text string")
    assert [r.line for r in m.chart_lines_for(lines, m.F.lit("SNP")).orderBy("line").collect()] == [0, 1]
    assert [r.line for r in m.chart_lines_for(lines, m.F.lit("SOA")).orderBy("line").collect()] == [0, 1, 2]
    assert m.chart_lines_for(lines, m.F.lit("")).count() == 0
    assert [r.text for r in m.compressed_chart(lines).orderBy("line").collect()] == ["DP | Cash", "DP | No", "SNP | x"]


def test_a_crash_is_a_failure(spark):
    steps = spark.createDataFrame([(1, "a", "PASS", 90.0, None), (1, "a", "PASS", 95.0, None), (1, "b", "PASS", 80.0, "boom"), (2, "a", None, 3.0, None)], "doc int, step string, status string, score double, error string")
    got = {(r.doc, r.step): (r.status, r.score, r.note) for r in m.settled_steps(steps, ["a", "b"], ["doc"]).collect()}
    assert got == {(1, "a"): ("PASS", 95.0, ""), (1, "b"): ("FAIL", 0.0, "crashed: boom"), (2, "a"): ("FAIL", 0.0, "no result"), (2, "b"): ("FAIL", 0.0, "no result")}
