"""Label rules: each of them decides some label; the automaton against plain tests of substrings."""

import random

from folio.operators import chart_rules as m

DDL = "flag string, section string, label string"
RULES = m.POSITION_RULES


def plain(stage, flag, section, label):
    """The first rule that holds, by looking for each phrase on its own."""
    prefix, _, suffix = label.rpartition(":")
    text = {"label": " " + m.folded(label), "suffix": " " + m.folded(suffix)}
    above = " " + m.folded(prefix.replace(":", " "))
    for r in RULES:
        if r.stage != stage or r.flag != flag or r.section not in (None, section) or r.exact and text[r.part][1:] not in r.exact:
            continue
        if r.under and not any(f" {p}" in above for p in r.under) or any(f" {p}" in text[r.part] for p in r.without):
            continue
        if all(any(f" {p}" in text[r.part] for p in g) for g in r.groups):
            return r.name
    return None


def label_of(r):
    """A label that the rule holds for."""
    if r.exact:
        return r.exact[0]
    heading = f"{r.under[-1]}: " if r.under else ""
    return heading + " ".join(g[-1] for g in r.groups) + ("" if r.groups else "x")


def test_each_rule_decides_some_label(spark):
    sections = ["Assets", "Liabilities", "Net Position", "Deferred Inflows of Resources", "Deferred Outflows of Resources"]
    rows = [(r.flag, r.section or s, label) for r in RULES for s in sections[: 1 if r.section else 5] for label in {label_of(r), label_of(r) + " zz", *r.exact, *[p for g in r.groups[:1] for p in g], *[f"{a} {b}" for a in (r.groups[0] if r.groups else ()) for b in (r.groups[1] if len(r.groups) > 1 else ())]}]
    got = m.datapoints(spark.createDataFrame(rows, DDL), spark.createDataFrame([], "flag string, section string, datapoint string")).collect()
    want = {r: plain(1, *r) or plain(2, *r) or "last" for r in rows}
    assert {(r.flag, r.section, r.label): r.rule for r in got} == want
    assert {r.name for r in RULES} == set(want.values()) - {"last"}


def test_equals_plain_tests_on_mixed_labels(spark):
    rng = random.Random(2)
    words = sorted({p for r in RULES for g in (*r.groups, r.without, r.under, r.exact) for p in g})
    rows = list({(rng.choice(["DP", "CP", "DPG"]), rng.choice(["Assets", "Liabilities", "Net Position"]), "".join(rng.choice(words) + rng.choice([" ", ", ", ": ", " non-current ", " - "]) for _ in range(rng.randrange(1, 5)))) for _ in range(1500)})
    got = m.datapoints(spark.createDataFrame(rows, DDL), spark.createDataFrame([], "flag string, section string, datapoint string")).collect()
    assert {(r.flag, r.section, r.label): r.rule for r in got} == {r: plain(1, *r) or plain(2, *r) or "last" for r in rows}


def test_order_of_what_decides(spark):
    chart = spark.createDataFrame([("DP", "Assets", "Bridge  works"), ("DP", "Liabilities", "bridge works"), ("DP", "Other", "Cash"), (None, "Assets", "x"), ("DP", "Assets", "Prepaid rent")], "flag string, section string, datapoint string")
    rows = [
        ("DP", "Assets", "Bridge works", "Bridge  works", "chart"), ("DP", "Net Position", "BRIDGE-works", "Bridge  works", "chart"), ("DP", "Liabilities", "Group: bridge works", "bridge works", "suffix"),
        ("DP", "Assets", "Prepaid rent", "Prepaid rent", "chart"), ("DP", "Assets", "Prepaid tax", "Prepaid Items", "A14"), ("DP", "Assets", "Restricted: prepaid rent", "Restricted Assets - Current", "C8.3"),
        ("DP", "Net Position", "zzz", "Other_Net_Position", "last"), ("CP", "Assets", "zzz", "", "last"), ("DPG", None, None, "Other_DPG", "last"), (None, "Assets", "Assets", "", "last"), ("CP", "Net Position", "Total fund balance", "", "C2.0"),
        ("CP", "x", "Total liabilities, deferred inflows of resources, and net position", "Total Liabilities, Deferred Inflows of Resources, and Net Position", "C2.t0"), ("CP", "x", "Total liabilities and deferred inflows of resources", "Total Liabilities and Deferred Inflows of Resources", "C2.t1"),
        ("DP", "Liabilities", "Bonds payable, non-current", "Long-term Debt - Noncurrent", "L3"), ("DP", "Liabilities", "Performance bonds, current", "Other_Liabilities", "last"), ("DP", "Assets", "x" * 100_000, "Other_Assets", "last"),
    ]
    twice = [r[:3] for r in rows] * 2
    got = m.datapoints(spark.createDataFrame(twice, DDL).selectExpr("*", "label as datapoint", "1 as own"), chart)
    assert sorted(map(str, ((r.flag, r.section, r.label, r.datapoint, r.rule) for r in got.collect()))) == sorted(map(str, rows * 2))
    assert got.columns == ["flag", "section", "label", "own", "datapoint", "rule"]
    assert m.datapoints(spark.createDataFrame([], DDL), chart).count() == 0
