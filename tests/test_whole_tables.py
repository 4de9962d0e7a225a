"""Queries over all rows of their tables, and a statement that is never held whole."""

import random
from decimal import Decimal as D

import pandas as pd

from folio.operators import nested
from folio.plans.catalogue import QUERIES


def test_gate_and_chart_take_all_rows(spark, tmp_path):
    write = lambda rows, ddl, name: spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / f"{name}.parquet"))
    write([(1, 0, 1), (3, 1, 0), (4, 1, 0), (5, 0, 0)], "doc_id long, quality int, toxic int", "labels")
    write([(1, "a"), (3, "a"), (4, "b"), (5, "c")], "doc_id long, source string", "documents")
    assert {r.source: r.gate for r in QUERIES["gate_aggregate_all"](spark, str(tmp_path)).collect()} == {"a": "FAIL", "b": "PASS", "c": "REVIEW"}
    rng = random.Random(2)
    parts = [(k, rng.randrange(1, 51), rng.choice(["Tin", "Steel"]), rng.choice(["B1", "B2"])) for k in range(1, 300)]
    write(parts, "p_partkey long, p_size int, p_type string, p_brand string", "part")
    name = lambda k, t: f"{t} {k % 7}" if k % 3 else t
    chart = [(k, s % 5, name(k, t), b) for k, s, t, b in parts]
    want = {}
    for k, s, t, b in parts:
        dp = name(k, t) if k % 4 == 1 else name(k, t).upper()
        par, sec = [b.lower(), b, "none"][k % 3], b if k % 5 else "none"
        same = [c for c in chart if c[1] == s % 7]
        exact, loose = [c for c in same if c[2] == dp], [c for c in same if c[2].lower() == dp.lower()]
        tries = [[c for c in exact if c[3] == par], [c for c in loose if c[3].lower() == par.lower()], [c for c in exact if c[3] == sec], [c for c in loose if c[3].lower() == sec.lower()]]
        tries += [x if len(x) == 1 else [] for x in (exact, loose)]
        found = next((min(x)[0] for x in tries if x), None)
        want[k] = (found, "mapped" if found else "ambiguous" if loose else "unmapped")
    assert {r.p_partkey: (r.coa_id, r.status) for r in QUERIES["coa_resolve_all"](spark, str(tmp_path)).collect()} == want
    assert {s for _, s in want.values()} == {"mapped", "ambiguous", "unmapped"}


def whole(rows):
    """Statuses of one statement's (flag, amt)."""
    inner, totals, since, status = [], [], [], []
    close = lambda a, b: abs(a - b) <= 1
    for flag, amt in rows:
        verdict = None
        if flag == "DPG":
            inner, since = [], []
        elif flag == "DP":
            inner.append(amt)
            since.append(amt)
        else:
            if since and (close(sum(inner), amt) or close(sum(since), amt)):
                verdict, totals, inner = "PASS", [*totals, amt], []
            elif totals and (close(sum(totals), amt) or since and close(sum(totals) + sum(since), amt)):
                verdict, totals = "PASS", []
            else:
                verdict, totals = "FAIL", [*totals, amt]
            since = []
        status.append(verdict)
    for i in [i for i, s in enumerate(status) if s][-2:]:
        status[i] = status[i] if status[i] == "PASS" else ""
    return status


def test_statement_comes_in_many_batches(spark, monkeypatch):
    rng = random.Random(9)
    own = {t: [(rng.choice(["DP", "DP", "CP", "CP", "DPG"]), D(rng.randrange(0, 5))) for _ in range(n)] for t, n in ((1, 3000), (2, 1), (3, 40), (4, 2))}
    rows = [(t, i, f, a) for t, x in own.items() for i, (f, a) in enumerate(x)]
    rng.shuffle(rows)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    seen, check = spark.sparkContext.accumulator(0), nested._nesting

    def counted(batches):
        def each():
            for b in batches:
                assert isinstance(b, pd.DataFrame) and len(b) <= 50
                seen.add(1)
                yield b

        return check(each())

    monkeypatch.setattr(nested, "_nesting", counted)
    try:
        got = {(r.table_id, r.row_order): r.status for r in nested.nested_totals(spark.createDataFrame(rows, "table_id long, row_order int, flag string, amt decimal(38,4)")).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == {(t, i): s for t, x in own.items() for i, s in enumerate(whole(x))}
    assert seen.value > 60
