import hashlib
import random
import re
from functools import reduce

import duckdb
import pytest
from pyspark.sql import functions as F

from folio.llm import op11_fill_middle as m

from .helpers import SF, table


def plain(doc_id, text, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, mid, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return doc_id, n, "spm", len(p), len(mid), f"<S>{s}<P>{p}<M>{mid}"
    return doc_id, n, "psm", len(p), len(mid), f"<P>{p}<S>{s}<M>{mid}"


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()), key=repr)


def texts(seed, n, most):
    rng = random.Random(seed)
    for i in range(n):
        marks = ["<P>", "<S>", "<M>"] if rng.random() < 0.2 else ["<P", "<", ">", "P>"]
        yield i, "".join(rng.choice(["\n", "ab", "ü", "\r\n", "漢", "😀", *marks]) for _ in range(rng.randrange(most)))


@pytest.mark.parametrize(("chunk", "fan"), [(3, 2), (1, 3), (7, 64), (100_000, 64)])
def test_equals_a_plain_version(spark, monkeypatch, chunk, fan):
    monkeypatch.setattr(m, "CHUNK", chunk)
    monkeypatch.setattr(m, "FAN", fan)
    rows = [*texts(chunk, 120, 30), (3, "again\nand again"), (3, None), (None, "x\ny\nz\n"), (900, "")]
    out = m.fill_middle(table(spark, rows))
    assert got(out) == sorted((plain(*r) for r in rows), key=repr)
    back = out.select("doc_id", m.restored(F.col("output"), F.col("form")).alias("t")).collect()
    assert sorted(map(tuple, back), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)


@pytest.mark.parametrize(("rate", "spm"), [(30, 50), (100, 0), (60, 100)])
def test_rates(spark, monkeypatch, rate, spm):
    monkeypatch.setattr(m, "CHUNK", 20)
    rows = list(texts(rate, 80, 40))
    assert got(m.fill_middle(table(spark, rows), rate=rate, spm=spm)) == sorted((plain(*r, rate, spm) for r in rows), key=repr)


def test_functions_are_those_of_a_walk_and_compose():
    rng = random.Random(3)

    def step(state, c):
        return (0 if c == "\n" else 4) + m._mark_step(state % 4, c)

    for _ in range(2000):
        chunk = "".join(rng.choice("\n<PSM>a") for _ in range(rng.randrange(7)))
        to, units = m.transitions(chunk)
        for s in range(m.STATES):
            state, opened = s, 0
            for c in chunk:
                opened += state < 4
                state = step(state, c)
            assert (to[s], units[s]) == (state, opened), (chunk, s)
        at = rng.randrange(len(chunk) + 1)
        (t1, u1), (t2, u2) = m.transitions(chunk[:at]), m.transitions(chunk[at:])
        assert [t2[x] for x in t1] == to and [n + u2[x] for n, x in zip(u1, t1, strict=True)] == units
    assert reduce(m._mark_step, "<P>", 0) == m.FOUND


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(m.ORACLE).fetchall()
    out = m.op11_fill_middle(spark, SF)
    assert sorted(map(tuple, out.collect())) == sorted(want)
    assert out.where("form <> 'plain'").count() > 100


def test_cases(spark):
    assert m.fill_middle(table(spark, [])).count() == 0
    long = "line\n" * 60_000
    more = table(spark, [(1, long, 5, 6), (2, "a<P>b", 5, 6)], "doc_id int, text string, row int, output int")
    assert got(m.fill_middle(more)) == sorted([plain(1, long), plain(2, "a<P>b")], key=repr)
