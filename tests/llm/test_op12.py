import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from folio.llm import marks
from folio.llm import op12_collocations as m

from .helpers import SF, table

DDL = "doc_id long, text string, lang string"


def plain(rows, most=5, least=100, first=2000):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]+", lambda x: x[0].lower(), text or "")):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for size in range(1, most + 1):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i : i + size])] += 1
    often = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    inner = {(lang, w[i:j]): a for (lang, w), a in sorted(often.items(), key=lambda x: x[1]) for i in range(len(w)) for j in range(i + 1, len(w) + 1) if j - i < len(w)}
    found = {}
    for (lang, w), a in often.items():
        if inner.get((lang, w), 0) < a:
            score, _, l, r = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, own in found.items() for i, (s, a, p, l, r) in enumerate(sorted(own)[:first]))


def got(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def phrases(seed, n):
    rng = random.Random(seed)
    fixed = ["New  york City", "à la carte", "one two three four five six", "by and large"]
    for i in range(n):
        words = [rng.choice(["a", "B", "c", "Über", "d e", "f"]) for _ in range(rng.randrange(12))]
        words.insert(rng.randrange(len(words) + 1), rng.choice(fixed))
        yield i, "".join(w + rng.choice([" ", "  ", "\t", " ", ", ", ".", "\n", ";", " \r\n"]) for w in words), rng.choice(["en", "de", None])


@pytest.mark.parametrize(("least", "first", "work"), [(3, 2000, 4_000_000), (10, 7, 60), (1, 40, 500)])
def test_equals_a_plain_count(spark, monkeypatch, least, first, work):
    monkeypatch.setattr(m, "WORK", work)
    rows = list(phrases(least, 250))
    assert got(m.collocations(table(spark, rows, DDL), least=least, first=first)) == plain(rows, least=least, first=first)


def test_equals_a_plain_count_with_a_full_bitmap(spark, monkeypatch):
    monkeypatch.setattr(marks, "LEAST_BITS", 4)
    monkeypatch.setattr(marks, "MOST_BITS", 4)
    rows = list(phrases(9, 150))
    assert got(m.collocations(table(spark, rows, DDL), least=2)) == plain(rows, least=2)


def test_segments_of_a_bitmap(spark, monkeypatch):
    monkeypatch.setattr(marks, "SEGMENT", 1 << 10)
    hashes = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    bitmap = np.frombuffer(marks.bitmap_of(table(spark, [(int(h),) for h in hashes], "gram long"), "gram").value, np.uint8)
    assert marks.marked(bitmap, hashes.view(np.uint64)).all()
    others = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 5000)
    assert marks.marked(bitmap, others.view(np.uint64)).mean() < 0.1


def test_hashes_are_those_of_spark(spark):
    rows = [(-5, 7), (0, 0), (2**63 - 1, -(2**63)), (123456789, -987654321)]
    want = [r.h for r in table(spark, rows, "a long, b long").select(F.xxhash64("a", "b").alias("h")).collect()]
    a, b = np.array(rows, np.int64).T
    assert marks.chained(a.copy().view(np.uint64), b.copy().view(np.uint64)).view(np.int64).tolist() == want


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = sorted(con.execute(m.ORACLE).fetchall())
    assert got(m.op12_collocations(spark, SF)) == want and want


def test_scores_of_large_counts_are_exact():
    assert 1000 * 10**13 * 10**14 < 10**38  # what the Decimal products hold


def test_cases(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "a b " * 200_000, None), (3, "A B", None), (None, "a b", "und")]
    assert got(m.collocations(table(spark, rows, DDL), least=200_000, most=2)) == plain(rows, least=200_000, most=2)
    assert m.collocations(table(spark, [], DDL)).count() == 0
    more = table(spark, [("x y", "en", 1, 2)], "text string, lang string, language int, gram int")
    assert got(m.collocations(more, least=1)) == [("en", 1, "x y", 1, 1, 1, 2, 2000)]
