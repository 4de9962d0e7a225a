import itertools
import random
import re

import pytest
import xxhash

from folio.llm import op13_simhash as m

from .helpers import SF, noisy_texts, smallest_reachable, table


def fingerprint(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda x: x[0].lower(), text or ""))
    shingles = [w[i : i + k] for i in range(len(w) - k + 1)] if len(w) >= k else [w] * bool(w)
    h = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain(rows, k=4, radius=4):
    prints = [(i, fingerprint(t, k)) for i, t in rows]
    links = [(a, b) for (a, x), (b, y) in itertools.combinations(prints, 2) if (x ^ y).bit_count() <= radius]
    part = smallest_reachable({i for i, _ in rows}, links)
    return sorted((i, f"{x:016x}", part[i]) for i, x in prints)


def got(df):
    return sorted((r.doc_id, f"{r.print & (1 << 64) - 1:016x}", r.component_id) for r in df.collect())


@pytest.mark.parametrize(("radius", "seed"), [(4, 1), (2, 2), (8, 3)])
def test_equals_all_pairs(spark, radius, seed):
    rows = list(enumerate(noisy_texts(seed, n=200, words=300)))
    assert got(m.simhash(table(spark, rows), radius=radius)) == plain(rows, radius=radius)


def test_equals_all_pairs_on_the_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in m.op13_simhash(spark, SF).collect()) == plain(rows)


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_each_pair_within_the_radius_meets_in_a_table(radius):
    rng = random.Random(radius)
    tables = m.masks(radius)
    assert len(tables) == 2 ** (radius + 1) - 1
    for _ in range(3000):
        apart = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(apart & t & (1 << 64) - 1 == 0 for t in tables)


def test_links_of_many_close_fingerprints(spark, monkeypatch):
    """Large buckets are cut into tiles; clusters around centres, chains included."""
    monkeypatch.setattr(m, "TILE", 20)
    rng = random.Random(7)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(63)
        for _ in range(80):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(63), rng.choice([1, 2, 3, 5]))))
    nodes = list(enumerate(sorted(prints)))
    links = [(r.a, r.b) for r in m.near_links(table(spark, nodes, "node long, print long"), 4).collect()]
    assert all((dict(nodes)[a] ^ dict(nodes)[b]).bit_count() <= 4 for a, b in links)
    every = [(a, b) for (a, x), (b, y) in itertools.combinations(nodes, 2) if (x ^ y).bit_count() <= 4]
    assert smallest_reachable(range(len(nodes)), links) == smallest_reachable(range(len(nodes)), every)


def test_buckets_are_never_broadcast(spark, monkeypatch):
    """Spark sizes the nodes of all tables as the nodes' own file, which may lie below its limit for broadcasts when they don't fit the driver."""
    plans, stored = {}, m.stored
    monkeypatch.setattr(m, "stored", lambda df, name: plans.update({name: df._jdf.queryExecution().executedPlan().toString()}) or stored(df, name))
    m.near_links(stored(spark.range(50).selectExpr("id as node", "id as print"), "nodes"), 4)
    assert "Broadcast" not in plans["met"] and "SortMergeJoin" in plans["met"]


def test_cases(spark):
    rows = [(5, None), (3, ""), (9, " \n"), (4, "A b"), (6, "a B"), (None, "a b"), (None, "nowhere else"), (8, "x " * 60_000), (7, "a b"), (7, "other words than those of the rest"), (10, "Other words  than those of the rest")]
    out = {(r.doc_id, r.print): r.component_id for r in m.simhash(table(spark, rows)).collect()}
    assert {i for (i, p), c in out.items() if c == 3} == {3, 5, 9} and all(p == 0 for (i, p), c in out.items() if c == 3)
    assert [c for (i, _), c in out.items() if i in (4, 6, 7, 10)] == [4] * 5
    assert {c for (i, _), c in out.items() if i is None} == {4, None}
    assert m.simhash(table(spark, [])).count() == 0
    more = table(spark, [(1, "a b c", 5, 6, 7)], "doc_id int, text string, print int, node int, component_id int")
    assert [(r.doc_id, r.component_id) for r in m.simhash(more).collect()] == [(1, 1)]
