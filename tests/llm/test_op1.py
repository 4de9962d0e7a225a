import re

import pytest

from folio.llm.op1_ngram_join import Bands, ngram_join, op1_ngram_join

from .helpers import SF, noisy_texts, smallest_reachable, table


def plain(rows, k, num, den):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    part = smallest_reachable(ids, links)
    return {i: (len(sets[i]), part[i]) for i in ids}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize(("k", "num", "den", "seed"), [(3, 90, 100, 1), (5, 80, 100, 2), (2, 60, 100, 3)])
def test_equals_all_pairs(spark, k, num, den, seed):
    rows = list(enumerate(noisy_texts(seed, n=150, words=120)))
    assert result(ngram_join(table(spark, rows), k, num, den)) == plain(rows, k, num, den)


def test_equals_all_pairs_on_the_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert result(op1_ngram_join(spark, SF)) == plain(rows, 3, 90, 100)


def test_tiles_of_large_blocks(spark, monkeypatch):
    import folio.llm.op1_ngram_join as m

    monkeypatch.setattr(m, "TILE_TEXTS", 7)
    monkeypatch.setattr(m, "BLOCK_TEXTS", 5)
    rows = list(enumerate(noisy_texts(5, n=120, words=60)))
    assert result(ngram_join(table(spark, rows), 3, 80, 100)) == plain(rows, 3, 80, 100)


def test_bands_hold_all_linked_sizes():
    b = Bands(90, 100)
    for n in range(1, 3000):
        assert b.band(n * 100 // 90) - b.band(n) in (0, 1)


def test_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "A b"), (5, "a B"), (5, "a B"), (None, "a b"), (6, "x " * 50_000), (7, "X"), (8, "x")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join(table(spark, rows), 3, 90, 100).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (5, 1, 4), (None, 1, 4), (6, 1, 6), (7, 1, 7), (8, 1, 7)], key=str)
    assert ngram_join(table(spark, []), 3, 90, 100).count() == 0
    more = table(spark, [(1, "a b c", 5, 6, 7)], "doc_id int, text string, keys int, s1 int, component_id int")
    assert result(ngram_join(more, 3, 90, 100)) == {1: (1, 1)}


@pytest.mark.parametrize("parts", [1, 7])
def test_stars_connect_each_key_over_all_partitions(spark, parts):
    import random

    from folio.llm.op1_ngram_join import stars

    rng = random.Random(parts)
    rows = [(rng.choice([-5, 0, 0, 0, 0, 3, rng.randrange(200)]), rng.randrange(300)) for _ in range(2000)]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = [(r.a, r.b) for r in stars(table(spark, rows, "key long, doc_id long")).collect()]
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ids = {i for _, i in rows}
    first = {k: min(i for j, i in rows if j == k) for k, _ in rows}
    assert smallest_reachable(ids, got) == smallest_reachable(ids, [(first[k], i) for k, i in rows])
    assert len(got) <= len(set(rows)) + 2 * parts


def test_equals_all_pairs_where_joins_change_while_they_run(spark):
    """Merge joins by the plan that adaptive execution turns into broadcast ones."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10m")
    rows = list(enumerate(noisy_texts(11, n=400, words=150)))
    try:
        assert result(ngram_join(table(spark, rows).repartition(5), 3, 90, 100)) == plain(rows, 3, 90, 100)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_bitmaps_bound_the_difference():
    """XOR of parity bitmaps of any two sizes, folded, never has more bits than the sets differ in."""
    import numpy as np

    from folio.llm.op1_ngram_join import folded, parity

    rng = np.random.default_rng(4)
    for _ in range(200):
        one = np.unique(rng.integers(0, 2**63, rng.integers(1, 900)).astype(np.uint64))
        two = np.unique(np.concatenate([one[: rng.integers(0, len(one) + 1)], rng.integers(0, 2**63, rng.integers(0, 900)).astype(np.uint64)]))
        maps = folded([parity(one), parity(two)])
        apart = int(np.bitwise_count(maps[0] ^ maps[1]).sum())
        assert apart <= len(np.setxor1d(one, two)) and (apart - len(one) - len(two)) % 2 == 0


def test_chains_of_chance_keys_make_no_arrays(spark, monkeypatch):
    """Texts that share a passage but aren't near end as groups of their own before arrays are made."""
    import folio.llm.op1_ngram_join as m

    made = []
    pairs = m.tile_pairs
    monkeypatch.setattr(m, "tile_pairs", lambda arrays: made.append(arrays.count()) or pairs(arrays))
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(90)) + " " + passage) for i in range(80)] + [(100, "d0w0 " * 5 + passage), (101, "d0w0 " * 5 + passage + " more")]
    assert result(ngram_join(table(spark, rows), 3, 80, 100)) == plain(rows, 3, 80, 100)
    assert made == [2]
