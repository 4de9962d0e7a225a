import math
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

import folio.llm.op2_lm_scoring as lm
from folio.llm.op2_lm_scoring import Model, lm_scores, op2_lm_scoring, thresholds
from pyspark.sql import functions as F

from .helpers import SF, table


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")) + [None]


def base(rows):
    held = {i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i, _ in rows}
    c = Counter(w for i, t in rows if not held[i] for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return sorted(((i, held[i], len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for i, t in rows), key=str)


def result(df):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()), key=str)


@pytest.mark.parametrize("head", [200_000, 50])
def test_base_equals_plain(spark, monkeypatch, head):
    monkeypatch.setattr(lm, "HEAD", head)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = op2_lm_scoring(spark, SF)
    assert result(out) == base(rows)
    got = [(r.held_out, r.score, r.base_score) for r in out.collect()]
    assert all(s < 0 for _, s, _ in got)
    if head > 50:  # on texts it learned nothing from, the model beats the base
        assert sum(s for h, s, _ in got if h) > sum(b for h, _, b in got if h)


def test_forward_equals_all_paths():
    m = Model.start(np.random.default_rng(1).uniform(0.1, 1, 30))
    seq = np.array([5, 9, 5, 29])
    want = sum(m.first[p[0]] * math.prod(m.emit[s, k] for s, k in zip(seq, p)) * math.prod(m.move[a, b] for a, b in zip(p, p[1:])) for p in product(range(lm.STATES), repeat=len(seq)))
    got = m.log_likelihood(np.concatenate([seq, [29], seq[:2]]), np.array([0, 4, 5, 7]))
    assert math.isclose(got[0], math.log(want), rel_tol=1e-9) and len(got) == 3


@pytest.mark.parametrize("block", [1, 5, 10, 250_000])
def test_expected_counts_equal_all_paths_whatever_the_block(monkeypatch, block):
    """Sums over all state paths of whole texts, none of them cut."""
    monkeypatch.setattr(lm, "BLOCK", block)
    rng = np.random.default_rng(3)
    m = Model.start(rng.uniform(0.1, 1, 12), states=3)
    seqs = [rng.integers(0, 12, k) for k in (6, 3, 1, 7, 5)]
    want = m.sums()
    for seq in seqs:
        paths = list(product(range(3), repeat=len(seq)))
        chance = [m.first[p[0]] * math.prod(m.emit[s, k] for s, k in zip(seq, p)) * math.prod(m.move[a, b] for a, b in zip(p, p[1:])) for p in paths]
        for p, c in zip(paths, np.array(chance) / sum(chance)):
            want[-2, p[0]] += c
            for s, k in zip(seq, p):
                want[s, k] += c
            for a, b in zip(p, p[1:]):
                want[12 + a, b] += c
        want[-1, 0] += math.log(sum(chance))
    got = m.sums()
    m.expected(np.concatenate(seqs), np.append(0, np.cumsum([len(s) for s in seqs])), got)
    assert np.allclose(got, want)


def test_rounds_raise_the_likelihood():
    rng = np.random.default_rng(2)
    seqs = [np.append(np.tile([3, 4], 40) + rng.integers(0, 2, 80) * 10, 20) for _ in range(50)]
    flat, bounds = np.concatenate(seqs), np.arange(51) * 81
    prior = np.full(21, 1e-3)
    share = np.bincount(flat, minlength=21) + prior
    m, last = Model.start(share / share.sum()), -np.inf
    for _ in range(5):
        now, sums = m.log_likelihood(flat, bounds).sum(), m.sums()
        assert now > last
        last = now
        m.expected(flat, bounds, sums)
        assert np.isclose(sums[:21].sum(), len(flat)) and np.isclose(sums[-1, 0], now)
        m = Model.fitted(sums, prior)


def test_six_states_beat_one_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    held = lm.fold(F.col("doc_id"), 7) == 2
    one, six = (lm_scores(docs, held, states).where("held_out").agg(F.sum("score"), F.sum("base_score")).first() for states in (1, 6))
    assert six[0] > one[0] and abs(one[0] - one[1]) < 1e-4 * abs(one[1])


def test_thresholds_hold_their_bounds(spark):
    counts = table(spark, [(i, max(1, 1000 // (i + 1))) for i in range(500)], "word long, n long")
    for bound, least in zip((400, 100, 7, 0), thresholds(counts, 400, 100, 7, 0)):
        reached = counts.where(F.col("n") >= least).count()
        assert reached <= bound and (least == 2 or bound == 0 or reached > 0)
    assert thresholds(counts.where("n = 1"), 5) == [1 << 62]


def test_lm_cases(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (4, "A b " * 9_000), (5, "\n"), (5, "x y z")]
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    assert result(lm_scores(table(spark, rows), held)) == base(rows)
    assert lm_scores(table(spark, []), held).count() == 0
    assert lm_scores(table(spark, [(1, "a", 2, "b")], "doc_id int, text string, n int, word string"), F.lit(True)).first().n_known == 0
