import re

import pytest

from folio.llm import op1_ngram_join as m

from .helpers import noisy_texts, table


def degrees(rows, k, num, den):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset({tuple(w)} - {()})
    own = {s for s in sets.values() if s}
    return {i: sum(t != s and den * len(s & t) >= num * len(s | t) for t in own) if s else 0 for i, s in sets.items()}


@pytest.mark.parametrize("texts", [7, 2_048])
def test_every_link_counts(spark, monkeypatch, texts):
    monkeypatch.setattr(m, "TILE_TEXTS", texts)
    base = [f"w{i}" for i in range(80)]
    alike = [" ".join([*base[:k], "other", *base[k + 1 :]]) for k in range(0, 80, 4)]
    rows = list(enumerate([*noisy_texts(5, n=100, words=60), *alike, alike[0], ""]))
    want = degrees(rows, 3, 80, 100)
    got = m.ngram_join(table(spark, rows), 3, 80, 100, count=True).collect()
    assert {r.doc_id: r.n_links for r in got} == want and max(want.values()) > 10
    part = {r.doc_id: r.component_id for r in m.ngram_join(table(spark, rows), 3, 80, 100).collect()}
    assert {r.doc_id: r.component_id for r in got} == part
