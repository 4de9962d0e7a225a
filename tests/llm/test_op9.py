import math
import zlib
from collections import Counter

import numpy as np
import pytest
import regex

from folio.llm.op9_language_id import BINS, GRAM, ROUNDS, bins_of, learn, mixture, op9_language_id, predict
from folio.llm.textbytes import BYTE

from .helpers import SF, table

LAB = "text string, lang string"
EN, DE, FR = "the cat and the dog are in the house with that man ", "der hund und die katze sind im haus mit dem mann ", "le chat et le chien sont dans la maison avec cet homme "


def plain_bins(text):
    own = regex.sub(r"[^\p{L}\p{M}]+", " ", text.lower()).strip()
    if not regex.search(r"\p{L}", own):
        return []
    raw, out, full = f" {own} ".encode(), [], (1 << 64) - 1
    for i in range(len(raw) - GRAM + 1 if len(raw) >= GRAM else 1):
        x = 0
        for j, b in enumerate(raw[i : i + GRAM]):
            x = int(BYTE[b]) if j == 0 else (x * 0x9E3779B97F4A7C15 + int(BYTE[b])) & full
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 & full
        x ^= x >> 27
        x = x * 0x94D049BB133111EB & full
        out.append((x ^ x >> 31) % BINS)
    return out


def plain_models(rows):
    names = sorted({l for t, l in rows if t is not None and l is not None})
    counts = {n: Counter(b for t, l in rows if l == n and t is not None for b in plain_bins(t)) for n in names}
    return names, lambda b: [(counts[n][b] + 0.5) / (sum(counts[n].values()) + 0.5 * BINS) for n in names]


def plain_mixture(bins, shares, n):
    """Expectation maximisation token by token, dropping the least language while the penalised likelihood doesn't fall."""
    like = [shares(b) for b in bins]

    def fit(kept):
        p = {k: 1 / len(kept) for k in kept}
        for _ in range(ROUNDS if len(kept) > 1 else 0):
            new = dict.fromkeys(kept, 0.0)
            for row in like:
                whole = sum(row[k] * p[k] for k in kept)
                for k in kept:
                    new[k] += row[k] * p[k] / whole / len(like)
            p = new
        return sum(math.log(sum(row[k] * p[k] for k in kept)) for row in like) - 0.5 * len(kept) * math.log(len(like)), p

    kept = list(range(n))
    value, p = fit(kept)
    while len(kept) > 1:
        fewer = [k for k in kept if k != min(reversed(kept), key=lambda k: p[k])]
        new, part = fit(fewer)
        if new < value:
            break
        kept, value, p = fewer, new, part
    return [p.get(k, 0.0) for k in range(n)]


@pytest.mark.parametrize("text", [EN, DE + EN, EN * 2 + FR, "q", "zz top und der the le", DE * 3 + EN + FR])
def test_mixture_equals_plain(spark, text):
    rows = [(EN * 4, "en"), (DE * 4, "de"), (FR * 4, "fr"), (EN, "en")]
    names, logs = learn(table(spark, rows, LAB))
    want_names, shares = plain_models(rows)
    assert names == want_names and bins_of(text).tolist() == plain_bins(text)
    assert np.allclose(np.exp(logs[plain_bins(text)]), [shares(b) for b in plain_bins(text)])
    assert np.allclose(mixture(bins_of(text), logs), plain_mixture(plain_bins(text), shares, 3), atol=1e-6)


def test_no_letter_is_und(spark):
    names, logs = learn(table(spark, [(EN, "en"), (DE, "de")], LAB))
    rows = [(1, "½ ² ①"), (2, "Ⅳ ⅷ"), (3, "١٢٣"), (4, "́ ̈"), (5, " \n\t"), (6, "_-_"), (7, "ñ"), (8, "猫")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in predict(table(spark, rows), names, logs).collect()}
    assert [i for i in got if got[i] == ("und", 0.0)] == [1, 2, 3, 4, 5, 6]
    assert all(got[i][0] in names and 0 < got[i][1] <= 1 for i in (7, 8))


def test_ties_repeats_and_clashing_columns(spark):
    names, logs = learn(table(spark, [(EN, "b"), (EN, "a"), (EN, "a"), (EN, "b")], LAB))
    more = table(spark, [(1, EN, "x", 0.5, "y"), (1, EN, "x", 0.5, "y")], "doc_id int, text string, lang_pred string, score double, langs string")
    assert [(r.doc_id, r.lang_pred) for r in predict(more, names, logs).collect()] == [(1, "a")] * 2
    with pytest.raises(ValueError):
        learn(table(spark, [(EN, f"l{i}") for i in range(501)], LAB))


def test_language_accuracy(spark, tmp_path):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op9_language_id(spark, SF).collect()
    assert len(got) == len(truth) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.9


def test_language_mixture_and_cases(spark):
    en, de = "the cat and the dog are in the house with that man ", "der hund und die katze sind im haus mit dem mann "
    names, logs = learn(table(spark, [(en * 5, "en"), (de * 5, "de"), ("x", None), (None, "fr")], "text string, lang string"))
    assert names == ["de", "en"]
    rows = [(1, en), (2, de), (3, en * 3 + de), (4, None), (5, ""), (6, "123 !?"), (None, de * 3000), (8, "q")]
    got = {r.doc_id: r for r in predict(table(spark, rows), names, logs).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4, 5, 6, None)] == ["en", "de", "en", "und", "und", "und", "de"]
    assert 0.6 < got[3].score < 0.9 and len(got[3].langs) == 2 and got[1].score == 1
    assert predict(table(spark, rows), *learn(table(spark, [], "text string, lang string"))).where("lang_pred <> 'und'").count() == 0
    assert predict(table(spark, []), names, logs).count() == 0
