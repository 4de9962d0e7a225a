import hashlib

import numpy as np
import sentencepiece

from folio.llm.op6_sentencepiece import MODEL, Transducer, decode, digests, encode, pieces_of

from .helpers import SF, table

TEXTS = ["Hello  world\n new\tline  ", "  lead", "", None, " ", "é\x00a𐍈", "aaaaaaaaa bbbbb", "x" * 3000, "    " * 40, "\n\n a\n", "日本語のテキスト", "don't stop-believing 12345.678", "▁ mark", "áe", "word " * 2000]


def test_equals_the_library(spark):
    own = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = docs + [(1000 + i, t) for i, t in enumerate(TEXTS)]
    got = {r.doc_id: (r.ids, r.decoded) for r in decode(encode(table(spark, rows))).collect()}
    for i, t in rows:
        want = own.encode(t or "")
        assert got[i][0] == want, (i, t)
        assert got[i][1] == own.decode(want) == (t or "").replace("▁", " ")
    for r in digests(table(spark, rows)).collect():
        want = own.encode(dict(rows)[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(want), hashlib.sha256(np.array(want, "<i4").tobytes()).hexdigest())
        assert r.round_trip == ("▁" not in (dict(rows)[r.doc_id] or ""))


def test_paths_together_and_alone():
    m = Transducer(*pieces_of(MODEL))
    units = ["▁hello", "▁the", "unbelievable", "▁▁▁x", "ééé", "a", "▁Schtzverung", "zzzzzzzzzz"]
    assert m.paths(units) == [m.path(u) for u in units]


def test_cases(spark):
    assert encode(table(spark, [])).count() == 0 and digests(table(spark, [])).count() == 0
    more = table(spark, [(1, 2, "a", None), (1, 2, "a", None)], "ids int, n_tokens int, text string, doc_id long")
    assert [(r.n_tokens, len(r.ids), r.doc_id) for r in encode(more).collect()] == [(2, 1, None)] * 2


def test_models_with_the_same_pieces_and_other_scores_are_told_apart():
    from folio.llm.op6_sentencepiece import compiled

    names = [f"<{b}>" for b in range(256)] + ["a", "b", "c", "ab", "bc"]
    ids = list(range(256))
    one = compiled((names, [0.0] * 259 + [-1.0, -2.0], ids))
    two = compiled((names, [0.0] * 259 + [-2.0, -1.0], ids))
    assert one is not two and compiled((names, [0.0] * 259 + [-1.0, -2.0], ids)) is one
    assert [p.merged("abc") for p in (one, two)] == [["ab", "c"], ["a", "bc"]]
