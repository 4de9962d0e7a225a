import hashlib
import random

import pytest

import folio.llm.op4_suffix_dedup as m

from .helpers import SF, table


def plain(rows, width=100):
    seen, hits = {}, {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, b in texts:
        for p in range(len(b) - width + 1):
            if i is not None:
                w = b[p : p + width]
                seen[w] = min(seen.get(w, (i, p)), (i, p))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if i is not None and seen[b[p : p + width]] < (i, p):
                gone[p : p + width] = b"\1" * width
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("step", [900_000, 7])
def test_equals_plain(spark, monkeypatch, step):
    if step == 7:  # frequent grams as rows
        monkeypatch.setattr(m, "GROUP", 3)
        monkeypatch.setattr(m, "BLOCK", 50)
    rng = random.Random(step)
    pool = ["".join(rng.choice("abcde é") for _ in range(rng.choice([40, 99, 100, 101, 150, 400]))) for _ in range(25)] + ["a" * 350, "ab" * 200]
    rows = [(i * 2, "".join(rng.choice(pool) for _ in range(rng.randrange(6)))) for i in range(60)]
    assert result(m.suffix_dedup(table(spark, rows))) == plain(rows)


def test_equals_plain_on_the_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert result(m.op4_suffix_dedup(spark, SF)) == plain(rows)


def test_cases(spark):
    long = "".join(random.Random(3).choice("xyz \n") for _ in range(500))
    rows = [(1, None), (2, ""), (3, "é" * 49), (4, "é" * 300), (5, long), (5, long), (5, "q" + long), (None, long), (9, long + long), (10, "b" * 2_000)]
    assert result(m.suffix_dedup(table(spark, rows))) == plain(rows)
    assert m.suffix_dedup(table(spark, [])).count() == 0
    more = table(spark, [(1, "a", 5, "b")], "doc_id int, text string, gram int, kept string")
    assert result(m.suffix_dedup(more)) == [(1, 1, 0, 0, hashlib.sha256(b"a").hexdigest())]


def test_texts_longer_than_a_step():
    import pyarrow as pa

    data = "".join(random.Random(5).choice("abc ") for _ in range(3_000))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([data, data])], ["doc_id", "text"])
    m.STEP, old = 700, m.STEP
    try:
        out = [r for b in m.domains(100)([batch]) for r in b.to_pylist()]
    finally:
        m.STEP = old
    starts = sorted((r["doc_id"], (r["place"] >> 28) + k) for r in out for k in range(((r["place"] >> 20) & 255) - 99))
    assert starts == [(d, p) for d in (1, 2) for p in range(2_901)]
