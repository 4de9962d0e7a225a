"""Each stage against a plain version of it, on the documents and on hard rows."""

import re

import sentencepiece

import corpus_pipeline as p
from folio.llm.op6_sentencepiece import MODEL

from . import test_op1, test_op5, test_op7, test_op10
from .helpers import SF, saved

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def plain_lines(rows):
    kept = []
    held = {}
    key = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s.strip(test_op10.STRIP))
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                held.setdefault(key(line), set()).add(i)
    for i, t, *rest in rows:
        out = "\n".join(x for x in (t or "").split("\n") if not (len(held.get(key(x), ())) >= 3 and i < max(held[key(x)])))
        kept.append((i, out, rest[0], rest[1], len(out)))
    return kept


def plain_stages(rows, items):
    good = {(r[0]) for r in test_op7.plain([r[:4] for r in rows]) if r[-1]}
    yield (rows := [r for r in rows if r[0] in good])
    yield (rows := plain_lines(rows))
    part = test_op1.plain([r[:2] for r in rows], 5, 80, 100)
    yield (rows := [r for r in rows if part[r[0]][1] == r[0]])
    gone = {x[0] for x in test_op5.plain([r[:2] for r in rows], items)}
    yield [r for r in rows if r[0] not in gone]


def test_stages_on_the_documents(spark):
    docs = p.documents(spark, SF)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [tuple(r[c] for c in COLUMNS) for r in docs.collect()]
    for (name, stage), want in zip(p.STAGES, plain_stages(rows, items)):
        docs = p.stored(stage(spark, docs, SF), name)
        assert docs.columns == COLUMNS
        assert rows_of(docs) == sorted(want, key=str), name
    own = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    out = p.run(spark, SF).collect()
    assert {r.doc_id for r in out} == {r.doc_id for r in docs.collect()}
    assert all(r.ids == own.encode(r.text) and r.n_tokens == len(r.ids) for r in out)


def test_hard_rows(spark, tmp_path):
    long = " ".join(f"w{i}" for i in range(70))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, long, "en", "a", 1), (3, long, "en", "a", 1), (4, long, None, "a", 1), (None, long + " more", "en", None, 1), (6, "x y z " * 20_000, "en", "a", 1)]
    sf = saved(spark, tmp_path, rows)
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    got = p.run(spark, sf).collect()
    assert sorted((r.doc_id for r in got), key=str) == [3, None]
    empty = saved(spark, tmp_path / "none", [])
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert p.run(spark, empty).count() == 0


def rows_table(spark, rows, extra=""):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long" + extra)


def test_copies_without_doc_id(spark):
    text = " ".join(f"w{i}" for i in range(70))
    rows = [(3, text, "en", "a", 1), (5, text, "en", "a", 1), (None, text, "en", "a", 1), (None, text + " x", "en", "a", 1), (None, text + " x", "fr", "a", 1), (7, None, "en", "a", 1), (None, None, "en", "a", 1), (7, None, "en", "a", 1), (8, "", "en", "a", 1), (9, "a", "en", "a", 1), (9, "b", "en", "a", 1)]
    got = p.near_duplicates(spark, rows_table(spark, rows), "no folder").select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(3, text), (None, text + " x"), (7, None), (8, ""), (9, "a"), (9, "b")], key=str)


def test_contaminated_without_doc_id(spark, tmp_path):
    item = "the quick river carries seven small boats down to the old stone bridge before night falls again"
    spark.createDataFrame([(1, item), (2, None), (None, "x")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, "clean words only", "en", "a", 1), (2, "before " + item, "en", "a", 1), (2, "other row", "en", "a", 1), (None, item + " after", "en", "a", 1), (None, "clean too", "en", "a", 1), (None, None, "en", "a", 1)]
    got = p.decontamination(spark, rows_table(spark, rows), str(tmp_path)).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "clean words only"), (None, "clean too"), (None, None)], key=str)


def test_clashing_columns_keep_their_values(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(70))
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    more = ", kept int, n_words string, n_lines string, n_dropped int, deduped string, component_id string, row_ int, item_id string, mark_ int, h1 int"
    docs = rows_table(spark, [(1, text, "en", "a", 5, 9, "a", "b", 8, "c", "d", 7, "e", 6, 4)], more)
    own = tuple(docs.drop("text", "n_chars").first())
    for name, stage in p.STAGES:
        docs = p.stored(stage(spark, docs, str(tmp_path)), name)
        assert tuple(docs.select([c for c in docs.columns if c not in ("text", "n_chars", "ids", "n_tokens")]).first()) == own, name


def test_scratch_of_other_queries_stays(spark):
    from folio.llm.op10_line_dedup import op10_line_dedup

    first = op10_line_dedup(spark, SF)
    docs = p.stored(p.quality(spark, p.documents(spark, SF), SF), "kept")
    p.lines(spark, docs, SF)
    assert first.count() == p.documents(spark, SF).count()
