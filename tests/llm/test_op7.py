import math
import re
from collections import Counter, defaultdict

from folio.llm.op7_quality_rules import BELOW, MEASURES, SLACK, judge, op7_quality_rules

from .helpers import SF, table

DDL = "doc_id long, text string, lang string, source string"


def base(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\f\r")]
    n = Counter(zip(w, w[1:], w[2:]))
    repeated = {i + j for i, x in enumerate(zip(w, w[1:], w[2:])) if n[x] > 1 for j in range(3)}
    out = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated)}
    return out | {"base_failed": len(w) < 50 or 100 * len(repeated) > 50 * len(w)}


def low_of_bucket(v):
    """The smallest number that shares a bucket with v: all but its first seven bits cleared."""
    shift = max(0, v.bit_length() - 7)
    return v >> shift << shift


def plain(rows, least=100, spread=0.5, slack=SLACK):
    measured = [base(t) for _, t, _, _ in rows]
    of = lambda m, b: 1000 * b[MEASURES[m][0]] // max(1, b[MEASURES[m][1]])
    values = defaultdict(list)
    for (_, _, lang, source), b in zip(rows, measured):
        if not b["base_failed"]:
            for m in MEASURES:
                for key in ((lang, source), (lang,), ()):
                    values[m, key].append(of(m, b))

    def fences(m, key):
        own = sorted(values[m, key])
        low, mid, high = (low_of_bucket(own[math.ceil(q * len(own) / 100) - 1]) for q in (10, 50, 90))
        return low - math.floor(spread * (mid - low)) - slack[m], high + math.floor(spread * (high - mid)) + slack[m]

    out = []
    for (doc, _, lang, source), b in zip(rows, measured):
        kept = not b["base_failed"]
        if kept:
            for m in MEASURES:
                key = next(k for k in ((lang, source), (lang,), ()) if len(values[m, k]) >= least or not k)
                floor, ceiling = fences(m, key)
                kept &= of(m, b) <= ceiling and (m not in BELOW or of(m, b) >= floor)
        out.append((doc, *(b[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")), kept))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in df.collect()), key=str)


def test_equals_plain_on_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    rows = [tuple(r) for r in docs.collect()]
    assert result(op7_quality_rules(spark, SF)) == plain(rows)
    tight = {m: 0 for m in SLACK}
    got = result(judge(docs, least=10, spread=0.1, slack=tight))
    assert got == plain(rows, 10, 0.1, tight) and not all(r[-1] for r in got if not r[-2])


def test_cases(spark):
    some = " ".join(f"word{i}" for i in range(60))
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, some, None, "a"), (3, some, None, "a"), (None, some, "en", None), (5, "a b c " * 9_000, "en", "a"), (6, some + "\n" + "é" * 9_000, None, None), (7, some.replace(" ", "\n") + "\n\nword1\n \n", "en", "a"), (8, "# $ % " + some, "en", "a"), (9, "a a a a " + some, "en", "a")]
    assert result(judge(table(spark, rows, DDL))) == plain(rows)
    assert result(judge(table(spark, rows, DDL), least=1)) == plain(rows, least=1)
    assert judge(table(spark, [], DDL)).count() == 0
    more = table(spark, [(1, some, "en", "a", 5, "x")], DDL + ", lang_ long, words_ string")
    r = judge(more).first()
    assert (r.lang_, r.words_, r.kept) == (5, "x", True)
