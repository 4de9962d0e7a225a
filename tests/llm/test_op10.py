import hashlib
import random
from collections import defaultdict

from folio.llm.op10_line_dedup import line_dedup

from .helpers import table

STRIP = " \t\n\x0b\f\r"


def plain(rows, min_chars=20, min_docs=3):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(STRIP))

    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                held[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or not (len(held.get(key(x), ())) >= min_docs and i < max(held[key(x)]))]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.deduped.encode()).hexdigest()) for r in df.collect()), key=str)


def test_equals_plain(spark):
    rng = random.Random(1)
    pool = [f"A line of Words number {i} é" for i in range(30)] + ["short", "", "  ", "\tpadded line of enough characters \r"]
    rows = [(i * 3, "\n".join(rng.choice(pool) + rng.choice(["", " ", "X"]) for _ in range(rng.randrange(12)))) for i in range(80)]
    for batches in (1, 3, 11):
        assert result(line_dedup(table(spark, rows), batches=batches)) == plain(rows)


def test_cases(spark):
    line = "This line is found in many documents."
    rows = [(1, line), (2, line.upper() + "\n\n"), (2, line), (3, " " + line), (None, line), (5, None), (6, ""), (7, "É" * 19), (8, "x\n" * 50_000 + line)]
    assert result(line_dedup(table(spark, rows))) == plain(rows)
    assert line_dedup(table(spark, [])).count() == 0
    more = table(spark, [(1, "a", 5, "b", 7)], "doc_id int, text string, at int, lines_ string, n_lines long")
    assert line_dedup(more).select("at", "lines_", "deduped", "n_lines").first() == (5, "b", "a", 1)


def test_ids_over_the_whole_range_of_long(spark):
    """Ids as hashes are: batches are cut without overflow, and the largest id keeps its line."""
    from folio.llm.op10_line_dedup import line_dedup

    line = "a line that all of the documents hold"
    ids = [-(2**63), -(2**62), -5, 0, 7, 2**62, 2**63 - 1]
    rows = [(i, f"own line of {i}\n{line}") for i in ids]
    out = {r.doc_id: (r.n_lines, r.n_dropped, r.deduped) for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {i: (2, 0 if i == 2**63 - 1 else 1, t if i == 2**63 - 1 else t.split("\n")[0]) for i, t in rows}
