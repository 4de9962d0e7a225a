import random

import numpy as np

from folio.llm.op8_token_counts import RANKS, Tree, apply_edits, build_trees, counter, edited, op8_token_counts, sample_edits

from .helpers import SF, table

with open(RANKS, "rb") as f:
    OWN = counter(f.read())


def plain(text):
    return len(OWN.encoding.encode_ordinary(text))


def tree_of(text):
    return Tree(OWN.leaves(OWN.pattern.findall(text)))


def test_random_edits():
    rng = random.Random(4)
    bits = ["word", " ", "  ", "\n", "'", "l", "ll", "'re", "12", "é", "!", " the", "don't", "\t ", "x" * 40]
    for _ in range(60):
        text = "".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 5, 300, 1200])))
        tree = tree_of(text)
        assert tree.nodes[1, 1] == plain(text)
        for _ in range(8):
            a = rng.randrange(len(text) + 2)
            text, tree, again = edited(text, tree, a, a + rng.choice([0, 0, 1, 3, 50]), "".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 2, 30]))), OWN)
            assert tree.nodes[1].tolist() == [len(text), plain(text)]
            assert np.array_equal(Tree(tree.leaves).nodes, tree.nodes)


def test_only_the_region_is_encoded():
    text = "some plain words of a text " * 2000
    _, _, again = edited(text, tree_of(text), 30_000, 30_004, "new", OWN)
    assert again < 200


def test_equals_whole_encoding_on_the_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op8_token_counts(spark, SF).collect():
        t, n = texts[r.doc_id], len(texts[r.doc_id])
        assert r.n_tokens == plain(t)
        for a, b, new in ((n // 4, n // 4 + 10, "[edited]"), (n // 2, n // 2, " (revised) "), (3 * n // 4, 3 * n // 4 + 5, "")):
            a, b = min(a, len(t)), min(b, len(t))
            t = t[:a] + new + t[b:]
        assert (r.n_tokens_after, r.n_chars_after) == (plain(t), len(t))


def test_cases(spark):
    docs = table(spark, [(1, None), (2, ""), (3, "a b"), (3, "c d"), (3, "c d"), (None, "x y")])
    edits = table(spark, [(1, 0, 5, 9, "new text"), (3, 1, 0, 0, None), (3, 0, 1, 99, " z"), (9, 0, 0, 0, "q"), (None, 0, 0, 0, "q")], "doc_id long, seq int, start int, stop int, new string")
    got = sorted(((r.doc_id, r.text, r.n_tokens_after) for r in apply_edits(docs, build_trees(docs), edits).collect()), key=str)
    assert got == sorted([(1, "new text", 2), (2, "", 0), (3, "a z", 2), (3, "c z", 2), (3, "c z", 2), (None, "x y", 2)], key=str)
    empty = table(spark, [])
    assert apply_edits(empty, build_trees(empty), sample_edits(empty)).count() == 0
