"""Small tables and plain reference versions for the tests of this folder."""

import os
import random

SF = os.environ.get("FOLIO_SF", "/root/testdata/sf0.001")


def table(spark, rows, ddl="doc_id long, text string"):
    return spark.createDataFrame(rows, ddl)


def saved(spark, tmp_path, rows, name="documents", ddl="doc_id long, text string, lang string, source string, n_chars long"):
    table(spark, rows, ddl).write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def noisy_texts(seed, n=40, vocabulary=60, words=80):
    """Texts, with exact copies and copies with a few words changed."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        if out and rng.random() < 0.5:
            own = rng.choice(out).split(" ")
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                own[rng.randrange(len(own))] = f"w{rng.randrange(vocabulary)}"
        else:
            own = [f"w{rng.randrange(vocabulary)}" for _ in range(rng.choice([1, 2, 3, 8, 20, words]))]
        out.append(" ".join(own))
    return out


def smallest_reachable(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
