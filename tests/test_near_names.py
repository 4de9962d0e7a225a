"""The likeness join against all pairs."""

import random

import pytest

from folio.functions.fuzzy import best_partial, partial, ratio
from folio.operators import near_names as m


def plain(a, b):
    short, long = sorted((a, b), key=len)
    return max(ratio(short, long[max(0, i) : i + len(short)]) for i in range(1 - len(short), len(long)))


def names(seed, n, most):
    rng = random.Random(seed)
    firms = ["baker tilly us", "clifton larson allen", "kpmg", "ernst and young", "crowe", "bkd", "ü ber prüfer"]
    for _ in range(n):
        text = list(rng.choice(firms) + rng.choice(["", " llp", " of ohio", " and partners, certified accountants" * (most > 40)]))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            at = rng.randrange(len(text) + 1)
            text[at : at + rng.randrange(2)] = rng.choice(["", "x", "l", " "])
        yield "".join(text)[: rng.randrange(1, most)]


def test_a_stretch_is_found_as_by_trying_all(spark):
    for a, b in zip(names(1, 400, 30), names(2, 400, 80), strict=True):
        for least in (0.0, 60.0, 88.0):
            want = plain(a, b) if a and b else (100.0 if a == b else 0.0)
            assert partial(a, b, least) == (want if want >= least else 0.0)


@pytest.mark.parametrize(("least", "seed"), [(88, 3), (80, 4), (60, 5), (100, 6)])
def test_equals_all_pairs(spark, least, seed):
    left, right = list(enumerate(names(seed, 60, 25))), list(enumerate(names(seed + 10, 90, 60)))
    made = lambda rows, names_: spark.createDataFrame(rows, names_)
    got = {(r.a, r.b): r.score for r in m.near_pairs(made(left, "a int, x string"), made(right, "b int, y string"), ("a", "x"), ("b", "y"), least).collect()}
    want = {(i, j): plain(a, b) for i, a in left for j, b in right if a and b and plain(a, b) >= least}
    assert got == want and want


def test_only_pairs_within_the_bounds_are_scored(spark):
    left = spark.createDataFrame([(i, f"auditor number {i:03d} of the state") for i in range(40)], "a int, x string")
    right = spark.createDataFrame([(i, f"quite another line {i * 7:03d}, page {i}") for i in range(200)], "b int, y string")
    sides = [m._sided(left, ("a", "x"), [], 88), m._sided(right, ("b", "y"), [], 88)]
    assert m._candidates(*sides, [], 88, False).count() + m._candidates(*sides[::-1], [], 88, True).count() == 0


def test_cases(spark):
    left = spark.createDataFrame([(1, 1, None), (1, 2, ""), (1, 3, "kpmg"), (1, 3, "kpmg"), (2, 4, "kpmg")], "d int, a int, x string")
    right = spark.createDataFrame([(1, 7, "by KPMG, kpmg llp " * 3000), (1, 8, None), (1, 9, "kpm"), (2, 10, "kp"), (3, 11, "kpmg")], "d int, b int, y string")
    out = m.near_pairs(left, right, ("a", "x"), ("b", "y"), 85, ["d"])
    assert sorted(map(tuple, out.collect())) == [(1, 3, 7, 100.0), (1, 3, 9, 100.0), (2, 4, 10, 100.0)]
    assert m.near_pairs(left.limit(0), right, ("a", "x"), ("b", "y"), 85, ["d"]).count() == 0
    with pytest.raises(ValueError):
        m.near_pairs(left, right, ("a", "x"), ("b", "y"), 40)


def test_the_best_of_many_texts_equals_each_tried(spark):
    rng = random.Random(8)
    for seed in range(60):
        texts = list(names(seed, rng.randrange(1, 12), 70)) + ["", "ü", "𝄞 kpmg 𝄞"][: rng.randrange(4)]
        for name in ["kpmg", "crowe", "baker tilly us", "ü ber prüfer", "clifton larson allen", "𝄞 kpmg", ""]:
            for least in (60.0, 85.0, 100.0):
                want = max([partial(name, t) for t in texts if t], default=0.0) if name else 0.0
                assert best_partial(name, texts, least) == (want if want >= least else 0.0)


def test_best_near_equals_pairs(spark):
    rng = random.Random(9)
    rows = [(d, a, c, t) for d in range(40) for a, c in [(next(names(d, 1, 30)), rng.choice(["", None, "ann lee"]))] for t in [*names(d + 50, 6, 60), rng.choice(["", None, "anne lee"])]]
    got = {r.d: r.score for r in m.best_near(spark.createDataFrame(rows, "d int, a string, c string, t string").repartition(3), "d", ["a", "c"], "t", 80).collect()}
    want = {}
    for d, *sought, t in rows:
        for name in sought:
            if name and t:
                want[d] = max(want.get(d, 0), partial(name, t))
    assert got == {d: s for d, s in want.items() if s >= 80} and 5 < len(got) < 40
