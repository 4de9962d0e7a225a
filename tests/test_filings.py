"""Filings and jobs: the newest filing against a plain walk, ids that clash, states over runs of white space."""

import random

import pytest
from pyspark.sql import functions as F

from folio.functions import names
from folio.operators import filings as m


def test_newest_filing_equals_a_walk(spark):
    rng = random.Random(2)
    there = [(rng.choice(["u1", "u2", "u3", None]), rng.choice(["CA", "NY", "TX", None]), rng.choice([2019, 2020, 2021, None]), f"r{i}") for i in range(60)]
    wanted = [(i, rng.choice(["u1", "u2", "u3", "u4", None]), rng.choice(["CA", "TX", "WA", None]), 2019 + i % 2, 2020 + i % 3) for i in range(80)]

    def walk(uei, state, low, high):
        own = [(s != state, s if s != state else "", -y, r, s) for u, s, y, r in there if None not in (u, s, y, uei, state) and u == uei and low <= y <= high]
        return (-min(own)[2], *min(own)[3:]) if own else (None, None, None)

    left = spark.createDataFrame(wanted, "row_id int, uei string, state string, low int, high int")
    got = m.newest_filing(left, spark.createDataFrame(there, "uei string, state string, year int, report string"))
    assert {r.row_id: (r.year, r.report, r.found_state) for r in got.collect()} == {w[0]: walk(*w[1:]) for w in wanted}
    assert got.count() == len(wanted)


def test_results_to_jobs(spark):
    jobs = lambda *ids: spark.createDataFrame([(i,) for i in ids], "custom_id string")
    results = spark.createDataFrame([("a_b", 1), ("long_", 2)], "safe_id string, result int")
    got = m.results_to_jobs(jobs("a b", "a b", "c", None), results)
    assert sorted((str(r.custom_id), r.result) for r in got.collect()) == [("None", None), ("a b", 1), ("a b", 1), ("c", None)]
    assert m.results_to_jobs(jobs("long.x"), results, 5).first().result == 2
    with pytest.raises(Exception, match="same safe id"):
        m.results_to_jobs(jobs("a b", "a.b"), results).collect()


def test_states_over_white_space(spark):
    lines = ["City of  New \t York", "New York", "NEW YORK CITY", "new  yorker", None, "in NY now"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, t string")
    of = df.select("i", names.has_state(F.col("t"), "NY", "New York").alias("held"), names.names_state_only(F.col("t"), "NY", "New York").alias("only"))
    assert {r.i: (r.held, r.only) for r in of.collect()} == {0: (True, True), 1: (True, True), 2: (True, True), 3: (False, False), 4: (False, False), 5: (True, False)}
