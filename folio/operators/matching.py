"""Finding the filing that fits: newest within a range, and best by weighted criteria."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_within(left: DataFrame, right: DataFrame, keys: list[str], at: str, low: Column, high: Column, tie: str) -> DataFrame:
    """For each left row the right row of its keys with the largest `at` from low to high; ties by the largest `tie`.

    An equi-join and a top-1 by aggregation, so no window holds a hot key's rows together. Left rows need a unique `row_id`.
    """
    pairs = left.join(right, keys).where(F.col(at).between(low, high))
    best = pairs.groupBy("row_id").agg(F.max(F.struct(at, tie)).alias("best_"))
    return left.join(best, "row_id", "left").withColumns({at: F.col(f"best_.{at}"), tie: F.col(f"best_.{tie}")}).drop("best_")


def best_scored(criteria: DataFrame, candidates: DataFrame, block: str, score: Column, order: list[Column], keep: list[str], equal: list[tuple[Column, Column]] | None = None) -> DataFrame:
    """For each criterion (row_id) the candidate of its block with the highest score, ties by `order` descending, then by `keep`.

    Any score takes all pairs of a block. equal: the score's tests for equality, as (of the criterion, of the candidate). With them only the
    first candidate by `order` of each block, and of its rows with each value of each choice of the tests, is compared: as many as there are choices.
    The score must not fall when one more of the tests holds, and else must not fall, for any criterion, as the candidate's `order` rises; what it
    reads of a candidate beside the tests must hang on `order` alone. The best candidate is then first among those that pass the tests it passes.
    """
    named = {f"o{i}": o for i, o in enumerate(order)}
    key = F.struct("score", *named, *keep)
    if equal is None:
        ranked = criteria.join(candidates.withColumns(named), block).withColumn("score", score)
        return ranked.groupBy("row_id").agg(F.max(key).alias("x")).select("row_id", "x.score", *[f"x.{k}" for k in keep])
    theirs = candidates.withColumns(named | {f"e{i}": right for i, (_, right) in enumerate(equal)})
    ours = criteria.withColumns({f"e{i}": left for i, (left, _) in enumerate(equal)})
    rest = [c for c in candidates.columns if c != block and c not in keep]
    found = None
    for n in range(1 << len(equal)):
        tests = [f"e{i}" for i in range(len(equal)) if n >> i & 1]
        first = theirs.groupBy(block, *tests).agg(F.max(F.struct(*named, *keep, *rest)).alias("c")).select(block, *tests, "c.*")
        met = ours.join(first, [block, *tests]).withColumn("score", score).select("row_id", key.alias("x"))
        found = met if found is None else found.unionByName(met)
    return found.groupBy("row_id").agg(F.max("x").alias("x")).select("row_id", "x.score", *[f"x.{k}" for k in keep])
