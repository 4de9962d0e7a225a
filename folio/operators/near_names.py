"""Pairs of short texts that are alike: a join by q-grams whose bounds leave no pair of the wanted likeness out.

The likeness is the best ratio (twice the longest common subsequence in hundredths of both lengths) of the shorter text to a stretch of the longer one
of at most its length. A ratio of at least `least` leaves at most d = 2 m (1 - least / 100) characters of the shorter text (of m) and the stretch
unmatched. Each of them spoils at most q of the shorter text's q-grams, so c = m - q + 1 - q d of these are found in the longer text.

1. Each text takes the longest q of 3, 2, 1 for which c is positive (count bound).
2. Of its q-grams, any g - c + 1 hold one that the other text has: the rarest are its keys, by how often the other side has them. Only pairs
   that meet on a key of the shorter text go on, and a q-gram in a third of all texts is seldom a key.
3. Pairs with fewer than c of the shorter text's q-grams in the longer one are dropped, by array functions.
4. What is left is scored, and a stretch is only compared while its characters could still reach the score.

Cases: null and empty texts match nothing; texts are compared as they are, so fold them first; repeated ids of one text give repeated
pairs once; texts of one length have the left one as the shorter; very long texts are only ever the longer side of a pair, but as
the shorter one they are as right and slow.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.fuzzy import best_partial, partial

SIZES = (3, 2, 1)


def bound(size: Column, q: int, least: float) -> Column:
    """How many of a text's q-grams any text has that is alike enough."""
    return size - q + 1 - q * F.floor(2 * size * (100 - least) / 100 + F.lit(1e-9))


def grams(text: Column, q: int) -> Column:
    """The q-grams of a text in order, repeats included."""
    return F.when(F.length(text) >= q, F.transform(F.sequence(F.lit(1), F.length(text) - q + 1), lambda i: F.substring(text, i, F.lit(q)))).otherwise(F.array().cast("array<string>"))


def _sided(rows: DataFrame, named: tuple[str, str], by: list[str], least: float) -> DataFrame:
    """Rows (by, id, text, m, q): q is the size of q-grams in which the text is looked for as the shorter one."""
    own = rows.select(*by, F.col(named[0]).alias("id"), F.col(named[1]).alias("text")).where(F.length("text") > 0).distinct().withColumn("m", F.length("text"))
    pick = F.lit(SIZES[-1])
    for q in reversed(SIZES[:-1]):
        pick = F.when(bound(F.col("m"), q, least) > 0, q).otherwise(pick)
    return own.withColumn("q", pick)


def _exploded(side: DataFrame, by: list[str], q: int) -> DataFrame:
    return side.select(*by, "id", "m", F.explode(F.array_distinct(grams(F.col("text"), q))).alias("gram"))


def _candidates(short: DataFrame, long: DataFrame, by: list[str], least: float, strict: bool) -> DataFrame:
    """Rows (by, short, long): ids whose texts may be alike, the first one the shorter; strict: by a character at least."""
    out = None
    for q in SIZES:
        own = short.where(F.col("q") == q)
        others = _exploded(long, by, q)
        often = others.groupBy("gram").agg(F.count("*").alias("n"))
        keys = own.select(*by, "id", "m", F.posexplode(grams(F.col("text"), q)).alias("at", "gram")).join(often, "gram", "left")
        ranked = keys.groupBy(*by, "id", "m").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "at"))).alias("g"))
        first = F.slice("g", 1, (F.size("g") - bound(F.col("m"), q, least) + 1).cast("int"))
        keys = ranked.select(*by, F.col("id").alias("short"), F.col("m").alias("short_m"), F.explode(F.array_distinct(F.transform(first, lambda x: x["gram"]))).alias("gram"))
        met = keys.join(others.select(*by, F.col("id").alias("long"), F.col("m").alias("long_m"), "gram"), [*by, "gram"])
        met = met.where(F.col("short_m") < F.col("long_m") if strict else F.col("short_m") <= F.col("long_m")).select(*by, "short", "long").distinct()
        out = met if out is None else out.unionByName(met)
    return out


def _scored(least: float):
    """For mapInPandas: the score of each pair that reaches it."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in parts:
            scores = pd.Series([partial(a, b, least) for a, b in zip(rows["short_text"], rows["long_text"], strict=True)], index=rows.index, dtype="float64")
            yield rows.drop(columns=["short_text", "long_text"]).assign(score=scores)[scores >= least]

    return run


def near_pairs(left: DataFrame, right: DataFrame, left_named: tuple[str, str], right_named: tuple[str, str], least: float, by: list[str] | None = None) -> DataFrame:
    """Rows (by, left id, right id, score) of all pairs, of equal `by`, whose likeness is at least `least` (over 50). named: the id and the text of a side."""
    by = by or []
    if not 50 < least <= 100:
        raise ValueError("least must be over 50 and at most 100")
    one, two = _sided(left, left_named, by, least), _sided(right, right_named, by, least)
    pairs = None
    for short, long, names, strict in ((one, two, ("l", "r"), False), (two, one, ("r", "l"), True)):
        texts = lambda side, as_: side.select(*by, F.col("id").alias(as_), F.col("text").alias(f"{as_}_text"), F.col("q").alias(f"{as_}_q"), F.col("m").alias(f"{as_}_m"))
        found = _candidates(short, long, by, least, strict).join(texts(short, "short"), [*by, "short"]).join(texts(long, "long").drop("long_q"), [*by, "long"])
        tests = F.lit(False)
        for q in SIZES:
            there = F.size(F.filter(grams(F.col("short_text"), q), lambda g: F.col("long_text").contains(g)))
            tests = F.when(F.col("short_q") == q, there >= bound(F.col("short_m"), q, least)).otherwise(tests)
        found = found.where(tests & (F.col("short_m") <= F.col("long_m"))).select(*by, F.col("short").alias(names[0]), F.col("long").alias(names[1]), "short_text", "long_text")
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields if not f.name.endswith("_text")) + ", score double"
        scored = found.mapInPandas(_scored(least), schema).select(*by, "l", "r", "score")
        pairs = scored if pairs is None else pairs.unionByName(scored)
    return pairs.groupBy(*by, "l", "r").agg(F.max("score").alias("score")).withColumnsRenamed({"l": left_named[0], "r": right_named[0]})


def best_near(rows: DataFrame, by: str, names: list[str], text: str, least: float) -> DataFrame:
    """Rows (by, score): the best likeness, as near_pairs() gives it, of any of the names of a row to its text; where it reaches `least`.

    For names that are looked for in texts of their own only: each text is read once, where it lies, and no q-grams are shuffled.
    """
    kind = rows.schema[by].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [(key[0], max(best_partial(name, list(own), least) for name in key[1:])) for key, own in part.groupby([by, *names], sort=False)[text]]
            yield pd.DataFrame([x for x in found if x[1] >= least], columns=[by, "score"])

    if least <= 0:
        raise ValueError("least must be over 0")
    texts = rows.where(F.col(by).isNotNull()).select(by, *[F.coalesce(c, F.lit("")).alias(c) for c in (*names, text)])
    return texts.mapInPandas(run, f"`{by}` {kind}, score double").groupBy(by).agg(F.max("score").alias("score"))
