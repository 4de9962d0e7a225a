"""Verdicts over steps, and islands over positions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gate(steps: DataFrame, by: list[str]) -> DataFrame:
    """One verdict per group: FAIL over REVIEW over PASS; NOT APPLICABLE doesn't count, nothing left is REVIEW, anything else is FAIL."""
    s = F.col("status")
    rank = F.when(s == "NOT APPLICABLE", None).when(s == "PASS", 1).when(s == "REVIEW", 2).otherwise(3)
    worst = F.max(rank)
    return steps.groupBy(*by).agg(F.when(worst == 1, "PASS").when(worst == 3, "FAIL").otherwise("REVIEW").alias("gate"))


def overall(*gates: Column) -> Column:
    """OCR REQUIRED over unknown and FAIL over REVIEW over PASS."""
    any_of = lambda test: reduce(lambda a, b: a | b, [test(g) for g in gates])
    known = ["PASS", "REVIEW", "FAIL"]
    return F.when(any_of(lambda g: g == "OCR REQUIRED"), "OCR REQUIRED").when(any_of(lambda g: g.isNull() | ~g.isin(known) | (g == "FAIL")), "FAIL").when(any_of(lambda g: g == "REVIEW"), "REVIEW").otherwise("PASS")


def islands(rows: DataFrame, by: list[str], at: str, gap: float) -> DataFrame:
    """Distinct positions of each group with the number of their island; a step of more than gap starts the next, from 0."""
    line = Window.partitionBy(*by).orderBy(at)
    far = (F.col(at) - F.lag(at).over(line) > gap).cast("long")
    return rows.select(*by, at).distinct().withColumn("island", F.coalesce(F.sum(far).over(line), F.lit(0)))


def centroids(rows: DataFrame, by: list[str], at: str, gap: float) -> DataFrame:
    """The mean of the distinct positions of each island."""
    return islands(rows, by, at, gap).groupBy(*by, "island").agg(F.avg(at).alias("centroid"), F.count("*").alias("n"))
