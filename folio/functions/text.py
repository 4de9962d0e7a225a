"""Names, headers and dates as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm(c: Column) -> Column:
    """Underscores are spaces, runs of white space one space, trimmed, lower case; null is blank."""
    return F.lower(F.trim(F.regexp_replace(F.replace(F.coalesce(c, F.lit("")), F.lit("_"), F.lit(" ")), r"\s+", " ")))


def slug(c: Column) -> Column:
    """Lower case, runs of anything but letters and digits one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def name_tokens(c: Column, stop: list[str]) -> Column:
    """The distinct words of a name in order, without stop words and numbers."""
    words = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), " ")
    return F.array_distinct(F.filter(words, lambda w: (w != "") & ~w.isin(stop) & ~w.rlike("^[0-9]+$")))


def match_pct(tokens: Column, text: Column) -> Column:
    """Hundredths of the tokens that are whole words of the text, with two decimals; 0 without tokens."""
    words = F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "), " ")
    return F.when(F.size(tokens) > 0, F.round(100.0 * F.size(F.array_intersect(tokens, words)) / F.size(tokens), 2)).otherwise(0.0)


def as_date(c: Column, formats: tuple[str, ...] = ("yyyy-MM-dd", "MM/dd/yyyy", "M/d/yyyy", "dd-MMM-yyyy", "yyyyMMdd")) -> Column:
    """The date by the first format that fits, else null."""
    return F.coalesce(*[F.try_to_timestamp(F.trim(c), F.lit(f)).cast("date") for f in formats])


def first_match(text: Column, rules: list[tuple[str, str]], other: str) -> Column:
    """The name of the first pattern found in the text."""
    return reduce(lambda c, r: c.when(text.rlike(r[1]), r[0]), rules[1:], F.when(text.rlike(rules[0][1]), rules[0][0])).otherwise(other)


def capped_score(text: Column, weights: list[tuple[str, int]], cap: int = 3) -> Column:
    """The sum of each pattern's weight times how often it is found, at most cap times."""
    return reduce(lambda a, b: a + b, [F.least(F.regexp_count(text, F.lit(p)), F.lit(cap)) * w for p, w in weights]).cast("long")
