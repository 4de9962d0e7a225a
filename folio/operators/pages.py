"""Which pages a statement stands on: tests of a page's text, tiers of evidence, maps of pages."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.operators.gates import islands


@dataclass(frozen=True)
class PageTest:
    """A page passes if it holds all of `every`, one of `some` (if any), none of `none`, and each of `least` as often as it says."""

    name: str
    every: tuple[str, ...] = ()
    some: tuple[str, ...] = ()
    none: tuple[str, ...] = ()
    least: dict[str, int] = field(default_factory=dict)

    def on(self, text: Column) -> Column:
        tests = [text.rlike(p) for p in self.every] + [~text.rlike(p) for p in self.none] + [F.regexp_count(text, F.lit(p)) >= n for p, n in self.least.items()]
        if self.some:
            tests.append(reduce(lambda a, b: a | b, [text.rlike(p) for p in self.some]))
        return reduce(lambda a, b: a & b, tests, F.lit(True))


def page_flags(pages: DataFrame, text: str, tests: list[PageTest]) -> DataFrame:
    """One boolean for each test, in one pass over the pages; a null text is blank."""
    return pages.withColumns({t.name: t.on(F.coalesce(F.col(text), F.lit(""))) for t in tests})


def best_hit(hits: DataFrame, by: list[str], tier: Column, order: list[str], keep: list[str]) -> DataFrame:
    """Each group's hit of the lowest tier, then the first by `order`; hits with a null tier don't count.

    A minimum of a struct, so Spark combines it before the shuffle and a hot group stays small.
    """
    key = F.struct(tier.alias("tier"), *order, *[k for k in keep if k not in order])
    return hits.where(tier.isNotNull()).groupBy(*by).agg(F.min(key).alias("x")).select(*by, "x.tier", *[f"x.{k}" for k in keep])


def first_cluster(pages: DataFrame, by: list[str], at: str, gap: int = 1) -> DataFrame:
    """The pages of each group up to the first step of more than gap."""
    return islands(pages, by, at, gap).where("island = 0").drop("island")


def clean_map(pages: DataFrame, n_pages: DataFrame, offset: int = 0) -> DataFrame:
    """Rows (doc_id, statement, page) moved by offset, once each, without those outside 1 to n_pages (doc_id, n_pages)."""
    moved = pages.withColumn("page", F.col("page") + offset).join(n_pages, "doc_id")
    return moved.where(F.col("page").between(1, F.col("n_pages"))).select("doc_id", "statement", "page").distinct()


def shredded(text: Column, share: float = 0.5, least: int = 8) -> Column:
    """Whether more than a share of at least so many words are single characters, as in letter-spaced text."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")
    single = F.size(F.filter(words, lambda w: F.length(w) == 1))
    return (F.size(words) >= least) & (single > F.size(words) * share)


def join_letters(text: Column) -> Column:
    """Letters parted by single spaces become words; two or more spaces part words."""
    return F.regexp_replace(F.regexp_replace(text, r"(?<=\b\p{L}) (?=\p{L}\b)", ""), r" {2,}", " ")
