"""Which filing belongs to an entity and year, and which file to a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.names import state_code

#: What each agreeing field is worth.
WEIGHTS = {"uei": 50, "year": 20, "state": 10, "entity": 8, "entity_part": 5}


def newest_filing(wanted: DataFrame, filings: DataFrame) -> DataFrame:
    """For each wanted row (row_id, uei, state, low, high) the newest filing (uei, state, year, report) of its uei and state with a year from low to
    high; else the newest of its uei in the state first in the alphabet that has one; of one state's and year's the least report. Adds year, report, found_state.

    A uei's filings become one array, an entry for each state and year, before they meet the wanted rows: those are joined to one row each, so
    however many of both share a uei, no pairs are made. Without a state wanted no filing counts.
    """
    each = filings.where(F.col("uei").isNotNull() & F.col("state").isNotNull() & F.col("year").isNotNull()).groupBy("uei", "state", "year").agg(F.min("report").alias("report"))
    held = each.groupBy("uei").agg(F.collect_list(F.struct("state", "year", "report")).alias("held"))

    def entry(x):
        other = (x["state"] != F.col("state")).cast("int")
        return F.struct(other.alias("other"), F.when(other == 1, x["state"]).alias("by"), (-x["year"]).alias("back"), x["report"].alias("report"), x["state"].alias("own_state"))

    inside = F.filter("held", lambda x: x["year"].between(F.col("low"), F.col("high")) & F.col("state").isNotNull())
    best = wanted.join(held, "uei", "left").withColumn("b", F.array_min(F.transform(inside, entry)))
    return best.select(*wanted.columns, (-F.col("b.back")).alias("year"), "b.report", F.col("b.own_state").alias("found_state"))


def reliance(wanted: dict[str, Column], own: dict[str, Column]) -> Column:
    """The score of a filing: WEIGHTS of the fields that agree; an entity type that holds the wanted one, or is held by it, is worth a part."""
    has = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    bare = lambda c: F.replace(F.trim(c), F.lit(" "), F.lit(""))
    a, b = F.lower(F.trim(wanted["entity"])), F.lower(F.trim(F.coalesce(own["entity"], F.lit(""))))
    points = [
        F.when(has(wanted["uei"]) & (bare(wanted["uei"]) == bare(own["uei"])), WEIGHTS["uei"]),
        F.when(has(wanted["year"]) & (F.trim(wanted["year"]) == F.trim(own["year"])), WEIGHTS["year"]),
        F.when(has(wanted["state"]) & (state_code(wanted["state"]) == state_code(own["state"])), WEIGHTS["state"]),
        F.when(has(wanted["entity"]), F.when(a == b, WEIGHTS["entity"]).when(b.contains(a) | a.contains(b), WEIGHTS["entity_part"])),
    ]
    total = F.lit(0)
    for p in points:
        total = total + F.coalesce(p, F.lit(0))
    return total


def best_reliant(criteria: DataFrame, filings: DataFrame) -> DataFrame:
    """For each criterion (row_id, sheet, uei, year, state, entity) the filing of its sheet (sheet, row, report, uei, year, state, entity, submitted)
    with the highest score; of equal ones the one submitted last, then the first row. A sheet's rows without report and uei don't count; the
    first data row, 2, is taken where there is none. Filings meet the criteria of their own sheet only."""
    own = filings.where((F.trim(F.coalesce("report", F.lit(""))) != "") | (F.trim(F.coalesce("uei", F.lit(""))) != ""))
    own = own.select("sheet", *[F.col(c).alias(f"{c}_") for c in ("row", "uei", "year", "state", "entity", "submitted")])
    fields = ("uei", "year", "state", "entity")
    pairs = criteria.join(own, "sheet").withColumn("score", reliance({c: F.col(c) for c in fields}, {c: F.col(f"{c}_") for c in fields}))
    best = pairs.groupBy("row_id").agg(F.max(F.struct("score", F.col("submitted_").isNotNull().alias("dated"), "submitted_", (-F.col("row_")).alias("back"))).alias("b"))
    return criteria.join(best, "row_id", "left").select("row_id", F.coalesce(-F.col("b.back"), F.lit(2)).alias("row"), "b.score")


def find_or_create(existing: DataFrame, wanted: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Wanted rows with the id of the existing row (id, keys) of the same keys, null being equal to null, and the table with rows for new keys."""
    from folio.operators.upsert import numbered

    same = lambda left, right: [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    on = same("l", "r")
    new = wanted.select(*keys).distinct().alias("l").join(existing.alias("r"), on, "left_anti")
    top = F.broadcast(existing.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top_")))
    table = existing.select("id", *keys).unionByName(numbered(new, keys, "k_").join(top).select((F.col("top_") + F.col("k_")).cast("long").alias("id"), *keys))
    first = table.groupBy(*keys).agg(F.min("id").alias("id"))
    found = wanted.alias("l").join(first.alias("r"), on, "left").select("l.*", F.col("r.id").alias("id"))
    return found, table


def latest_year(filings: DataFrame, by: list[str]) -> DataFrame:
    """The largest year of each group; what isn't a whole number doesn't count."""
    return filings.groupBy(*by).agg(F.max(F.col("year").try_cast("int")).alias("year"))


def first_found(left: DataFrame, sources: list[tuple[DataFrame, list[str]]], value: str) -> DataFrame:
    """Adds the value of the first source (a table and its key columns, unique) that has the row's keys."""
    for i, (table, keys) in enumerate(sources):
        left = left.join(table.select(*keys, F.col(value).alias(f"{value}_{i}_")), keys, "left")
    parts = [f"{value}_{i}_" for i in range(len(sources))]
    return left.withColumn(value, F.coalesce(*parts)).drop(*parts)


def results_to_jobs(jobs: DataFrame, results: DataFrame, most: int = 64) -> DataFrame:
    """Jobs (custom_id) with their results (safe_id, result): an id is made safe by writing all but letters, digits, _ and - as _, cut at most.

    Different ids that become the same safe id raise, as their results could not be told apart.
    """
    safe = F.substring(F.regexp_replace("custom_id", "[^A-Za-z0-9_-]", "_"), 1, most)
    by = Window.partitionBy("safe_id")
    low, high = F.min("custom_id").over(by), F.max("custom_id").over(by)
    clash = F.raise_error(F.concat(F.lit("ids with the same safe id: "), low, F.lit(", "), high)).cast("string")
    named = jobs.withColumn("safe_id", safe).withColumn("safe_id", F.when(low == high, F.col("safe_id")).when(F.col("custom_id").isNotNull(), clash))
    return named.join(results, "safe_id", "left").drop("safe_id")
