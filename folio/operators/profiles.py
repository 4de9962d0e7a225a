"""What many files hold: profiles of their columns, sections that are missing, the chart's text cut to a statement.

A profile is one aggregation over all files: for each file and column the place where it is first seen, how many cells are filled and how many
look like numbers, and a sketch of distinct filled values. Two profiles merge by adding counts, taking the smaller place and uniting sketches, in any
order, so files may be profiled apart and joined later.

Cases: null cells are blank; a file without rows has no profile; names are trimmed before they are compared; repeated rows count each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns that are never amounts, what a blank amount looks like, keys and sections that a statement should have.
META = ["Statement", "Issuer Name", "FYE", "Page No", "Currency reported", "Section", "COA Flag", "COA Datapoint", "Total Check Status", "_chain_used"]
NOT_NUMERIC = ["Statement", "Issuer Name", "FYE", "Page No", "Currency reported", "Reported in Thousand", "Section", "COA Flag", "Row Items", "COA Datapoint"]
DASHES = ["-", "–", "—"]
TOP_KEYS = ["Metadata", "Reporting Columns", "Sections"]
SECTIONS = ["Assets", "Deferred Outflows of Resources", "Liabilities", "Deferred Inflows of Resources", "Net Position"]


def looks_numeric(value: Column) -> Column:
    """Whether a cell is digits with at most one point, once `$`, commas, brackets, hyphens and space are gone; blanks and dashes aren't."""
    text = F.trim(F.coalesce(value, F.lit("")))
    return ~text.isin("", *DASHES) & F.regexp_replace(text, r"[$,\s()\-]", "").rlike(r"\A(?:[0-9]+\.?[0-9]*|\.[0-9]+)\z")


def column_profiles(cells: DataFrame, by: list[str]) -> DataFrame:
    """Rows (by, column, place, n, filled, numeric, sketch) from cells (by, column, place, value)."""
    filled = F.trim(F.coalesce("value", F.lit(""))) != ""
    return cells.groupBy(*by, "column").agg(
        F.min("place").alias("place"), F.count("*").alias("n"), F.count_if(filled).alias("filled"), F.count_if(looks_numeric(F.col("value"))).alias("numeric"),
        F.hll_sketch_agg(F.coalesce("value", F.lit(""))).alias("sketch"),
    )


def merged_profiles(profiles: DataFrame, by: list[str]) -> DataFrame:
    """Profiles of parts of the same columns as one."""
    return profiles.groupBy(*by, "column").agg(F.min("place").alias("place"), *[F.sum(c).alias(c) for c in ("n", "filled", "numeric")], F.hll_union_agg("sketch").alias("sketch"))


def numeric_columns(profiles: DataFrame) -> DataFrame:
    """The profiles of columns with at least one number that aren't descriptions."""
    return profiles.where((F.col("numeric") > 0) & ~F.col("column").isin(NOT_NUMERIC))


def reporting_columns(profiles: DataFrame, by: list[str]) -> DataFrame:
    """The profiles of the amounts' columns: those after the datapoint up to the check's status or a name that begins with `_`, but for
    descriptions, unnamed ones and item labels. A file without a datapoint's column has none."""
    name = F.trim("column")
    place = F.col("place")
    start = profiles.groupBy(*by).agg(F.min(F.when(F.col("column") == "COA Datapoint", place)).alias("start_")).where("start_ is not null")
    after = profiles.join(start, by).where(place > F.col("start_"))
    stops = (name == "Total Check Status") | name.startswith("_")
    end = after.groupBy(*by).agg(F.coalesce(F.min(F.when(stops, place)), F.max(place) + 1).alias("end_"))
    plain = ~name.isin(META) & (name != "") & ~F.lower(name).startswith("unnamed") & ~name.endswith(" Items") & (name != "Row Items")
    return after.join(end, by).where((place < F.col("end_")) & plain).drop("start_", "end_")


def presence(keys: DataFrame, by: list[str], column: str, expected: list[str]) -> DataFrame:
    """Rows (by, missing, extra): the expected values that a group lacks, in their order, and those that it has besides, sorted."""
    found = keys.groupBy(*by).agg(F.collect_set(F.when(F.col(column).isin(expected), F.col(column))).alias("had_"), F.array_sort(F.collect_set(F.when(~F.col(column).isin(expected), F.col(column)))).alias("extra"))
    return found.select(*by, F.array_except(F.array(*[F.lit(x) for x in expected]), "had_").alias("missing"), "extra")


def section_counts(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows (by, sections, rows): how many different sections and rows each file has; a null section is none."""
    return rows.groupBy(*by).agg(F.count_distinct("section").alias("sections"), F.count("*").alias("rows"))


def tally(rows: DataFrame, column: str) -> DataFrame:
    """The values of a column with their counts, in the values' order."""
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(column)


def chart_order(chart: DataFrame) -> DataFrame:
    """The chart by template and its own sequence; rows of one place by id."""
    return chart.orderBy("template_id", "sequence", "id")


def allowed(wanted: Column, available: Column) -> tuple[Column, Column]:
    """Of the wanted values those that are available, and those that aren't; both in the wanted order."""
    return F.array_intersect(wanted, available), F.array_except(wanted, available)


def chart_lines_for(lines: DataFrame, keyword: Column) -> DataFrame:
    """Lines (.., line, text) of charts for one statement: the first line of each stays, others if their first field names the keyword among
    its parts. Fields are parted by ` | `, parts by `|`. Without a keyword nothing stays."""
    first = F.get(F.split("text", r" \| "), F.lit(0))
    parts = F.transform(F.split(first, r"\|"), lambda x: F.trim(x))
    return lines.where((keyword != "") & ((F.col("line") == 0) | (F.trim("text") != "") & F.array_contains(parts, keyword)))


def compressed_chart(lines: DataFrame) -> DataFrame:
    """The flag and the name of each line of at least five fields; a chart's first line and blank ones go."""
    fields = F.split("text", r" \| ")
    return lines.where((F.col("line") > 0) & (F.trim("text") != "") & (F.size(fields) >= 5)).withColumn("text", F.concat_ws(" | ", F.get(fields, F.lit(1)), F.get(fields, F.lit(2))))


def settled_steps(steps: DataFrame, expected: list[str], by: list[str]) -> DataFrame:
    """Rows (by, step, status, score, note) for each expected step of each group, from (by, step, status, score, error).

    A step that crashed is FAIL with score 0 whatever it said before; one that gave no row or no status is FAIL as well.
    """
    each = steps.select(*by).distinct().select(*by, F.explode(F.array(*[F.lit(x) for x in expected])).alias("step"))
    worst = steps.groupBy(*by, "step").agg(F.min("error").alias("error"), F.max(F.struct(F.coalesce("score", F.lit(0.0)).alias("score"), "status")).alias("best"))
    out = each.join(worst, [*by, "step"], "left")
    failed = F.col("error").isNotNull() | F.col("best.status").isNull()
    note = F.when(F.col("error").isNotNull(), F.concat(F.lit("crashed: "), "error")).when(F.col("best.status").isNull(), "no result").otherwise("")
    return out.select(*by, "step", F.when(failed, "FAIL").otherwise(F.col("best.status")).alias("status"), F.when(failed, 0.0).otherwise(F.col("best.score")).alias("score"), note.alias("note"))
