"""Total checks: reported totals against their line items.

Statements are tidy rows (table_id, section, row_order, flag, label, datapoint, col, amt): flag DP for line items, CP for totals,
DPG for headings; one row per value column. Rules are DataFrame plans over all statements at once: a sum of items is
partially aggregated before its shuffle, a positional window is a running count of totals per section. Amounts are
decimals. Tables hold tens of rows, so a window partition is small however many statements there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TABLE = ["table_id", "section"]


def passes(computed: Column, reported: Column, tolerance: float = 1) -> Column:
    return F.abs(computed - reported) <= tolerance


def holds(label: Column, parts: list[str], start: bool = False) -> Column:
    out = F.lit(False)
    for p in parts:
        out |= F.lower(label).startswith(p.lower()) if start else F.lower(label).contains(p.lower())
    return out


def item_sums(rows: DataFrame, include: list[str] | None = None, exclude: list[str] = (), exclude_start: list[str] = (), by: list[str] = TABLE) -> DataFrame:
    """Sums of line items for each section and column, by label filters: rows (by, col, computed)."""
    items = rows.where("flag = 'DP'")
    if include is not None:
        items = items.where(holds(F.col("label"), include))
    items = items.where(~holds(F.col("label"), list(exclude)) & ~holds(F.col("label"), list(exclude_start), start=True))
    return items.groupBy(*by, "col").agg(F.sum("amt").alias("computed"))


def section_check(rows: DataFrame, exclude: list[str] = (), tolerance: float = 1) -> DataFrame:
    """Each section's totals against the sum of its items; with excludes, all items count if that passes more columns.

    Rows (table_id, section, row_order, datapoint, col, reported, computed, passed), and col_pos if rows have it. A missing
    amount is 0.
    """
    place = ["col_pos"] if "col_pos" in rows.columns else []
    totals = rows.where("flag = 'CP'").select(*TABLE, "row_order", "datapoint", "col", *place, F.coalesce("amt", F.lit(0)).alias("reported"))
    kept = ~holds(F.col("label"), list(exclude))
    sums = rows.where("flag = 'DP'").groupBy(*TABLE, "col").agg(F.sum("amt").alias("whole"), F.sum(F.when(kept, F.col("amt"))).alias("part"))
    out = totals.join(sums, [*TABLE, "col"], "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("whole", "part")})
    if not exclude:
        return out.drop("part").withColumnRenamed("whole", "computed").withColumn("passed", passes(F.col("computed"), F.col("reported"), tolerance))
    line = Window.partitionBy(*TABLE, "row_order")
    wins = F.sum(passes(F.col("whole"), F.col("reported"), tolerance).cast("int")).over(line) > F.sum(passes(F.col("part"), F.col("reported"), tolerance).cast("int")).over(line)
    out = out.withColumn("computed", F.when(wins, F.col("whole")).otherwise(F.col("part"))).drop("whole", "part")
    return out.withColumn("passed", passes(F.col("computed"), F.col("reported"), tolerance))


def positional_check(rows: DataFrame, rolling: bool = True, tolerance: float = 1) -> DataFrame:
    """Each total against the items since the last total; rolling: or against the last total plus those.

    Rows (table_id, section, row_order, col, reported, since, before, passed).
    """
    line = Window.partitionBy(*TABLE, "col").orderBy("row_order")
    total = F.col("flag") == "CP"
    amount = F.coalesce("amt", F.lit(0).cast("decimal(38,4)"))
    out = rows.where("flag in ('DP', 'CP')").withColumn("block", F.coalesce(F.sum(total.cast("int")).over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = out.withColumn("since", F.coalesce(F.sum(F.when(~total, amount)).over(Window.partitionBy(*TABLE, "col", "block")), F.lit(0)))
    out = out.withColumn("before", F.last(F.when(total, amount), ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, -1)))
    out = out.where(total).withColumn("reported", amount)
    good = passes(F.col("since"), F.col("reported"), tolerance)
    if rolling:
        good |= F.coalesce(passes(F.col("since") + F.col("before"), F.col("reported"), tolerance), F.lit(False))
    return out.withColumn("passed", good).select(*TABLE, "row_order", "col", "reported", "since", "before", "passed")


def first_present(candidates: DataFrame, tolerance: float = 1) -> DataFrame:
    """Of ordered formulas (table_id, chain, col, computed, reported) the first that fits on all columns, else the first usable one.

    A formula with a null in any column isn't usable. Rows (table_id, chain, status); status is PASS, the failing columns of
    the first usable formula as `col: FAIL`, or Skipped where none is usable.
    """
    good = passes(F.col("computed"), F.col("reported"), tolerance)
    fails = F.array_sort(F.collect_list(F.when(~good, F.concat("col", F.lit(": FAIL")))))
    whole = candidates.groupBy("table_id", "chain").agg(F.bool_and(F.col("computed").isNotNull()).alias("usable"), F.bool_and(F.coalesce(good, F.lit(False))).alias("fits"), fails.alias("fails"))
    rank = F.when(F.col("usable") & F.col("fits"), 0).when(F.col("usable"), 1).otherwise(2)
    best = whole.groupBy("table_id").agg(F.min(F.struct(rank.alias("rank"), "chain", "fails")).alias("x"))
    status = F.when(F.col("x.rank") == 0, "PASS").when(F.col("x.rank") == 1, F.array_join("x.fails", " | ")).otherwise("Skipped - no chain matched")
    return best.select("table_id", F.when(F.col("x.rank") < 2, F.col("x.chain")).alias("chain"), status.alias("status"))


def lookup_total(rows: DataFrame, name: str) -> DataFrame:
    """For each table and column the total named so: the last exact match, else the first with a shorter name that the wanted one holds."""
    own, want = F.lower(F.trim("datapoint")), name.strip().lower()
    exact = own == want
    near = F.lit(want).contains(own) & (F.length(own) < len(want))
    found = rows.where("flag = 'CP'").where(exact | near)
    order = F.struct(exact.cast("int").alias("e"), F.when(exact, F.col("row_order")).otherwise(-F.col("row_order")).alias("o"))
    return found.groupBy("table_id", "col").agg(F.max_by("amt", order).alias("amt"))


def status_text(checked: DataFrame) -> DataFrame:
    """One row per total: PASS, or its failing columns as `col: FAIL | col: FAIL` in the order of col_pos (of names without it)."""
    place = F.col("col_pos") if "col_pos" in checked.columns else F.lit(0)
    fails = F.array_sort(F.collect_list(F.when(~F.col("passed"), F.struct(place.alias("at"), F.concat("col", F.lit(": FAIL")).alias("text")))))
    out = checked.groupBy(*TABLE, "row_order").agg(F.transform(fails, lambda x: x["text"]).alias("fails"))
    return out.select(*TABLE, "row_order", F.when(F.size("fails") == 0, "PASS").otherwise(F.array_join("fails", " | ")).alias("status"))


#: Statuses of totals that let a statement pass.
ACCEPTED = ["", "PASS", "Skipped - no membership rule defined", "Skipped - no rule defined"]


def accepted(status: Column) -> Column:
    """Whether a total's status lets its statement pass."""
    return status.isNull() | status.isin(ACCEPTED)


def file_passes(statuses: DataFrame, by: list[str]) -> DataFrame:
    """Whether all totals of each group are accepted: rows (by, passed); rows (by, flag, status). A group without totals passes."""
    total = F.upper(F.trim("flag")) == "CP"
    return statuses.groupBy(*by).agg(F.coalesce(F.bool_and(F.when(total, accepted(F.col("status")))), F.lit(True)).alias("passed"))


def summary(statuses: DataFrame, by: list[str]) -> DataFrame:
    """Counts of totals by status for each group."""
    s = F.col("status")
    return statuses.groupBy(*by).agg(F.count("*").alias("n_total"), F.count_if(s == "PASS").alias("n_pass"), F.count_if(s.contains("FAIL")).alias("n_fail"), F.count_if(s.startswith("Skipped")).alias("n_skipped"), F.count_if(s.isNull() | (s == "")).alias("n_blank"))


def melt(wide: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Wide rows to tidy ones: (keys, col, amt)."""
    return wide.unpivot(keys, values, "col", "amt")


def widen(tidy: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    return tidy.groupBy(*keys).pivot("col", values).agg(F.first("amt"))
