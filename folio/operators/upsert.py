"""Keyed writes without a table format: each gives the table's next version, to be written beside the old one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.shared import written


def replace_groups(old: DataFrame, new: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Old rows of the given groups go, all new rows come; a group without new rows is just cleared."""
    return old.join(groups.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, key: str, provided: dict[str, Column] | None = None) -> DataFrame:
    """Rows of new overwrite or join old by key. provided: where true, a column's new value counts even if null; by default where it isn't null."""
    names = [c for c in old.columns if c != key and c in new.columns]
    side = new.select(F.col(key), F.lit(True).alias("new_"), *[F.col(c).alias(f"{c}_new_") for c in names], *[(provided or {}).get(c, F.col(c).isNotNull()).alias(f"{c}_set_") for c in names])
    out = old.join(side, key, "full_outer")
    return out.withColumns({c: F.when(F.coalesce(f"{c}_set_", F.lit(False)), F.col(f"{c}_new_")).otherwise(F.col(c)) for c in names}).select(old.columns)


def numbered(rows: DataFrame, order: list[str], into: str) -> DataFrame:
    """Rows with their place 1..n in the given order; ties in the order of a hash of the row.

    Ranges of the order are sorted in parallel and written once with each row's place in its range: range bounds are sampled anew whenever a
    plan with other columns is run, so counts and rows must come from one table. A range's first number follows from the counts
    of the ranges before it, which are one row each.
    """
    spread = [*order, F.xxhash64(*rows.columns)]
    parts = rows.repartitionByRange(*spread).sortWithinPartitions(*spread).withColumn("place_", F.monotonically_increasing_id())
    parts = written(parts, "numbered").withColumns({"part_": F.shiftright("place_", 33), "own_": F.col("place_").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = parts.groupBy("part_").agg(F.count("*").alias("n_"))
    before = sizes.select("part_", F.coalesce(F.sum("n_").over(Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before_"))
    return parts.join(F.broadcast(before), "part_").withColumn(into, (F.col("before_") + F.col("own_") + 1).cast("long")).drop("part_", "own_", "place_", "before_")


def get_or_create(dim: DataFrame, names: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """The dimension with rows for names it lacks: ids follow the largest, in the order of the names. Null names get none."""
    new = names.select(name_col).where(F.col(name_col).isNotNull()).distinct().join(dim.select(name_col), name_col, "left_anti")
    top = F.broadcast(dim.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top_")))
    return dim.select(id_col, name_col).unionByName(numbered(new, [name_col], "k_").join(top).select((F.col("top_") + F.col("k_")).cast("long").alias(id_col), name_col))


def replace_log_group(log: DataFrame, new: DataFrame, keys: list[str], loose: str) -> DataFrame:
    """Log rows of the groups in new go, and new comes. Keys match null-safely; a stored null in `loose` matches any."""
    groups = new.select(*[F.col(k).alias(f"{k}_g") for k in [*keys, loose]]).distinct()
    on = F.col(loose).isNull() | F.col(loose).eqNullSafe(F.col(f"{loose}_g"))
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"{k}_g"))
    return log.join(groups, on, "left_anti").unionByName(new)
