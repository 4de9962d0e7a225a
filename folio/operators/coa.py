"""Resolving names to a chart of accounts, and building its tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.text import norm


def resolve(items: DataFrame, chart: DataFrame) -> DataFrame:
    """Items (template, datapoint, parent, section, ...) with coa_id and status mapped, ambiguous or unmapped.

    chart: rows (coa_id, template, name, parent_name, seq). In order: exact name under the parent, normal name under
    it, exact under the section's name, normal under it, then the exact and the normal name if the template has it
    once. In the first four the smallest seq wins. A missing or blank parent or section is no group and is passed over; an item
    without a name is unmapped. Each step is an equi-join against a small aggregate of the chart.
    """
    named = lambda c: F.when(F.trim(c) != "", F.col(c))
    chart = chart.select("coa_id", "template", "name", "parent_name", "seq", norm(F.col("name")).alias("n_name"), norm(F.col("parent_name")).alias("n_parent"))
    exact = chart.groupBy("template", "name", "parent_name").agg(F.min_by("coa_id", "seq").alias("id"))
    normal = chart.groupBy("template", "n_name", "n_parent").agg(F.min_by("coa_id", "seq").alias("id"))
    once = chart.groupBy("template", "name").agg(F.min("coa_id").alias("id"), F.count("*").alias("n"))
    once_normal = chart.groupBy("template", "n_name").agg(F.min("coa_id").alias("id"), F.count("*").alias("n"))
    own = {k: named(c) for k, c in (("d", "datapoint"), ("p", "parent"), ("s", "section"))}
    out = items.withColumns({f"{k}_": c for k, c in own.items()} | {f"{k}n_": F.when(c.isNotNull(), norm(c)) for k, c in own.items()})
    steps = [(exact, ["name", "parent_name"], ["d_", "p_"]), (normal, ["n_name", "n_parent"], ["dn_", "pn_"]), (exact, ["name", "parent_name"], ["d_", "s_"]), (normal, ["n_name", "n_parent"], ["dn_", "sn_"]), (once, ["name"], ["d_"]), (once_normal, ["n_name"], ["dn_"])]
    for k, (table, keys, own) in enumerate(steps):
        side = table.select(F.col("template").alias(f"t{k}_"), *[F.col(c).alias(f"k{k}_{c}") for c in keys], F.col("id").alias(f"id{k}_"), *([F.col("n").alias(f"n{k}_")] if k > 3 else []))
        on = F.col("template") == F.col(f"t{k}_")
        for c, o in zip(keys, own, strict=True):
            on &= F.col(o) == F.col(f"k{k}_{c}")
        out = out.join(side, on, "left")
    ids = [F.col(f"id{k}_") for k in range(4)] + [F.when(F.col(f"n{k}_") == 1, F.col(f"id{k}_")) for k in (4, 5)]
    out = out.withColumn("coa_id", F.coalesce(*ids))
    status = F.when(F.col("coa_id").isNotNull(), "mapped").when(F.col("n4_").isNotNull() | F.col("n5_").isNotNull(), "ambiguous").otherwise("unmapped")
    return out.withColumn("status", status).select(*items.columns, "coa_id", "status")


def build_tree(master: DataFrame) -> DataFrame:
    """Master rows (seq, statement 'A|B', section, flag, datapoint) to chart rows (template, display_seq, flag, datapoint, parent_seq).

    A row counts for each of its statements; its parent is the last DPG row above it in that statement, -1 before any.
    """
    rows = master.select("seq", F.explode(F.split("statement", "\\|")).alias("template"), F.upper(F.trim("flag")).alias("flag"), "datapoint").withColumn("template", F.trim("template"))
    line = Window.partitionBy("template").orderBy("seq")
    rows = rows.withColumn("display_seq", F.row_number().over(line))
    parent = F.last(F.when(F.col("flag") == "DPG", F.col("display_seq")), ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("parent_seq", F.when(F.col("flag") == "DPG", -1).otherwise(F.coalesce(parent, F.lit(-1)))).select("template", "display_seq", "flag", "datapoint", "parent_seq")
