"""From tidy statement rows to the fact table: groups carried down, items resolved to the chart, cells numbered, and the next version of the tables.

rows: as folio.sources.statements.tidy gives them, with deal and stmt_type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.amounts import is_empty
from folio.operators.coa import resolve
from folio.operators.upsert import get_or_create, numbered

#: Fixed value: the order in which a deal's statements are numbered; others come last.
STATEMENT_ORDER = ["SNP", "SOA", "GOV_BS", "GOV_IS", "PROP_SNP", "PROP_IS", "PROP_CFS", "DEBT", "DSR", "CAPITAL_ASSETS", "TAX_BASE", "OVERVIEW", "PEN", "OPEB", "FAQS"]


def statement_rank(c):
    """The place of a statement's type in STATEMENT_ORDER, from 0; 99 for others."""
    at = F.array_position(F.array(*[F.lit(x) for x in STATEMENT_ORDER]), c)
    return F.when(at > 0, at - 1).otherwise(99).cast("int")


def carry_group(rows: DataFrame) -> DataFrame:
    """Adds parent: the datapoint of the last DPG row above in the file, over the ends of sections.

    The rows are dealt out by file even if they lie so already: a task then doesn't hold what made them beside its own sort, and its share is
    measured by these rows, which are wider.
    """
    line = Window.partitionBy("deal", "file").orderBy("section_pos", "row_order", "col_pos")
    head = F.struct(F.col("datapoint").alias("name"))
    above = F.last(F.when(F.col("flag") == "DPG", head), ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, -1))
    return rows.repartition("deal", "file").withColumn("parent", above["name"])


def number_items(rows: DataFrame) -> DataFrame:
    """Adds disp_seq: the place of each item with a value among all of its deal's, by statement, file, section and row; its columns share it."""
    line = Window.partitionBy("deal").orderBy(statement_rank(F.col("stmt_type")), "file", "section_pos", "row_order")
    return rows.withColumn("disp_seq", F.dense_rank().over(line))


def facts(rows: DataFrame, chart: DataFrame, templates: DataFrame) -> DataFrame:
    """Stored cells: rows (deal, file, stmt_type, template, section, section_pos, row_order, category, coa_id, template_type, group_name, value, coord, disp_seq, status).

    chart: as resolve() takes it; templates: stmt_type, template. Headings and blank cells aren't stored; an item that isn't resolved is
    stored under its template and section, and dropped where it has no template either. Cells are resolved where they lie, after the sort of
    carry_group(), without a join to their items; only what is stored is shuffled again, by deal, to be numbered.
    """
    held = rows.where((F.col("flag") == "DPG") | ~is_empty(F.col("raw")))
    own = carry_group(held).where("flag <> 'DPG'").where(~is_empty(F.col("raw"))).join(F.broadcast(templates), "stmt_type", "left")
    key = ["deal", "file", "section_pos", "row_order"]
    placed = own.where(" and ".join(f"{k} is not null" for k in key))
    out = number_items(resolve(placed, chart).where("coa_id is not null or template is not null"))
    loose = F.col("coa_id").isNull()
    return out.select(*key[:2], "stmt_type", "template", "section", *key[2:], F.col("col").alias("category"), "coa_id", F.when(loose, F.col("template")).alias("template_type"), F.when(loose, F.col("section")).alias("group_name"), F.trim("raw").alias("value"), "coord", "disp_seq", "status")


def ingest_counts(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each deal: its files, stored cells, and items by how they were resolved; items count once, cells for each column."""
    kind = lambda s: F.count_if(F.col("status") == s).alias(s)
    items = stored.groupBy("deal", "file", "section_pos", "row_order", "status").agg(F.count("*").alias("n"))
    cells = items.groupBy("deal").agg(F.sum("n").alias("cells"), kind("mapped"), kind("ambiguous"), kind("unmapped"))
    files = rows.groupBy("deal").agg(F.count_distinct("file").alias("files"))
    return files.join(cells, "deal", "left").select("deal", "files", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("cells", "mapped", "ambiguous", "unmapped")])


def parent_names(chart: DataFrame) -> DataFrame:
    """Chart rows (id, parent_id, name) with parent_name, null without a parent."""
    return chart.join(chart.select(F.col("id").alias("parent_id"), F.col("name").alias("parent_name")), "parent_id", "left").select(*chart.columns, "parent_name")


def next_version(raw: DataFrame, dims: dict[str, DataFrame], pending: DataFrame, first: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The fact table and its name tables after a flush.

    raw: DataId, ProcessingId and others; dims: for a name column of pending its table (id, name); pending: ProcessingId, the name columns and others.
    first (ProcessingId): those flushed for the first time in the session, whose old rows go; rows of others are added to. An id in first
    without pending rows is just cleared. New ids follow the largest; a null name has a null id.
    """
    made = {}
    for column, dim in dims.items():
        made[column] = get_or_create(dim, pending.select(F.col(column).alias("name")), "id", "name")
        side = made[column].select(F.col("name").alias(column), F.col("id").alias(f"{column}_id"))
        pending = pending.join(side, column, "left").drop(column)
    kept = raw.join(first.select("ProcessingId").distinct(), "ProcessingId", "left_anti")
    top = F.broadcast(raw.agg(F.coalesce(F.max("DataId"), F.lit(0)).alias("top_")))
    order = ["ProcessingId", *(["disp_seq"] if "disp_seq" in pending.columns else [])]
    new = numbered(pending, order, "k_").join(top).withColumn("DataId", (F.col("top_") + F.col("k_")).cast("long")).drop("top_", "k_")
    return kept.unionByName(new, allowMissingColumns=True), made


def write_store(raw: DataFrame, dims: dict[str, DataFrame], folder: str) -> None:
    """Writes a version of all tables into a new folder; readers change to it when all are there, so none sees half a flush."""
    for name, table in {"RawData": raw, **dims}.items():
        table.write.mode("error").parquet(f"{folder}/{name}")


def most_common(rows: DataFrame, column: str, n: int = 15) -> DataFrame:
    """The n most frequent values with their counts; of equal counts the smaller value first."""
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(n)


def first_seen(rows: DataFrame, by: list[str], value: str, order: str) -> DataFrame:
    """Rows (by, values): the distinct values of each group in the order in which they are first seen."""
    first = rows.groupBy(*by, value).agg(F.min(order).alias("at_"))
    return first.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("at_", value))).alias("x")).select(*by, F.transform("x", lambda v: v[value]).alias("values"))
