"""Statement documents (JSON, one file each) as tidy rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: statement codes in file names; longer ones come before their parts.
CODES = ["CAPITAL_ASSETS", "TAX_BASE", "PROP_SNP", "PROP_CFS", "PROP_IS", "OVERVIEW", "GOV_BS", "GOV_IS", "DEBT", "FAQS", "OPEB", "DSR", "PEN", "SNP", "SOA"]
SHAPE = "`Metadata` map<string,string>, `Reporting Columns` array<string>, `Sections` map<string,array<map<string,string>>>"
NOT_LABELS = ["COA Flag", "COA Datapoint", "Total Check Status"]


def read_statements(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, deal, stmt_type, doc): each JSON file below path; a file that can't be parsed is dropped."""
    raw = spark.read.text(path, wholetext=True).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    name = rf"^(.*?)_({'|'.join(CODES)})(?:_Comp)?_p[0-9-]+\.json$"
    out = raw.select("file", F.regexp_extract("file", name, 1).alias("deal"), F.regexp_extract("file", name, 2).alias("stmt_type"), F.from_json("value", SHAPE).alias("doc"))
    return out.where("doc.Sections is not null")


def tidy(statements: DataFrame) -> DataFrame:
    """One row per statement row and reporting column, in document order:
    (file, deal, stmt_type, section, section_pos, row_order, flag, label, datapoint, col, col_pos, raw, coord)."""
    rows = statements.select("file", "deal", "stmt_type", F.col("doc.`Reporting Columns`").alias("cols"), F.posexplode(F.map_entries("doc.Sections")).alias("section_pos", "s"))
    rows = rows.select("file", "deal", "stmt_type", "cols", "section_pos", F.col("s.key").alias("section"), F.posexplode("s.value").alias("row_order", "row"))
    keys = F.filter(F.map_keys("row"), lambda k: ~k.isin(NOT_LABELS) & ~k.endswith("_coord") & ~F.array_contains("cols", k))
    rows = rows.withColumns({"flag": F.upper(F.trim(F.col("row")["COA Flag"])), "label": F.element_at("row", F.get(keys, F.lit(0))), "datapoint": F.col("row")["COA Datapoint"]})
    rows = rows.select("*", F.posexplode("cols").alias("col_pos", "col"))
    return rows.select("file", "deal", "stmt_type", "section", "section_pos", "row_order", "flag", "label", "datapoint", "col", "col_pos", F.element_at("row", F.col("col")).alias("raw"), F.element_at("row", F.concat("col", F.lit("_coord"))).alias("coord"))


def expand_compact(rows: DataFrame) -> DataFrame:
    """Positional arrays (flag, item, datapoint, status, v1..vn) with their columns: rows (…, flag, label, datapoint, col, raw); missing values are '-'."""
    at = lambda i: F.get(F.col("cells"), i)
    out = rows.select("*", F.posexplode("cols").alias("col_pos", "col"))
    return out.withColumns({"flag": at(F.lit(0)), "label": at(F.lit(1)), "datapoint": at(F.lit(2)), "raw": F.coalesce(at(F.col("col_pos") + 4), F.lit("-"))}).drop("cells", "cols")
