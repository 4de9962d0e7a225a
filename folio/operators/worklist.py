"""Work lists: stage filters, the status machine, joins to their dimensions, reuse of files already sourced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STAGES = ["Sourcing", "SourcingValidation", "Extraction"]


def _done(stage: str) -> Column:
    return (F.col(f"{stage}Status") == 1) & (F.col(f"{stage}Flag") == "c")


def _open(stage: str) -> Column:
    status, flag = F.col(f"{stage}Status"), F.col(f"{stage}Flag")
    return (flag.isNull() | (flag == "c")) & (status.isNull() | (status == 0))


#: The charts whose rows are worked on.
CHARTS = [1, 2]


def active(work: DataFrame, companies: DataFrame) -> DataFrame:
    """Active rows of active companies (CompanyId, IsActive); both tables' flags must be 1."""
    live = companies.where(F.col("IsActive") == 1).select("CompanyId").distinct()
    return work.where(F.col("IsActive") == 1).join(live, "CompanyId", "left_semi")


def pending(work: DataFrame, stage: str, companies: DataFrame | None = None) -> DataFrame:
    """Active rows of the CHARTS whose earlier stages are done and whose own isn't; with companies, of active ones only."""
    ready = (F.col("IsActive") == 1) & F.col("COAID").isin(CHARTS) & (F.col("CompletionStatus").isNull() | (F.col("CompletionStatus") == 0)) & _open(stage)
    for before in STAGES[: STAGES.index(stage)]:
        ready &= _done(before)
    out = work.where(ready)
    return out if companies is None else active(out, companies)


def single(work: DataFrame, companies: DataFrame, row_id: int) -> DataFrame:
    """The one row asked for, whatever its stages' flags; it and its company must be active."""
    return active(work.where(F.col("Id") == row_id), companies)


def pending_by_module(work: DataFrame, companies: DataFrame, stage: str, module: int = 1) -> DataFrame:
    """The older rule: companies (CompanyId, IsActive, ModuleId) of a module, whatever the chart."""
    own = companies.where(F.col("ModuleId") == module)
    return pending(work.withColumn("COAID", F.lit(CHARTS[0])), stage, own).drop("COAID").join(work.select("Id", "COAID"), "Id").select(work.columns)


def advance(work: DataFrame, ids: DataFrame, stage: str, status: int, flag: str, remark: str | None = None, most: int = 500) -> DataFrame:
    """The work list with the stage's status, flag and remark set for the rows in ids (Id)."""
    hit = work.join(ids.select("Id", F.lit(True).alias("hit_")).distinct(), "Id", "left")
    out = hit.withColumn(f"{stage}Status", F.when(F.col("hit_"), F.lit(status)).otherwise(F.col(f"{stage}Status")))
    out = out.withColumn(f"{stage}Flag", F.when(F.col("hit_"), F.lit(flag)).otherwise(F.col(f"{stage}Flag")))
    if remark is not None:
        out = out.withColumn("Remarks", F.when(F.col("hit_"), F.substring(F.lit(remark), 1, most)).otherwise(F.col("Remarks")))
    return out.drop("hit_").select(work.columns)


def reset(work: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Extraction set back to pending and ModifiedOn to now: for the active rows in ids (Id), or without ids for all active rows of the
    CHARTS that sourcing validation has finished."""
    clear = ("ExtractionStatus", "ExtractionFlag", "DataValidationStatus", "DataValidationFlag", "CompletionStatus", "OutputPath", "Remarks")
    live = F.col("IsActive") == 1
    if ids is None:
        out, hit = work, live & F.col("COAID").isin(CHARTS) & _done("SourcingValidation")
    else:
        out, hit = work.join(ids.select("Id", F.lit(True).alias("hit_")).distinct(), "Id", "left"), live & F.col("hit_")
    hit = F.coalesce(hit, F.lit(False))
    now = F.current_timestamp().cast(work.schema["ModifiedOn"].dataType)
    changed = {c: F.when(~hit, F.col(c)) for c in clear} | {"ModifiedOn": F.when(hit, now).otherwise(F.col("ModifiedOn"))}
    return out.withColumns(changed).select(work.columns)


def completed(work: DataFrame) -> DataFrame:
    """CompletionStatus is 1 where extraction and data validation both are, else what it was."""
    both = (F.col("ExtractionStatus") == 1) & (F.col("DataValidationStatus") == 1)
    return work.withColumn("CompletionStatus", F.when(both, 1).otherwise(F.col("CompletionStatus")))


def work_items(rows: DataFrame) -> DataFrame:
    """Rows with year, uei, state, sector and entity as trimmed text, blank where missing; rows with neither year nor uei go."""
    own = [c for c in ("year", "uei", "state", "sector", "entity") if c in rows.columns]
    out = rows.withColumns({c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in own})
    return out.where((F.col("year") != "") | (F.col("uei") != ""))


def downloadable(rows: DataFrame) -> DataFrame:
    """Rows with a name whose status is blank or NOT FOUND."""
    status = F.upper(F.trim(F.coalesce("status", F.lit(""))))
    return rows.where((F.trim(F.coalesce("name", F.lit(""))) != "") & status.isin("", "NOT FOUND"))


def mark_both(work: DataFrame, info: DataFrame, ids: DataFrame, on_work: dict[str, Column], on_info: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """The next versions of the work list and of its 1:1 table (ID) with columns set for the rows in ids (Id); both are to be written before either is swapped in."""

    def marked(table: DataFrame, key: str, changes: dict[str, Column]) -> DataFrame:
        hit = table.join(ids.select(F.col("Id").alias(key), F.lit(True).alias("hit_")).distinct(), key, "left")
        return hit.withColumns({c: F.when(F.col("hit_"), v).otherwise(F.col(c)) for c, v in changes.items()}).select(table.columns)

    return marked(work, "Id", on_work), marked(info, "ID", on_info)


def without_seeded(info: DataFrame, work: DataFrame, creator: str) -> DataFrame:
    """Rows of the 1:1 table (ID) but those of work rows made by creator."""
    return info.join(work.where(F.col("CreatedBy") == creator).select(F.col("Id").alias("ID")), "ID", "left_anti")


def insert_with_child(work: DataFrame, new: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """New rows get ids after the largest, in the given order; returns the work list with them and their 1:1 child rows (ID, order)."""
    from folio.operators.upsert import numbered

    top = F.broadcast(work.agg(F.coalesce(F.max("Id"), F.lit(0)).alias("top_")))
    named = numbered(new, order, "k_").join(top).withColumn("Id", (F.col("top_") + F.col("k_")).cast(work.schema["Id"].dataType)).drop("top_", "k_")
    return work.unionByName(named, allowMissingColumns=True), named.select(F.col("Id").alias("ID"), *order)


def with_firm(work: DataFrame, info: DataFrame) -> DataFrame:
    """The work list with the auditor's firm of its 1:1 row (ID, AuditorFirm), by one join for all rows."""
    return work.join(info.select(F.col("ID").alias("Id"), F.col("AuditorFirm").alias("Firm")), "Id", "left")


def materialize(subscriptions: DataFrame, client_charts: DataFrame, charts: DataFrame, segments: DataFrame, file_types: DataFrame) -> DataFrame:
    """Work rows to make: each company of a client's chart, with each file type of the chart's segment; each (chart, company, year, type) once.

    subscriptions (ClientCOAMappingId, CompanyId, ProcessYear), client_charts (ClientCOAMappingId, COAID), charts (COAID, SegmentId),
    segments (SegmentId), file_types (SegmentId, FileTypeId).
    """
    small = client_charts.join(charts, "COAID").join(segments.select("SegmentId"), "SegmentId").join(file_types, "SegmentId")
    return subscriptions.join(small, "ClientCOAMappingId").select("COAID", "CompanyId", "ProcessYear", "FileTypeId").distinct()


def reuse(work: DataFrame) -> DataFrame:
    """Rows whose company, file type and year were validated already, with the file to reuse; the smallest Id is the source."""
    key = Window.partitionBy("CompanyId", "FileTypeId", "ProcessYear")
    source = F.min(F.when(F.col("SourcingValidationStatus") == 1, F.col("Id"))).over(key)
    return work.withColumn("SourceId", source).where("SourceId is not null and SourceId <> Id")
