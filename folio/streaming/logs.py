"""Logs as streams: groups replaced as batches come, and counts over event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


GROUP = ["Id", "ProcessingId", "Stage", "SubStage"]
#: Columns of the display log with the types that its files are brought to.
LOG = {"Id": "long", "ProcessingId": "long", "Stage": "string", "SubStage": "string", "Seq": "int", "Time": "timestamp_ntz", "Message": "string"}


def display_order(log: DataFrame) -> DataFrame:
    """Log rows with the start of their group (Id, ProcessingId, Stage, SubStage), sorted by Id, ProcessingId, start, SubStage and Seq."""
    started = log.withColumn("started", F.min("Time").over(Window.partitionBy(*GROUP)))
    return started.orderBy("Id", "ProcessingId", "started", "SubStage", "Seq")


def with_seq(log: DataFrame, arrival: str) -> DataFrame:
    """Seq from 1 in each group by order of arrival."""
    return log.withColumn("Seq", F.row_number().over(Window.partitionBy(*GROUP).orderBy(arrival)))


def aligned(log: DataFrame) -> DataFrame:
    """The columns of LOG in order, leniently cast; what is missing or doesn't cast is null."""
    return log.select(*[(F.col(c).try_cast(t) if c in log.columns else F.lit(None).cast(t)).alias(c) for c, t in LOG.items()])


def read_log(spark: SparkSession, folder: str, year: int | None = None) -> DataFrame:
    """The log of one year, or of all: a table partitioned by year, of which only that year's files are read. A folder that is missing or
    without files is empty; files that can't be read raise."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at) or not any(s.isDirectory() or s.getPath().getName().endswith(".parquet") for s in files.listStatus(at)):
        return spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in LOG.items()))
    rows = spark.read.option("mergeSchema", True).parquet(folder)
    return aligned(rows if year is None else rows.where(F.col("year") == year))


def read_for(log: DataFrame, row_id: int | None = None, processing_id: int | None = None) -> DataFrame:
    """Rows of the given ids; an id that isn't given doesn't filter."""
    for c, v in (("Id", row_id), ("ProcessingId", processing_id)):
        log = log if v is None else log.where(F.col(c) == v)
    return log


def search(log: DataFrame, pattern: str, *columns: str) -> DataFrame:
    """Rows in which the pattern, case-insensitive, is found in any of the columns."""
    hit = F.lit(False)
    for c in columns:
        hit |= F.coalesce(F.col(c).cast("string").rlike(f"(?i){pattern}"), F.lit(False))
    return log.where(hit)


def tail(log: DataFrame, order: str, n: int = 500) -> DataFrame:
    """The last n rows, in order; Spark keeps the n largest of each task and merges those."""
    return log.orderBy(F.desc(order)).limit(n).orderBy(order)


def append_log(rows: DataFrame, folder: str) -> None:
    """Appends log rows below their year's folder; nothing that is there is rewritten."""
    rows.withColumn("year", F.year("Time")).write.mode("append").partitionBy("year").parquet(folder)


def windowed_counts(events: DataFrame, every: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts and sums per window and type; works on streams, where rows later than `late` are dropped."""
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    return events.groupBy(F.window("ts", every).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def ingest_keyed(spark: SparkSession, stream: DataFrame, folder: str, key: str, rows: int = 1_000_000):
    """Writes each micro-batch into a keyed store, replacing the groups of its keys; returns the started query.

    Only the key ranges that a batch touches are rewritten. A version carries the number of its batch, so a batch that is repeated after a failure
    changes nothing. The stream's progress lies beside the table, and a new start goes on from there.
    """
    from folio.sources.store import KeyedStore

    def write(batch: DataFrame, batch_id: int) -> None:
        store = KeyedStore(batch.sparkSession, folder, key, rows)
        if store.versions():
            store.replace(batch, batch=batch_id)
        else:
            store.create(batch, batch=batch_id)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/_progress").trigger(availableNow=True).start()


def ingest(spark: SparkSession, stream: DataFrame, version: str, key: str):
    """Writes each micro-batch as the next whole version of a table whose groups it replaces; returns the started query.

    version: a folder for the table's versions, named by batch id, so that a repeated batch overwrites its own output. Each batch
    rewrites the table: for small tables that are read as plain Parquet; ingest_keyed() rewrites what a batch touches only.
    """
    from folio.operators.upsert import replace_groups

    def write(batch: DataFrame, batch_id: int) -> None:
        now = batch
        if batch_id > 0:
            now = replace_groups(batch.sparkSession.read.parquet(f"{version}/{batch_id - 1}"), batch, batch, key)
        now.write.mode("overwrite").parquet(f"{version}/{batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{version}/_progress").trigger(availableNow=True).start()
