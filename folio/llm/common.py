"""What the operators of this subpackage share: tables, the shared folder, components."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the white space that separates words, as code points 0x20 and 0x09-0x0D.
SPACES = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode a new folder where it is unset."""
    set_to = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not set_to:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="folio-"))
        set_to = spark.sparkContext.getCheckpointDir()
    return set_to


def table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_open = threading.local()


class Scratch:
    """The tables that stored() makes in this thread inside `with`; delete() removes them when nothing reads them any more.

    Tables made outside of any scratch stay until the session's file system is closed, at the latest when the driver ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        _open.__dict__.setdefault("stack", []).append(self)
        return self

    def __exit__(self, *_) -> None:
        _open.stack.pop()

    def delete(self) -> None:
        while self.paths:
            delete(self.spark, self.paths.pop())


def _new_path(spark: SparkSession, name: str) -> str:
    path = table_path(spark, name)
    stack = _open.__dict__.get("stack")
    if stack:
        stack[-1].paths.append(path)
    else:
        _files(spark, path).deleteOnExit(spark._jvm.org.apache.hadoop.fs.Path(path))
    return path


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Writes df to the shared folder and reads it back: the lineage ends there, and a lost executor costs a read.

    keep: the table is no scratch and is never deleted here.
    """
    path = table_path(df.sparkSession, name) if keep else _new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _files(spark: SparkSession, folder: str):
    return spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, folder: str) -> None:
    _files(spark, folder).delete(spark._jvm.org.apache.hadoop.fs.Path(folder), True)


def drop_stored(df: DataFrame) -> None:
    """Deletes the files of a table made by stored() that nothing reads any more."""
    for folder in {f.rsplit("/part-", 1)[0] for f in df.inputFiles()}:
        delete(df.sparkSession, folder)


def sized(df: DataFrame, most: int) -> DataFrame:
    """df, to be broadcast if a count shows at most so many rows; else Spark shuffles both sides."""
    return F.broadcast(df) if df.count() <= most else df


def ascii_lower(c):
    """A-Z to a-z; all other characters stay."""
    return F.translate(c, UPPER, LOWER)


def words(c):
    """The words `[^\\x20\\x09-\\x0D]+` of a text, as an array; empty for null."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a long, b long): rows (node, component), component the smallest node.

    Alternates large stars and small stars. Minima are pre-aggregated before each shuffle, and a node with very
    many neighbours is a skewed join key that adaptive execution splits. Each round's edges are written to the
    shared folder, and rounds go on until the edges stay the same; their number grows with the logarithm of the nodes. Null ends and loops are dropped; a node without edges has no row.
    """
    now = stored(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = state(now)
    while before[0]:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("v", "u")).alias("u"), F.col("m").alias("v"))
        small = small.where("u <> v").distinct()
        last, now = now, stored(small, "edges")
        drop_stored(last)
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
