"""Tables in the folder that driver and executors share, where lineage ends."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; in local mode a new folder where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="folio-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table of the shared folder, read back; its files go when the driver ends."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
