"""The folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where the session names none, a local folder does only if driver and executors are one process;
    on a cluster that is an error, as executors would write where nobody else can read."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("tickfuse.shared.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[[^,]*(,.*)?\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set; it must name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="tickfuse-")
        spark.conf.set("tickfuse.shared.dir", named)
    return named


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, removed when the driver's JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/tickfuse/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def table(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a compressed table in the shared folder and reads it back: lineage ends there, so a lost
    executor costs no earlier stage."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
