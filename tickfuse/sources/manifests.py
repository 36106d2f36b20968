"""The manifest of sharded output: NDJSON lines of prepare, commit and spill."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.manifest import committed
from ..schemas import MANIFEST


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """line_no, type, segment_id, clock_ms, duration_ms, shard_id, file; lines that aren't JSON are left out. line_no orders
    lines by file path and by their place in it: a manifest file is small and read whole, so the order doesn't depend on how
    files are dealt to tasks."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.split("value", "\n").alias("lines"))
    rank = whole.select("path").distinct()
    rank = rank.withColumn("rank", F.row_number().over(Window.orderBy("path")))  # a row a file
    lines = whole.join(rank, "path").select("rank", F.posexplode("lines").alias("at", "value"))
    rows = lines.select((F.col("rank").cast("bigint") * (1 << 32) + F.col("at")).alias("line_no"), F.from_json("value", MANIFEST).alias("m")).where("m.type is not null and m.segment_id is not null")
    return rows.select("line_no", "m.type", "m.segment_id", F.col("m.segment_clock_ms").alias("clock_ms"), "m.duration_ms", "m.shard_id", "m.file")


def recover(spark: SparkSession, path: str) -> DataFrame:
    return committed(read_log(spark, path))


def log_lines(segments: DataFrame) -> DataFrame:
    """prepare and commit lines (column value) of written segments, and spill lines of spilled ones."""
    prepare = segments.where("outcome = 'written'").select("segment_id", F.lit(0).alias("k"), F.to_json(F.struct(F.lit("prepare").alias("type"), "segment_id", F.col("clock_ms").alias("segment_clock_ms"), "duration_ms", "shard_id", "file")).alias("value"))
    commit = segments.where("outcome = 'written'").select("segment_id", F.lit(1).alias("k"), F.to_json(F.struct(F.lit("commit").alias("type"), "segment_id")).alias("value"))
    spill = segments.where("outcome = 'spilled'").select("segment_id", F.lit(0).alias("k"), F.to_json(F.struct(F.lit("spill").alias("type"), "segment_id", "shard_id")).alias("value"))
    return prepare.unionByName(commit).unionByName(spill)
