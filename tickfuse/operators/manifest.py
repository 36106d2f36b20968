"""Sharded output and its manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequence import global_number


def assign_shards(segments: DataFrame, shards: int, strategy: str, order: str, first_channel: str, width: int = 100_000) -> DataFrame:
    """shard_id: round robin in the order of a distinct integer column, or by the first packet's channel.
    FreeSpaceAware has no other rule than round robin."""
    if strategy == "HashByChannel":
        return segments.withColumn("shard_id", F.pmod(F.col(first_channel), F.lit(shards)).cast("int"))
    return global_number(segments, order, width, "__n").withColumn("shard_id", (F.col("__n") % shards).cast("int")).drop("__n")


def queue_outcomes(segments: DataFrame, full: str, spill: bool, fail_on_full: bool) -> DataFrame:
    """What becomes of a segment: written; where its queue is full, spilled (a marker only), blocked till there is room, or dropped."""
    at_full = F.lit("spilled" if spill else "blocked" if fail_on_full else "dropped")
    return segments.withColumn("outcome", F.when(F.col(full), at_full).otherwise(F.lit("written")))


def committed(log: DataFrame) -> DataFrame:
    """Segments that were prepared and then committed, by clock and id. log: line_no, type, segment_id, clock_ms,
    duration_ms, shard_id, file. The last prepare of an id counts, and only commits after it."""
    prepared = log.where("type = 'prepare'").groupBy("segment_id").agg(F.max_by(F.struct("line_no", "clock_ms", "duration_ms", "shard_id", "file"), "line_no").alias("p"))
    done = log.where("type = 'commit'").groupBy("segment_id").agg(F.max("line_no").alias("done"))
    return prepared.join(done, "segment_id").where("done > p.line_no").select("segment_id", "p.clock_ms", "p.duration_ms", "p.shard_id", "p.file").orderBy("clock_ms", "segment_id")


def common_clocks(files: DataFrame, clock: str, directory: str, directories: int) -> DataFrame:
    """Clocks that every directory has."""
    return files.select(clock, directory).distinct().groupBy(clock).agg(F.count(F.lit(1)).alias("dirs")).where(F.col("dirs") == directories).select(clock)
