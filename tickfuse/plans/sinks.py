"""Output: singles by input clock, coincidences by kind, size-bounded files, shards with a manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import folds, manifest
from ..schemas import AlignerConfig, StorageConfig
from ..sources.manifests import log_lines

# Bytes that a row counts for when files are rolled.
SINGLE_BYTES, LISTMODE_BYTES, PACKET_EXTRA = 16, 16, 32


def output_prefix(base: str, clock: Column, run_ms: int | None = None) -> Column:
    parts = [F.lit(base), F.lit("_"), clock.cast("string")]
    return F.concat(*parts, *([F.lit(f"_{run_ms}")] if run_ms else []))


def file_name(prefix: Column, seq: Column, ext: str, most: int) -> Column:
    """prefix_0000.ext; without a size limit there is one file and no number."""
    return F.concat(prefix, F.lit(f".{ext}")) if most <= 0 else F.concat(prefix, F.lit("_"), F.lpad(seq.cast("string"), 4, "0"), F.lit(f".{ext}"))


def write_singles(singles: DataFrame, path: str, by: str = "input_clock", overwrite: bool = False) -> None:
    """Sorted by time inside files, a folder per input clock."""
    singles.repartition(by).sortWithinPartitions(by, "time_100fs").write.mode("overwrite" if overwrite else "error").partitionBy(by).parquet(path)


def write_coincidences(pairs: DataFrame, path: str, config: AlignerConfig, overwrite: bool = False) -> None:
    """Prompt and delayed pairs in folders of their own, each if the configuration saves it."""
    kinds = [k for k, on in (("prompt", config.save_prompt), ("delay", config.save_delay)) if on]
    per = config.listmode_max_file_size_bytes // LISTMODE_BYTES
    w = pairs.where(F.col("kind").isin(kinds)).write.mode("overwrite" if overwrite else "error").partitionBy("kind")
    (w.option("maxRecordsPerFile", per) if per else w).parquet(path)


def export_payload(singles: DataFrame, path: str) -> None:
    singles.select("channel", "crystal", "time_100fs", "energy").write.parquet(path)


def shard_segments(segments: DataFrame, config: StorageConfig, order: str, first_channel: str, full: str) -> DataFrame:
    """Segments with shard, outcome and file: rolled by size within each shard."""
    n = max(1, len(config.output_roots))
    s = manifest.assign_shards(segments, n, config.shard_strategy, order, first_channel)
    s = manifest.queue_outcomes(s, full, config.use_spill_to_disk, config.fail_on_queue_full)
    s = folds.rolling_files(s, ["shard_id"], [order], "bytes", config.max_file_size_mb << 20)
    return s.withColumn("file", file_name(F.concat(F.lit("shard_"), F.col("shard_id").cast("string")), F.col("file_seq"), "raw", config.max_file_size_mb))


def write_manifest(segments: DataFrame, path: str) -> None:
    log_lines(segments).sortWithinPartitions("segment_id", "k").select("value").write.text(path)


def raw_output(config: StorageConfig) -> str:
    """Which writer a configuration asks for."""
    return "sharded" if config.sharded else "rolling"
