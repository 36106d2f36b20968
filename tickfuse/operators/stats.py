"""Aggregates over singles, chunks, files and nodes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def chunk_ranges(singles: DataFrame, by: list[str], t: str = "t") -> DataFrame:
    return singles.groupBy(*by).agg(F.min(t).alias("min_t"), F.max(t).alias("max_t"), F.count(F.lit(1)).alias("n"))


def node_watermark(singles: DataFrame, node: str, t: str, margin: int, nodes: int) -> DataFrame:
    """One row: the least of the nodes' latest times less the margin; 0 until every node has data, and never below."""
    per = singles.groupBy(node).agg(F.max(t).alias("last"))
    w = F.when((F.count(F.lit(1)) < nodes) | (F.min("last") <= margin), F.lit(0)).otherwise(F.min("last") - margin)
    return per.agg(F.count(F.lit(1)).alias("nodes"), F.coalesce(w, F.lit(0)).cast("bigint").alias("watermark"))


def energy_stats(singles: DataFrame, low: float, high: float, energy: str = "energy") -> DataFrame:
    e = F.col(energy)
    inside = e.between(low, high)
    return singles.agg(F.count(F.lit(1)).alias("total"), F.count_if(inside).alias("in_ev"), F.count_if(e.between(low / 1000, high / 1000)).alias("in_kev"), F.min(e).alias("min_energy"), F.max(e).alias("max_energy"), (F.count_if(inside) / F.count(F.lit(1))).alias("ratio"))


def sampled_energy(singles: DataFrame, by: str, order: str, most: int = 20_000, energy: str = "energy") -> DataFrame:
    """Over the first `most` rows of each callback: mean, least and greatest finite energy, and how many aren't finite."""
    first = singles.withColumn("__r", F.row_number().over(Window.partitionBy(by).orderBy(order))).where(F.col("__r") <= most)
    e = F.col(energy)
    finite = ~F.isnan(e) & (F.abs(e) != float("inf"))
    return first.groupBy(by).agg(F.avg(F.when(finite, e)).alias("mean"), F.min(F.when(finite, e)).alias("least"), F.max(F.when(finite, e)).alias("greatest"), F.count_if(~finite).alias("non_finite"))


def file_info(segments: DataFrame, by: str, start: str = "start_ms", duration: str = "duration_ms", order: str = "segment_index") -> DataFrame:
    """By file: segments, summed duration, first and last clock, and the span from first to last with its duration."""
    place = F.struct(start, order)
    return segments.groupBy(by).agg(F.count(F.lit(1)).alias("segments"), F.sum(duration).cast("bigint").alias("duration_ms"), F.min(start).alias("first_clock"), F.max(start).alias("last_clock"), (F.max(start) - F.min(start) + F.max_by(duration, place)).alias("span_ms"))


def inventory(segments: DataFrame, start: str = "start_ms", duration: str = "duration_ms") -> DataFrame:
    """One row: first start, last end, segments, summed duration."""
    return segments.agg(F.min(start).alias("first_ms"), F.max(F.col(start) + F.col(duration)).alias("last_ms"), F.count(F.lit(1)).alias("segments"), F.sum(duration).cast("bigint").alias("total_ms"))


def multiset(df: DataFrame) -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows with their surplus in a (positive) or b (negative); empty if both hold the same rows equally often."""
    both = a.withColumn("__s", F.lit(1)).unionByName(b.withColumn("__s", F.lit(-1)))
    return both.groupBy(*a.columns).agg(F.sum("__s").cast("bigint").alias("surplus")).where("surplus <> 0")


# Start and multiplier of the mix.
MIX_START, MIX_PRIME = 1469598103934665603, 1099511628211


def digest(singles: DataFrame, fields: tuple[str, ...] = ("channel", "crystal", "time_100fs", "energy")) -> DataFrame:
    """One row, whatever the order of the input: rows, and the xor of a 64-bit mix of each row's fields (the last one
    by its float32 bits). Products wrap, which SQL arithmetic doesn't, so tasks mix whole Arrow columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, x = 0, np.uint64(0)
        for b in batches:
            h = np.full(b.num_rows, MIX_START, np.uint64)
            for i, c in enumerate(b.columns):
                v = c.to_numpy(zero_copy_only=False)
                v = v.astype(np.float32).view(np.uint32).astype(np.uint64) if i + 1 == len(b.columns) else v.astype(np.int64).view(np.uint64)
                h = (h ^ v) * np.uint64(MIX_PRIME)
            n, x = n + b.num_rows, x ^ (np.bitwise_xor.reduce(h) if len(h) else np.uint64(0))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array(np.array([x]).view(np.int64))], ["n", "x"])

    parts = singles.select(*fields).mapInArrow(run, "n bigint, x bigint")
    return parts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"), F.coalesce(F.bit_xor("x"), F.lit(0)).alias("checksum"))


def status_rollup(singles: DataFrame, node: str, chunk: str) -> DataFrame:
    """Chunks and singles by node, and the totals in a row with a null node."""
    return singles.groupBy(node, chunk).agg(F.count(F.lit(1)).alias("__n")).rollup(node).agg(F.count(F.lit(1)).alias("chunks"), F.sum("__n").cast("bigint").alias("singles"))


def loss_report(sent: DataFrame, got: DataFrame) -> DataFrame:
    """Packet loss of one relation against another: counts, loss ratio and whether digests agree (columns total, checksum)."""
    return sent.select(F.col("total").alias("sent"), F.col("checksum").alias("__a")).crossJoin(got.select(F.col("total").alias("got"), F.col("checksum").alias("__b"))).select("sent", "got", F.when(F.col("sent") > 0, F.abs(F.col("sent") - F.col("got")) / F.col("sent")).otherwise(F.lit(0.0)).alias("loss"), (F.col("__a") == F.col("__b")).alias("same"))


def extraction_ratio(df: DataFrame, kept: Column) -> DataFrame:
    return df.agg(F.count_if(kept).alias("kept"), F.count_if(~kept).alias("skipped"), (F.count_if(kept) / F.count(F.lit(1))).alias("ratio"))
