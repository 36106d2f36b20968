"""Row filters and the checks that go with them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def energy_window(df: DataFrame, low: float, high: float, energy: str = "energy") -> DataFrame:
    """Rows within [low, high]; NaN and null go. high below low switches the cut off."""
    return df if high < low else df.where(F.col(energy).between(low, high))


def effective_window(df: DataFrame, low: float, high: float, energy: str = "energy") -> tuple[float, float]:
    """The window, or a thousandth of it where only that holds any row (values in keV under a window in eV)."""
    n = df.agg(F.count_if(F.col(energy).between(low, high)).alias("ev"), F.count_if(F.col(energy).between(low / 1000, high / 1000)).alias("kev")).first()
    return (low / 1000, high / 1000) if not n["ev"] and n["kev"] else (low, high)


def packet_length(df: DataFrame, least: int, most: int, length: str = "length") -> DataFrame:
    return df.where(F.col(length).between(least, most))


def assigned_channels(packets: DataFrame, channels: DataFrame, channel: str = "channel") -> DataFrame:
    """Packets whose channel is in `channels` (column channel); Spark broadcasts that side where its size is small."""
    return packets.join(channels.select(F.col("channel").alias(channel)).distinct(), channel, "left_semi")


def extract_channels(packets: DataFrame, wanted: list[int]) -> DataFrame:
    """Packets of these channels with offsets counted anew by segment; segments without any are gone."""
    from .sequence import exclusive_sum

    return exclusive_sum(packets.where(F.col("channel").isin(wanted)), "length", ["segment_id"], ["packet_idx"], "new_offset")


def nonempty_segments(df: DataFrame, count: str = "count") -> DataFrame:
    return df.where(F.col(count) > 0)


def unknown_channels(wanted: DataFrame, known: DataFrame, channel: str = "channel") -> DataFrame:
    """Channels that `known` lacks (no such channel, no calibration); empty if all is well."""
    return wanted.select(channel).distinct().join(known.select(channel).distinct(), channel, "left_anti")


def require_channels(wanted: DataFrame, known: DataFrame, channel: str = "channel") -> DataFrame:
    bad = [r[0] for r in unknown_channels(wanted, known, channel).limit(10).collect()]
    if bad:
        raise ValueError(f"channels without calibration or out of range: {bad}")
    return wanted


def replay_filter(packets: DataFrame, first: int, count: int, channel: str = "channel", repeat: int = 1, segments: int | None = None, segment: str = "segment_id") -> tuple[DataFrame, DataFrame]:
    """Packets of `count` channels from `first`, renumbered from 0, of segments below `segments` and `repeat` times over (column
    round, if more than once); and one row with sent and skipped counts."""
    on = F.col(channel).between(first, first + count - 1)
    if segments is not None:
        packets = packets.where(F.col(segment) < segments)
    if repeat != 1:
        packets = packets.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(repeat - 1))))
    kept = packets.where(on).withColumn(channel, F.col(channel) - first)
    return kept, packets.agg(F.count_if(on).alias("sent"), F.count_if(~on).alias("skipped"))


def slice_in_bounds(chunks: DataFrame, offset: str, count: str, total: str) -> DataFrame:
    """chunks, raising where a slice reaches beyond its message."""
    return chunks.where(F.when(F.col(offset) + F.col(count) <= F.col(total), F.lit(True)).otherwise(F.raise_error(F.lit("INVALID_ARGUMENT: slice beyond the message")).cast("boolean")))


def header_faults(info: DataFrame, channels: int) -> DataFrame:
    """File headers that don't fit: another channel count, no segment, or a channel out of range."""
    return info.where((F.col("channel_num") != channels) | (F.col("segment_num") < 1) | (F.col("max_channel") >= F.col("channel_num")))


def check_capacity(sources: int, aligner_channels: int) -> None:
    if not 1 <= sources <= aligner_channels:
        raise ValueError(f"{sources} detector sources for {aligner_channels} aligner channels")
