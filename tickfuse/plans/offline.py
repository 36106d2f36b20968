"""The offline pipelines: raw packets to singles, singles to coincidences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.decoders import DECODERS, SINGLES, Decoder
from ..operators import filters, folds, interval_join
from ..schemas import CoincidenceProtocol, R2SConfig

#: Decoders by detector type. Register one to add a detector.
GENERATORS: dict[str, Decoder] = dict(DECODERS)


def register_generator(detector: str, decode: Decoder) -> None:
    GENERATORS[detector] = decode


def raw_to_singles(packets: DataFrame, config: R2SConfig, wanted: DataFrame | None = None) -> DataFrame:
    """Channel filter, decode, energy cut, global channels kept throughout. The filter stands before the decoder, through
    which the optimiser can't push it; the decoder gets the configuration."""
    if config.detector_type not in GENERATORS:
        raise ValueError(f"no generator for detector {config.detector_type}; there are: {', '.join(sorted(GENERATORS))}")
    if wanted is not None:
        packets = filters.assigned_channels(packets, wanted)
    elif config.channel_indices:
        packets = packets.where(F.col("channel").isin(list(config.channel_indices)))
    singles = packets.mapInPandas(GENERATORS[config.detector_type](config), SINGLES)
    return filters.energy_window(singles, *config.energy_cut) if config.energy_cut else singles


def raw_files_to_singles(spark: SparkSession, folder: str, config: R2SConfig) -> DataFrame:
    """Every raw file of a folder, decoded, with the clock of its name as input_clock; one table, no loop over files."""
    from ..sources import listing, raw_packets

    packets = raw_packets.read(spark, folder)
    singles = raw_to_singles(packets, config)
    clocks = listing.raw_files(listing.files(spark, folder)).select(F.col("clock").alias("clock_ms"), F.col("clock").alias("input_clock"))
    return singles.join(clocks.distinct(), "clock_ms")


def merge_and_pair(singles: DataFrame, segments: DataFrame, protocol: CoincidenceProtocol, channels: int, mode: str = "corrected", tolerance_ms: int = 5) -> DataFrame:
    """Coincidences over merged node files. singles: id, file, segment_id, channel, crystal, time_100fs, energy;
    segments: file, segment_id, start_ms, end_ms. faithful keeps pairs within groups of segments that start within
    the tolerance of the group's first."""
    s = filters.energy_window(singles, protocol.energy_lower_ev, protocol.energy_upper_ev).withColumn("t", F.col("time_100fs"))
    if mode == "corrected":
        return interval_join.coincidences(s, protocol.window, protocol.delay, channels)
    seg = segments.withColumn("tie", F.xxhash64("file", "segment_id"))
    groups = folds.anchored_groups(seg, "start_ms", "end_ms", "tie", tolerance_ms, 1_000_000).select("group_start")
    width = tolerance_ms + 1  # a segment starts at most the tolerance after its group, so in its bin or the next
    near = groups.withColumn("bin", F.explode(F.array(F.floor(F.col("group_start") / width), F.floor(F.col("group_start") / width) + 1)))
    owned = seg.withColumn("bin", F.floor(F.col("start_ms") / width)).join(near, "bin").where(F.col("start_ms").between(F.col("group_start"), F.col("group_start") + tolerance_ms)).groupBy("file", "segment_id").agg(F.max("group_start").alias("group_start"))
    return interval_join.coincidences(s.join(owned, ["file", "segment_id"]), protocol.window, protocol.delay, channels, scope=["group_start"])
