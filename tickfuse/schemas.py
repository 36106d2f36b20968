"""Row types, detector dimension, parameter records."""

from __future__ import annotations

import dataclasses
import json
import os
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Times are integers in 100 fs units everywhere; a TimestampType (1 us) is made only to watermark on.
TICKS_PER_US = 10_000_000

SINGLE = T.StructType([T.StructField("channel", T.IntegerType()), T.StructField("crystal", T.IntegerType()), T.StructField("time_100fs", T.LongType()), T.StructField("energy", T.FloatType())])
COINCIDENCE = T.StructType([T.StructField(c, T.IntegerType()) for c in ("channel1", "crystal1", "channel2", "crystal2", "dt_100fs")] + [T.StructField("timestamp_100us", T.LongType())])
PACKET = T.StructType([T.StructField("file", T.StringType()), T.StructField("segment_id", T.LongType()), T.StructField("packet_idx", T.LongType()), T.StructField("channel", T.IntegerType()), T.StructField("length", T.IntegerType()), T.StructField("offset", T.LongType()), T.StructField("payload", T.BinaryType()), T.StructField("clock_ms", T.LongType()), T.StructField("duration_ms", T.LongType())])
CHUNK = T.StructType([T.StructField("node_id", T.IntegerType()), T.StructField("chunk_id", T.LongType()), T.StructField("clock_ms", T.LongType()), T.StructField("duration_ms", T.LongType()), T.StructField("singles", T.ArrayType(SINGLE))])
MANIFEST = T.StructType([T.StructField("type", T.StringType()), T.StructField("segment_id", T.LongType()), T.StructField("segment_clock_ms", T.LongType()), T.StructField("duration_ms", T.LongType()), T.StructField("shard_id", T.IntegerType()), T.StructField("file", T.StringType())])

# Detector geometries (name, channels, crystals per channel, channels per ring).
DETECTORS = [("BDM2", 48, 676, 48), ("BDM50100", 144, 288, 144), ("9120", 576, 288, 144)]


def detectors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DETECTORS, "detector string, channel_num int, crystals_per_channel int, channels_per_ring int")


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """df, or an error that names what is missing (the check a file header gets)."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}; there are: {', '.join(df.columns)}")
    return df


@dataclass(frozen=True)
class CoincidenceProtocol:
    window_ps: int = 2000
    delay_ps: int = 2_000_000
    energy_lower_ev: float = 350_000.0
    energy_upper_ev: float = 650_000.0

    @property
    def window(self) -> int:
        return self.window_ps * 10

    @property
    def delay(self) -> int:
        return self.delay_ps * 10


@dataclass(frozen=True)
class AlignerConfig:
    network_latency_margin_ps: int = 5_000_000_000
    protocol: CoincidenceProtocol = field(default_factory=CoincidenceProtocol)
    channel_num: int = 48
    crystals_per_channel: int = 676
    output_dir: str = ""
    save_prompt: bool = True
    save_delay: bool = True
    listmode_max_file_size_bytes: int = 0
    max_chunks_per_node: int = 100
    processing_interval_ms: int = 200

    @property
    def safety_margin(self) -> int:
        """In 100 fs: network latency and the longer of window and delay."""
        return (self.network_latency_margin_ps + max(self.protocol.window_ps, self.protocol.delay_ps)) * 10


ALIGNER_PRESETS = {
    "BDM2": AlignerConfig(channel_num=48, crystals_per_channel=676),
    "9120": AlignerConfig(channel_num=576, crystals_per_channel=288, max_chunks_per_node=1000, processing_interval_ms=100),
}


@dataclass(frozen=True)
class R2SConfig:
    rawdata_path: str = ""
    result_path: str = ""
    detector_type: str = "BDM2"
    crystals_per_channel: int = 676
    output_file_name: str = "singles"
    channel_indices: tuple[int, ...] = ()
    sort_by_time: bool = True
    save_file: bool = True
    singles_max_file_size_bytes: int = 0
    use_energy_cut: bool = False
    energy_cut_low: float = 0.0
    energy_cut_high: float = 0.0
    time_window: int = 25
    time_shift: int = 25
    cross_talk_enabled: bool = False

    @property
    def energy_cut(self) -> tuple[float, float] | None:
        """None where the cut is off, or where the upper bound is below the lower."""
        return (self.energy_cut_low, self.energy_cut_high) if self.use_energy_cut and self.energy_cut_high >= self.energy_cut_low else None


@dataclass(frozen=True)
class StorageConfig:
    output_root: str = ""
    output_roots: tuple[str, ...] = ()
    session_name: str = ""
    max_file_size_mb: int = 512
    overwrite: bool = False
    shard_strategy: str = "RoundRobin"
    use_spill_to_disk: bool = False
    fail_on_queue_full: bool = True
    manifest_filename: str = "manifest.ndjson"

    @property
    def sharded(self) -> bool:
        return bool(self.output_roots)


def load_config(kind: type, source: str | dict):
    """A record from JSON with typed checks; nested records too. Unknown keys and wrong types are errors that name the key."""
    raw = json.loads(Path(source).read_text()) if isinstance(source, str) else source
    known = {f.name: f for f in dataclasses.fields(kind)}
    out = {}
    for k, v in raw.items():
        if k not in known:
            raise ValueError(f"{kind.__name__}: unknown field {k}")
        default = known[k].default if known[k].default is not dataclasses.MISSING else known[k].default_factory()
        if dataclasses.is_dataclass(default):
            out[k] = load_config(type(default), v)
        elif isinstance(default, tuple):
            if not isinstance(v, list):
                raise ValueError(f"{kind.__name__}.{k}: a list is needed, not {v!r}")
            out[k] = tuple(v)
        elif isinstance(default, bool) != isinstance(v, bool) or not isinstance(v, (int, float) if isinstance(default, float) else type(default)):
            raise ValueError(f"{kind.__name__}.{k}: {type(default).__name__} is needed, not {v!r}")
        elif isinstance(default, int) and not isinstance(default, bool) and v < 0:
            raise ValueError(f"{kind.__name__}.{k}: below zero: {v}")
        else:
            out[k] = v
    return kind(**out)


def with_environment(config: StorageConfig, prefix: str = "TICKFUSE_RAW_") -> StorageConfig:
    """Environment variables named prefix + field override fields; lists are split on comma or semicolon."""
    found = {}
    for f in dataclasses.fields(config):
        if (v := os.environ.get(prefix + f.name.upper())) is not None:
            now = getattr(config, f.name)
            if isinstance(now, tuple):
                found[f.name] = tuple(x for x in v.replace(";", ",").split(",") if x)
            else:
                found[f.name] = v.lower() in ("1", "true", "yes", "on") if isinstance(now, bool) else int(v) if isinstance(now, int) else v
    return dataclasses.replace(config, **found)
