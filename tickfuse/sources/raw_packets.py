"""A data source for raw packet files.

Layout, little-endian: magic; then segments of a head (clock_ms u64, duration_ms u64, packets u32, bytes u64), channels
u16[], lengths u16[], offsets u64[] and data; then the segments' places u64[], their number u32, the channel count u16
and the magic again. Readers take the footer first, so a range of segments is a partition of its own.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..schemas import PACKET
from .listing import PREFIX

MAGIC, HEAD, FOOT = b"TFPACK01", struct.Struct("<QQIQ"), struct.Struct("<IH8s")


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("/") or uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def block(segment: dict) -> bytes:
    """One segment: clock_ms, duration_ms, packets as (channel, payload) pairs; offsets are made from the lengths."""
    channel = np.array([c for c, _ in segment["packets"]], "<u2")
    length = np.array([len(p) for _, p in segment["packets"]], "<u2")
    data = b"".join(p for _, p in segment["packets"])
    offset = (np.cumsum(length, dtype=np.uint64) - length).astype("<u8")
    return HEAD.pack(segment["clock_ms"], segment["duration_ms"], len(channel), len(data)) + channel.tobytes() + length.tobytes() + offset.tobytes() + data


def ending(places: list[int], channel_num: int) -> bytes:
    return np.array(places, "<u8").tobytes() + FOOT.pack(len(places), channel_num, MAGIC)


def footer(f: pa.NativeFile) -> tuple[np.ndarray, int]:
    size = f.size()
    count, channels, magic = FOOT.unpack(f.read_at(FOOT.size, size - FOOT.size))
    if magic != MAGIC:
        raise ValueError("not a raw packet file")
    return np.frombuffer(f.read_at(8 * count, size - FOOT.size - 8 * count), "<u8"), channels


def segment(f: pa.NativeFile, at: int) -> dict:
    clock, duration, n, size = HEAD.unpack(f.read_at(HEAD.size, at))
    body = f.read_at(12 * n + size, at + HEAD.size)
    return {"clock_ms": clock, "duration_ms": duration, "channel": np.frombuffer(body, "<u2", n), "length": np.frombuffer(body, "<u2", n, 2 * n), "offset": np.frombuffer(body, "<u8", n, 4 * n), "data": body[12 * n :]}


class Range(InputPartition):
    def __init__(self, path: str, first: int, last: int):
        super().__init__((path, first, last))
        self.path, self.first, self.last = path, first, last


class RawPacketReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.each = options["path"], int(options.get("segmentsperpartition", 16))

    def partitions(self) -> list[Range]:
        fs, root = open_fs(self.path)
        info = fs.get_file_info(root)
        paths = [root] if info.is_file else sorted(x.path for x in fs.get_file_info(pafs.FileSelector(root)) if x.is_file)
        out = []
        for p in paths:
            with fs.open_input_file(p) as f:
                n = len(footer(f)[0])
            out += [Range(p, a, min(n, a + self.each)) for a in range(0, n, self.each)]
        return out

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(self.path)
        with fs.open_input_file(part.path) as f:
            places, _ = footer(f)
            for i in range(part.first, part.last):
                s = segment(f, int(places[i]))
                n = len(s["channel"])
                payload = [s["data"][int(o) : int(o) + int(k)] for o, k in zip(s["offset"], s["length"], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.path] * n, pa.string()), pa.array([i] * n, pa.int64()), pa.array(np.arange(n), pa.int64()), pa.array(s["channel"].astype(np.int32)), pa.array(s["length"].astype(np.int32)), pa.array(s["offset"].astype(np.int64)), pa.array(payload, pa.binary()), pa.array([s["clock_ms"]] * n, pa.int64()), pa.array([s["duration_ms"]] * n, pa.int64())],
                    names=PACKET.fieldNames(),
                )


class RawPacketSource(DataSource):
    """spark.read.format("rawpackets").load(path)"""

    @classmethod
    def name(cls) -> str:
        return "rawpackets"

    def schema(self):
        return PACKET

    def reader(self, schema) -> RawPacketReader:
        return RawPacketReader(self.options)


def read(spark: SparkSession, path: str, segments_per_partition: int = 16) -> DataFrame:
    spark.dataSource.register(RawPacketSource)
    return spark.read.format("rawpackets").option("segmentsPerPartition", segments_per_partition).load(path)


def write(packets: DataFrame, folder: str, channel_num: int, prefix: str = PREFIX) -> DataFrame:
    """One file per input clock, prefix<clock>.bin, written where the clock's packets are; returns path and segments.
    A task holds one segment at a time. A file is complete once it has its name."""

    def run(batches) -> Iterator:
        import pandas as pd

        fs, root = open_fs(folder)
        fs.create_dir(root, recursive=True)
        out, clock, at, places, done = None, None, 0, [], []
        now: dict | None = None

        def put() -> None:
            nonlocal at
            places.append(at)
            data = block(now)
            out.write(data)
            at += len(data)

        def close() -> None:
            out.write(ending(places, channel_num))
            out.close()
            path = f"{root}/{prefix}{clock}.bin"
            fs.move(path + ".part", path)
            done.append((path, len(places)))

        for b in batches:
            for r in b.itertuples(index=False):
                if now is None or (r.clock_ms, r.segment_id) != (clock, now["segment_id"]):
                    if now is not None:
                        put()
                    if r.clock_ms != clock:
                        if out is not None:
                            close()
                        clock, places = r.clock_ms, []
                        out = fs.open_output_stream(f"{root}/{prefix}{clock}.bin.part", compression=None)
                        out.write(MAGIC)
                        at = len(MAGIC)
                    now = {"segment_id": r.segment_id, "clock_ms": r.clock_ms, "duration_ms": r.duration_ms, "packets": []}
                now["packets"].append((r.channel, r.payload))
        if now is not None:
            put()
            close()
        yield pd.DataFrame(done, columns=["path", "segments"])

    dealt = packets.repartition("clock_ms").sortWithinPartitions("clock_ms", "segment_id", "packet_idx")
    return dealt.select("clock_ms", "duration_ms", "segment_id", "channel", "payload").mapInPandas(run, "path string, segments int")


def file_info(packets: DataFrame) -> DataFrame:
    """By file: segments, packets, greatest channel."""
    from pyspark.sql import functions as F

    return packets.groupBy("file").agg(F.count_distinct("segment_id").alias("segment_num"), F.count(F.lit(1)).alias("packets"), F.max("channel").alias("max_channel"))
