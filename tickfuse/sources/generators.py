"""Deterministic test inputs."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def packets(spark: SparkSession, count: int, channels: int, offset: int = 0, size: int = 64) -> DataFrame:
    """Packets dealt round robin over channels; every byte of a payload is (channel + offset) & 0xFF."""
    ch = (F.col("id") % channels).cast("int")
    fill = F.lpad(F.hex((ch + offset).bitwiseAND(F.lit(0xFF))), 2, "0")
    return spark.range(count).select(F.col("id").alias("packet_idx"), ch.alias("channel"), F.lit(size).alias("length"), F.unhex(F.repeat(fill, size)).alias("payload"))


def singles(spark: SparkSession, count: int, start: int, span: int, channels: int, crystals: int, low: float = 350_000.0, high: float = 650_000.0, seed: int = 1) -> DataFrame:
    """Singles uniform in time, crystal and energy, from a hash of their number, so that runs agree."""
    u = lambda k: F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(k)), F.lit(1 << 40)) / float(1 << 40)
    return spark.range(count).select("id", F.floor(u(1) * channels).cast("int").alias("channel"), F.floor(u(2) * crystals).cast("int").alias("crystal"), (F.lit(start) + F.floor(u(3) * span)).cast("bigint").alias("time_100fs"), (low + u(4) * (high - low)).cast("float").alias("energy"))


def checksum(data: bytes) -> int:
    """The 16-bit one's complement sum of IPv4 and UDP headers."""
    words = np.frombuffer(data + b"\0" * (len(data) % 2), ">u2").sum(dtype=np.uint64)
    total = int(words)
    while total >> 16:
        total = (total & 0xFFFF) + (total >> 16)
    return ~total & 0xFFFF


def datagram(source: int, dest: int, source_port: int, dest_port: int, payload: bytes) -> bytes:
    """An IPv4 packet that carries a UDP datagram, with both checksums (a UDP sum of 0 is sent as 0xFFFF)."""
    size = 8 + len(payload)
    ip = struct.pack(">BBHHHBBHII", 0x45, 0, 20 + size, 0, 0, 64, 17, 0, source, dest)
    ip = ip[:10] + struct.pack(">H", checksum(ip)) + ip[12:]
    udp = struct.pack(">HHHH", source_port, dest_port, size, 0) + payload
    total = checksum(struct.pack(">IIBBH", source, dest, 0, 17, size) + udp)
    return ip + udp[:6] + struct.pack(">H", total or 0xFFFF) + payload


def frames(packets: DataFrame, source: int, dest: int, source_port: int, dest_port: int) -> DataFrame:
    """packets with a column frame; ports step by channel."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in packets.schema) + ", frame binary"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(frame=[datagram(source, dest, source_port + c, dest_port + c, bytes(p)) for c, p in zip(b["channel"], b["payload"], strict=True)])

    return packets.mapInPandas(run, schema)
