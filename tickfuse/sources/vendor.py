"""Vendor listmode and raw frame files: a 510-byte header, then fixed records."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codec

# Header length, magic, record layouts.
HEADER, MAGIC = 510, b"RRRRAAAAYYYYSSSS"
EVENT = np.dtype([("ip", "<u2"), ("ch", "<u2"), ("energy", "<f4"), ("time", "<f8")])
FRAME_BYTES = 1024
MOST_BYTES = (1 << 32) - 1


def header(data_bytes: int) -> bytes:
    """Magic, the header's own length, the data's length at its end; the rest is zero."""
    if data_bytes > MOST_BYTES:
        raise ValueError("listmode data above 4 GiB")
    head = bytearray(HEADER)
    head[:16] = MAGIC
    struct.pack_into("<I", head, 16, HEADER)
    struct.pack_into("<I", head, HEADER - 6, data_bytes)
    return bytes(head)


def _events(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in blocks:
        for path, data in zip(b["path"], b["content"], strict=True):
            if data[:16] != MAGIC or struct.unpack_from("<I", data, 16)[0] != HEADER:
                raise ValueError(f"{path}: not vendor listmode")
            pairs = (len(data) - HEADER) // (2 * EVENT.itemsize)  # records come in blocks of two
            e = np.frombuffer(data, EVENT, 2 * pairs, HEADER)
            yield pd.DataFrame({"file": path, "n": np.arange(len(e)), "ip": e["ip"].astype(np.int32), "ch": e["ch"].astype(np.int32), "vendor_energy": e["energy"], "vendor_time": e["time"]})


def read_listmode(spark: SparkSession, path: str) -> DataFrame:
    """file, n, ip, ch, vendor_energy, vendor_time of every event."""
    raw = spark.read.format("binaryFile").load(path).select("path", "content")
    return raw.mapInPandas(_events, "file string, n bigint, ip int, ch int, vendor_energy float, vendor_time double")


def listmode_singles(spark: SparkSession, path: str, **options: float) -> DataFrame:
    return codec.decode_event(read_listmode(spark, path), **options).select("file", "n", "channel", "crystal", "time_100fs", "energy")


def encode_events(events: pd.DataFrame) -> bytes:
    e = np.zeros(len(events), EVENT)
    for name, col in (("ip", "ip"), ("ch", "ch"), ("energy", "vendor_energy"), ("time", "vendor_time")):
        e[name] = events[col].to_numpy()
    return e.tobytes()


def write_listmode(singles: DataFrame, folder: str, by: str, order: list[str], **options: float) -> DataFrame:
    """One vendor file per value of `by`, written by the task that holds it, batch by batch: the header needs the number of
    events, which is counted first. Returns path and events."""
    from .raw_packets import open_fs

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = open_fs(folder)
        fs.create_dir(root, recursive=True)
        out, now, done = None, None, []

        def close() -> None:
            out.close()
            fs.move(f"{root}/{now}.lm.part", f"{root}/{now}.lm")

        for b in batches:
            for value, part in b.groupby(by, sort=False):
                if out is None or value != now:
                    if out is not None:
                        close()
                    now, n = value, int(part["__n"].iloc[0])
                    out = fs.open_output_stream(f"{root}/{now}.lm.part", compression=None)
                    out.write(header(n * EVENT.itemsize))
                    done.append((f"{root}/{now}.lm", n))
                out.write(encode_events(part))
        if out is not None:
            close()
        yield pd.DataFrame(done, columns=["path", "events"])

    cols = list(dict.fromkeys([by, *order, "ip", "ch", "vendor_energy", "vendor_time"]))
    events = codec.encode_event(singles, **options).select(cols)
    counts = events.groupBy(by).agg(F.count(F.lit(1)).alias("__n"))
    dealt = events.join(counts, by).repartition(by).sortWithinPartitions(by, *order)
    return dealt.mapInPandas(run, "path string, events bigint")


def _frames(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    kind = np.dtype([("payload", f"V{FRAME_BYTES}"), ("src", "<u2")])
    for b in blocks:
        for path, data in zip(b["path"], b["content"], strict=True):
            if (len(data) - HEADER) % kind.itemsize or len(data) < HEADER:
                raise ValueError(f"{path}: the size isn't a whole number of frames")
            f = np.frombuffer(data, kind, offset=HEADER)
            yield pd.DataFrame({"file": path, "packet_idx": np.arange(len(f)), "src_channel": f["src"].astype(np.int32), "payload": [x.tobytes() for x in f["payload"]]})


def read_frames(spark: SparkSession, path: str, ring_offset: int = 0) -> DataFrame:
    """Raw frames as packets: file, packet_idx, src_channel, channel, length, offset, payload. A ring offset that leaves
    the range gives a null channel."""
    raw = spark.read.format("binaryFile").load(path).select("path", "content")
    out = raw.mapInPandas(_frames, "file string, packet_idx bigint, src_channel int, payload binary")
    moved = codec.shift_ring(F.col("src_channel"), ring_offset)
    return out.withColumns({"channel": codec.src_to_detector(moved).cast("int"), "length": F.length("payload"), "offset": F.col("packet_idx") * FRAME_BYTES})
