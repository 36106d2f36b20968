"""Live packets: datagrams of a UDP port as a stream, and a folder of packet files as a sink and a source of streams."""

from __future__ import annotations

import json
import os
import socket
import struct
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, DataSourceStreamWriter, InputPartition, SimpleDataSourceStreamReader, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from .raw_packets import open_fs

DATAGRAM = "n bigint, source string, received_us bigint, payload binary"
_HEAD = struct.Struct("<qHHI")  # received_us, length of the address, port, length of the payload

# Milliseconds that an idle receiver waits, at least and at most.
IDLE_MS = (15, 100)


class UdpReader(SimpleDataSourceStreamReader):
    """Datagrams are appended to a spool file as they are taken, so that a micro-batch that is run again, or a restart, reads
    the same. The offset is the spool's length."""

    def __init__(self, options: dict):
        self.port, self.host = int(options["port"]), options.get("host", "127.0.0.1")
        self.spool, self.most = options["spool"], int(options.get("packetsperbatch", 10_000))
        self.patience = int(options.get("patiencems", IDLE_MS[1])) / 1000
        self.socket: socket.socket | None = None

    def initialOffset(self) -> dict:
        return {"at": 0, "n": 0}

    def _receive(self) -> None:
        """Takes what is there, up to `most`; an idle wait grows up to its limit, and ends the batch then."""
        if self.socket is None:
            self.socket = socket.socket(socket.AF_INET, socket.SOCK_DGRAM)
            self.socket.setsockopt(socket.SOL_SOCKET, socket.SO_RCVBUF, 8 << 20)
            self.socket.bind((self.host, self.port))
            self.socket.setblocking(False)
        idle, end, taken = IDLE_MS[0] / 1000, time.monotonic() + self.patience, 0
        with open(self.spool, "ab") as f:
            while taken < self.most and time.monotonic() < end:
                try:
                    data, (host, port) = self.socket.recvfrom(65535)
                except BlockingIOError:
                    time.sleep(idle)
                    idle = min(2 * idle, IDLE_MS[1] / 1000)
                    continue
                name = host.encode()
                f.write(_HEAD.pack(time.time_ns() // 1000, len(name), port, len(data)) + name + data)
                taken, idle = taken + 1, IDLE_MS[0] / 1000

    def _rows(self, start: dict, end: int | None) -> tuple[list[tuple], dict]:
        rows, at, n = [], start["at"], start["n"]
        if os.path.exists(self.spool):
            with open(self.spool, "rb") as f:
                f.seek(at)
                while (end is None or at < end) and len(head := f.read(_HEAD.size)) == _HEAD.size:
                    received, size, port, length = _HEAD.unpack(head)
                    body = f.read(size + length)
                    if len(body) < size + length:
                        break  # cut off by a crash; the next datagram is appended after what is whole
                    rows.append((n, f"{body[:size].decode()}:{port}", received, body[size:]))
                    at, n = at + _HEAD.size + size + length, n + 1
        return rows, {"at": at, "n": n}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        _, whole = self._rows(start, None)
        if os.path.exists(self.spool) and os.path.getsize(self.spool) > whole["at"]:
            os.truncate(self.spool, whole["at"])
        self._receive()
        rows, end = self._rows(start, None)
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter(self._rows(start, end["at"])[0])

    def commit(self, end: dict) -> None:
        """What is committed stays in the spool: it is the record of the run."""


class UdpSource(DataSource):
    """spark.readStream.format("udppackets").option("port", ...).option("spool", file).load()"""

    @classmethod
    def name(cls) -> str:
        return "udppackets"

    def schema(self) -> str:
        return DATAGRAM

    def simpleStreamReader(self, schema) -> UdpReader:
        return UdpReader(self.options)


@dataclass
class Written(WriterCommitMessage):
    path: str | None
    rows: int


class FeedWriter(DataSourceStreamWriter):
    """Each task writes one file; a micro-batch is there once its list of files is. A micro-batch that is run again replaces
    its list, so files of an attempt that failed are never read."""

    def __init__(self, schema, options: dict):
        self.columns, self.folder = schema.fieldNames(), options["path"]

    def write(self, rows: Iterator) -> Written:
        fs, root = open_fs(self.folder)
        held = [tuple(r) for r in rows]
        if not held:
            return Written(None, 0)
        fs.create_dir(f"{root}/data", recursive=True)
        name = f"{uuid.uuid4().hex}.parquet"
        pq.write_table(pa.table({c: [r[i] for r in held] for i, c in enumerate(self.columns)}), f"{root}/data/{name}", filesystem=fs)
        return Written(name, len(held))

    def commit(self, messages: list, batchId: int) -> None:
        fs, root = open_fs(self.folder)
        fs.create_dir(f"{root}/batches", recursive=True)
        files = sorted((m.path, m.rows) for m in messages if m is not None and m.path)
        with fs.open_output_stream(f"{root}/batches/{batchId}.part", compression=None) as out:
            out.write(json.dumps(files).encode())
        fs.move(f"{root}/batches/{batchId}.part", f"{root}/batches/{batchId}.json")

    def abort(self, messages: list, batchId: int) -> None:
        fs, root = open_fs(self.folder)
        for m in messages:
            if m is not None and m.path:
                fs.delete_file(f"{root}/data/{m.path}")


class Files(InputPartition):
    def __init__(self, name: str):
        super().__init__(name)
        self.name = name


class FeedReader(DataSourceStreamReader):
    """The micro-batches that a feed's folder lists, from the first on; the offset is how many were read."""

    def __init__(self, options: dict):
        self.folder, self.most = options["path"], int(options.get("batchespertrigger", 1 << 30))
        self.done = 0

    def _listed(self) -> list[int]:
        fs, root = open_fs(self.folder)
        found = fs.get_file_info(pafs.FileSelector(f"{root}/batches", allow_not_found=True))
        return sorted(int(f.base_name[:-5]) for f in found if f.base_name.endswith(".json"))

    def initialOffset(self) -> dict:
        return {"done": 0}

    def latestOffset(self) -> dict:
        self.done = min(len(self._listed()), self.done + self.most)
        return {"done": self.done}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        fs, root = open_fs(self.folder)
        self.done = max(self.done, end["done"])
        out = []
        for n in self._listed()[start["done"] : end["done"]]:
            with fs.open_input_stream(f"{root}/batches/{n}.json", compression=None) as f:
                out += [Files(name) for name, _ in json.loads(f.read())]
        return out

    def read(self, part: Files) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(self.folder)
        yield from pq.read_table(f"{root}/data/{part.name}", filesystem=fs).to_batches()


class FeedSource(DataSource):
    """format("packetfeed").option("path", folder), for readStream (with a schema) and writeStream."""

    @classmethod
    def name(cls) -> str:
        return "packetfeed"

    def schema(self) -> str:
        return DATAGRAM

    def streamReader(self, schema) -> FeedReader:
        return FeedReader(self.options)

    def streamWriter(self, schema, overwrite: bool) -> FeedWriter:
        return FeedWriter(schema, self.options)


def udp_stream(spark: SparkSession, port: int, spool: str, host: str = "127.0.0.1", packets_per_batch: int = 10_000) -> DataFrame:
    """Datagrams of a port: n, source, received_us, payload. The socket is the driver's; spool is a file of its machine."""
    spark.dataSource.register(UdpSource)
    return spark.readStream.format("udppackets").option("port", port).option("host", host).option("spool", spool).option("packetsPerBatch", packets_per_batch).load()


def read_feed(spark: SparkSession, folder: str, schema: str = DATAGRAM, batches_per_trigger: int = 1 << 30) -> DataFrame:
    spark.dataSource.register(FeedSource)
    return spark.readStream.format("packetfeed").schema(schema).option("path", folder).option("batchesPerTrigger", batches_per_trigger).load()


def write_feed(stream: DataFrame, folder: str, checkpoint: str, every_ms: int = 200) -> StreamingQuery:
    """Each row of the stream once, in folder, whatever is run again."""
    stream.sparkSession.dataSource.register(FeedSource)
    return stream.writeStream.format("packetfeed").option("path", folder).option("checkpointLocation", checkpoint).trigger(processingTime=f"{every_ms} milliseconds").start()
