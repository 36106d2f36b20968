"""Coincidences on live streams, one stream per node."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import interval_join, ordering, stats
from ..operators.ordering import merge_streams


def event_time(t: str, ticks_per_us: int) -> Column:
    """A timestamp of the integer time, only to watermark on."""
    return F.timestamp_micros(F.expr(f"{t} div {ticks_per_us}"))


def node_stream(spark: SparkSession, path: str, schema: str, margin_us: int, t: str = "t", ticks_per_us: int = 1, files_per_trigger: int | None = None) -> DataFrame:
    """A file stream with its own watermark. The global watermark is the least of all streams', so nothing is late
    because another node is ahead."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).withColumn("event_time", event_time(t, ticks_per_us)).withWatermark("event_time", f"{margin_us} microseconds")


def stream_pairs(streams: list[DataFrame], window: int, ticks_per_us: int = 1) -> DataFrame:
    """Prompt pairs of the merged streams as a stream-stream join: equal time bins, and a bound on event time by which
    state is dropped. Pairs on one channel are left out."""
    merged = merge_streams(streams)
    w = max(1, window)
    left = merged.select(*[F.col(c).alias(f"{c}1") for c in ("id", "channel", "crystal", "t", "event_time")], F.floor(F.col("t") / w).alias("bin1"))
    own = F.floor(F.col("t") / w)
    right = merged.select(*[F.col(c).alias(f"{c}2") for c in ("id", "channel", "crystal", "t", "event_time")], F.explode(F.array(own, own - 1)).alias("bin2"))
    us = -(-window // ticks_per_us) + 1
    near = F.expr(f"bin1 = bin2 AND event_time2 >= event_time1 - INTERVAL 1 MICROSECOND AND event_time2 <= event_time1 + INTERVAL {us} MICROSECOND")
    exact = (F.col("t2") - F.col("t1")).between(0, window) & ((F.col("t2") > F.col("t1")) | (F.col("id2") > F.col("id1"))) & (F.col("channel1") != F.col("channel2"))
    return left.join(right, near & exact).select("id1", "channel1", "crystal1", "t1", "id2", "channel2", "crystal2", "t2", (F.col("t2") - F.col("t1")).alias("dt"))


def run_available(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Processes what is there, in order, then stops: the drain at the end of a stream."""
    q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def bounded_state(spark: SparkSession, budget_mb: int = 2048) -> None:
    """State outside the JVM heap, with one budget for all state stores of an executor; set before a stream starts. How much
    a stream takes in at once is bounded by its source (maxFilesPerTrigger, packetsPerBatch)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", str(budget_mb))


#: Added to a micro-batch's number where the flush after it writes.
FLUSH = 1_000_000_000


class WatermarkBatches:
    """Coincidences batch by batch, as a master process that waits for all nodes does it.

    Rows up to the watermark leave the buffer and are paired among themselves; late rows leave with the next batch that
    advances; pairs across batches are not made. All state (buffer, last times, mark, number of batches) is a folder per micro-batch
    below `state`, complete once its meta table is written, and pairs go to a folder per micro-batch below `out`. A micro-batch
    that is run again, after a restart too, starts from its predecessor's state and replaces its own folders, so nothing is
    lost or there twice. Folders of state that no restart can need are deleted.
    """

    META = "last map<string,bigint>, mark bigint, batches bigint"

    def __init__(self, spark: SparkSession, out: str, state: str, nodes: int, margin: int, pair: Callable[[DataFrame], DataFrame], node: str = "node_id", t: str = "t"):
        self.spark, self.out, self.state, self.nodes, self.margin, self.pair, self.node, self.t = spark, out, state, nodes, margin, pair, node, t

    def _path(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _there(self, path: str) -> bool:
        p, fs = self._path(f"{path}/_SUCCESS")
        return fs.exists(p)

    def _steps(self) -> list[int]:
        """Micro-batches whose state is complete."""
        root, fs = self._path(self.state)
        names = [f.getPath().getName() for f in fs.listStatus(root)] if fs.exists(root) else []
        return sorted(int(n) for n in names if n.isdigit() and self._there(f"{self.state}/{n}/meta"))

    def _load(self, before: int) -> tuple[dict, DataFrame | None, int | None]:
        """The state after the last micro-batch before this one; after a flush, with nothing in the buffer."""
        steps = [n for n in self._steps() if n < before]
        if not steps:
            return {"last": {}, "mark": 0, "batches": 0}, None, None
        at = steps[-1]
        meta = self.spark.read.schema(self.META).parquet(f"{self.state}/{at}/meta").first().asDict()
        buffer = self.spark.read.parquet(f"{self.state}/{at}/buffer")
        if self._there(f"{self.state}/{at}/flushed"):
            return meta | {"batches": meta["batches"] + 1}, buffer.limit(0), at
        return meta, buffer, at

    def _save(self, step: int, meta: dict, held: DataFrame) -> None:
        held.write.mode("overwrite").parquet(f"{self.state}/{step}/buffer")
        self.spark.createDataFrame([(meta["last"], meta["mark"], meta["batches"])], self.META).coalesce(1).write.mode("overwrite").parquet(f"{self.state}/{step}/meta")
        for old in [n for n in self._steps() if n < step][:-1]:  # the last micro-batch before this may be run again
            gone, fs = self._path(f"{self.state}/{old}")
            fs.delete(gone, True)

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        meta, buffer, _ = self._load(batch_id)
        last = dict(meta["last"])
        for r in stats.chunk_ranges(rows, [self.node], self.t).collect():  # a row per node
            name = str(r[self.node])
            last[name] = max(last.get(name, r["max_t"]), r["max_t"])
        held = rows if buffer is None else buffer.unionByName(rows)
        mark = 0 if len(last) < self.nodes else max(0, min(last.values()) - self.margin)
        batches = meta["batches"]
        if mark > meta["mark"]:
            due, held = ordering.split_at(held, mark, self.t)
            self._emit(due, batches, batch_id)
            batches += 1
        self._save(batch_id, {"last": last, "mark": max(mark, meta["mark"]), "batches": batches}, held)

    def _emit(self, due: DataFrame, number: int, step: int) -> None:
        self.pair(due).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{self.out}/step={step}")

    def flush(self) -> None:
        """Pairs what is left, whatever the watermark, once; a flush that is run again replaces what it wrote."""
        meta, buffer, at = self._load(1 << 62)
        if buffer is not None and not self._there(f"{self.state}/{at}/flushed"):
            self._emit(buffer, meta["batches"], at + FLUSH)
            self.spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{self.state}/{at}/flushed")

    def pairs(self) -> DataFrame:
        """All that was written."""
        return self.spark.read.option("basePath", self.out).parquet(f"{self.out}/step=*").drop("step")


def run_batches(stream: DataFrame, handler: WatermarkBatches, checkpoint: str) -> None:
    """All that is there, then the flush."""
    Live(stream, handler, checkpoint, None).flush()


class Live:
    """A running stream of watermark batches: micro-batches every so many milliseconds (None: all that is there, then it
    stops), and the control that its operator has."""

    def __init__(self, stream: DataFrame, handler: WatermarkBatches, checkpoint: str, every_ms: int | None = 200):
        self.handler = handler
        w = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
        self.query = (w.trigger(availableNow=True) if every_ms is None else w.trigger(processingTime=f"{every_ms} milliseconds")).start()

    def control(self, command: str, timeout_s: float | None = None) -> str:
        """START is done by making the object; STOP ends it and keeps its state for the next; FLUSH pairs what is left, too.
        PAUSE and RESUME are not supported."""
        if command == "STOP":
            self.stop()
        elif command == "FLUSH":
            self.flush(timeout_s)
        else:
            raise ValueError(f"{command} is not supported")
        return command

    def stop(self) -> None:
        self.query.stop()
        self.query.awaitTermination()

    def flush(self, timeout_s: float | None = None) -> None:
        """Takes in all that is there, stops, and pairs what is left."""
        if self.query.isActive:
            self.query.processAllAvailable() if timeout_s is None else self.query.awaitTermination(timeout_s)
            self.stop()
        elif self.query.exception():
            raise self.query.exception()
        self.handler.flush()


def prompt_and_delay(window: int, delay: int, channels: int) -> Callable[[DataFrame], DataFrame]:
    return lambda due: interval_join.coincidences(due, window, delay, channels)


def progress(q: StreamingQuery) -> list[dict]:
    """Rows, watermark, state and late rows of each finished batch."""
    keep = []
    for p in q.recentProgress:
        p = p if isinstance(p, dict) else json.loads(p.json)
        keep.append({"batch": p["batchId"], "ms": p.get("batchDuration", 0), "rows": p["numInputRows"], "watermark": p.get("eventTime", {}).get("watermark"), "state_rows": sum(s["numRowsTotal"] for s in p.get("stateOperators", [])), "late": sum(s.get("numRowsDroppedByWatermark", 0) for s in p.get("stateOperators", []))})
    return keep


def totals(q: StreamingQuery, pairs: DataFrame) -> dict:
    """Rows taken in, micro-batches, mean milliseconds of a micro-batch (0.9 of the mean before and 0.1 of the new one), and pairs
    of each kind."""
    mean, done = 0.0, progress(q)
    for p in done:
        mean = 0.9 * mean + 0.1 * p["ms"]
    kinds = {r["kind"]: r["n"] for r in pairs.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {"rows": sum(p["rows"] for p in done), "batches": len(done), "mean_ms": mean, "prompt": kinds.get("prompt", 0), "delay": kinds.get("delay", 0)}
