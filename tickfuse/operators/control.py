"""Control-plane tables: tasks, overrides, node states, barriers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .sequence import global_number, stepped

# Allowed changes of a node's state.
TRANSITIONS = [("IDLE", "CONFIGURED"), ("CONFIGURED", "CONFIGURED"), ("CONFIGURED", "RUNNING"), ("RUNNING", "CONFIGURED"), ("IDLE", "ERROR"), ("CONFIGURED", "ERROR"), ("RUNNING", "ERROR"), ("ERROR", "CONFIGURED"), ("CONFIGURED", "IDLE"), ("RUNNING", "IDLE"), ("ERROR", "IDLE")]


def node_overrides(tasks: DataFrame, overrides: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Tasks with the fields that an override names; the rest keep the base value."""
    o = overrides.select(key, *[F.col(f).alias(f"__{f}") for f in fields])
    return tasks.join(o, key, "left").withColumns({f: F.coalesce(f"__{f}", f) for f in fields}).drop(*[f"__{f}" for f in fields])


def with_default(x: Column, default: int) -> Column:
    return F.when(x > 0, x).otherwise(F.lit(default))


# What a task takes where it says 0.
DEFAULTS = {"min_packet": 1024, "max_packet": 1024, "max_buffer": 4 << 30, "time_switch_ms": 1000, "copy_threads": 8, "rx_rings": 1, "mbuf_size": 32, "mbuf_num": 2}
#: Ports, channels and the least time between buffers.
MOST, LEAST_SWITCH_MS = 65535, 10


def task_defaults(tasks: DataFrame, strict: bool = True) -> DataFrame:
    """Tasks with defaults for what is 0, ports and channels that end at 65535, and a column fault: null, or why the task is
    refused (packet sizes that contradict each other, no channels). strict raises on a refused task instead. Columns that
    tasks doesn't have are not made."""
    has = set(tasks.columns)
    out = tasks.withColumns({c: with_default(F.col(c), n) for c, n in DEFAULTS.items() if c in has} | {c: F.least(F.col(c), F.lit(MOST)) for c in ("port", "port_dest", "channel_index") if c in has})
    if "time_switch_ms" in has:
        out = out.withColumn("time_switch_ms", F.greatest("time_switch_ms", F.lit(LEAST_SWITCH_MS)))
    fault = F.when(F.col("max_packet") < F.col("min_packet"), "max_packet below min_packet") if {"min_packet", "max_packet"} <= has else F.lit(None)
    if "channels" in has:
        fault = F.coalesce(fault, F.when(F.col("channels") == 0, "no channels"))
    out = out.withColumn("fault", fault.cast("string"))
    return out.where(F.when(F.col("fault").isNull(), F.lit(True)).otherwise(F.raise_error(F.col("fault")).cast("boolean"))).drop("fault") if strict else out


def effective_channels(sources: DataFrame, order: str, dest_ip: int | None, port_base: int, port_stride: int = 1, channel_base: int = 0, channel_stride: int = 1, width: int = 100_000) -> DataFrame:
    """Channels of a task that names detector sources only: destination and channel numbers step from their bases in the
    order of a distinct integer column, a stride of 0 counts as 1, and numbers above 32 bits raise. sources keeps its columns."""
    if dest_ip is None:
        raise ValueError("detector sources need a destination rule")
    n = global_number(sources, order, width, "__n")
    most = (1 << 32) - 1
    return n.withColumns({"ip_dest": F.lit(dest_ip).cast("bigint"), "port_dest": stepped(F.col("__n"), port_base, port_stride, most), "channel_index": stepped(F.col("__n"), channel_base, channel_stride, most)}).drop("__n")


def bad_transitions(log: DataFrame, node: str, state: str, order: str) -> DataFrame:
    """Log rows whose state may not follow the one before."""
    allowed = log.sparkSession.createDataFrame(TRANSITIONS, "prev_state string, next_state string")
    prev = log.withColumn("prev_state", F.coalesce(F.lag(state).over(Window.partitionBy(node).orderBy(order)), F.lit("IDLE")))
    return prev.join(F.broadcast(allowed.withColumnRenamed("next_state", state)), ["prev_state", state], "left_anti")


def snapshot(status: DataFrame, node: str, time: str, order: str | None = None) -> DataFrame:
    """Latest row of each node; of rows at one time that of the greatest `order`."""
    rest = [c for c in status.columns if c != node]
    at = F.struct(time, order) if order else F.col(time)
    return status.groupBy(node).agg(F.max_by(F.struct(*rest), at).alias("s")).select(node, "s.*")


def cluster_status(status: DataFrame, time: str, values: list[str]) -> DataFrame:
    """Sums over the nodes at each time."""
    return status.groupBy(time).agg(F.count(F.lit(1)).alias("nodes"), *[F.sum(c).alias(c) for c in values])


def start_barrier(registrations: DataFrame, node: str, time_ms: str, expected: int, lead_ms: int = 1000) -> DataFrame:
    """One row: nodes registered, whether all are there, and the planned start."""
    n = F.count_distinct(node)
    return registrations.agg(n.alias("registered"), (n >= expected).alias("ready"), F.when(n >= expected, F.max(time_ms) + lead_ms).alias("start_ms"))


def wait_for_start(waits: DataFrame, registrations: DataFrame, expected: int, node: str = "node_id", time_ms: str = "ms", timeout_ms: str = "timeout_ms", lead_ms: int = 1000) -> DataFrame:
    """What each node that waits (node, time, timeout; 0 waits for ever) is told: success, message, start_ms. The start signal
    comes when the last of the expected nodes registers. One row of registrations a node counts, its first."""
    first = registrations.groupBy(node).agg(F.min(time_ms).alias("__registered"))
    signal = first.agg(F.when(F.count(F.lit(1)) >= expected, F.max("__registered")).alias("__signal"))
    out = waits.join(first, node, "left").crossJoin(F.broadcast(signal))  # one row
    out_of_range = ~F.col(node).between(0, expected - 1)
    missing = F.col("__registered").isNull() | (F.col("__registered") > F.col(time_ms))
    late = F.col("__signal").isNull() | ((F.col(timeout_ms) > 0) & (F.col("__signal") > F.col(time_ms) + F.col(timeout_ms)))
    message = F.when(out_of_range, "node id out of range").when(missing, "not registered yet").when(late, "timed out waiting for the start signal").otherwise("start signal issued")
    ok = ~out_of_range & ~missing & ~late
    return out.withColumns({"success": ok, "message": message, "start_ms": F.when(ok, F.col("__signal") + lead_ms)}).drop("__registered", "__signal")


def admitted(chunks: DataFrame, start_ms: int, time_ms: str) -> DataFrame:
    """Chunks that arrive once the start signal is out; earlier ones are refused."""
    return chunks.where(F.col(time_ms) >= start_ms)


def liveness(heartbeats: DataFrame, node: str, time_ms: str, now_ms: int, timeout_ms: int = 15000) -> DataFrame:
    return heartbeats.groupBy(node).agg(F.max(time_ms).alias("last_ms")).withColumn("alive", F.lit(now_ms) - F.col("last_ms") <= timeout_ms)


def scheduled(tasks: DataFrame, start: str = "planned_start_ms", duration: str = "duration_ms") -> DataFrame:
    """end_ms: the planned stop, null where a task has no duration."""
    return tasks.withColumn("end_ms", F.when(F.col(duration) > 0, F.col(start) + F.col(duration)))


def ring_placement(calibrations: DataFrame, per_ring: int, ring: str = "ring", file: str = "file") -> DataFrame:
    """A row per channel of each ring's calibration file: ring k holds channels k * per_ring onwards."""
    return calibrations.withColumn("within", F.explode(F.sequence(F.lit(0), F.lit(per_ring - 1)))).select((F.col(ring) * per_ring + F.col("within")).alias("channel"), F.col(file), F.col(ring), "within")


def pair_rings(directories: DataFrame, rings: int, channels: DataFrame | None, per_ring: int, place: str = "place") -> DataFrame:
    """The ring of each calibration directory (place: 0, 1, ...): as they come where there is one for every ring; else the rings
    that `channels` (column channel) are on, in order, as many as there are; else as they come. Directories without a ring go."""
    n = directories.count()  # a row a directory
    if n == rings or channels is None:
        return directories.where(F.col(place) < rings).withColumn("ring", F.col(place))
    on = channels.select(F.floor(F.col("channel") / per_ring).cast("bigint").alias("ring")).distinct()
    return directories.join(global_number(on, "ring", 1 << 20, place), place)


def distinct_rings(channels: DataFrame, rings: int, per_ring: int, channel: str = "channel") -> DataFrame:
    """Rings that channels are on."""
    return channels.select(F.floor((F.col(channel) % (rings * per_ring)) / per_ring).cast("bigint").alias("ring")).distinct()


def override_tasks(tasks: DataFrame, hook: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """Tasks as a hook changes them, node by node or all at once; it must keep their columns."""
    out = hook(tasks) if hook else tasks
    if out.columns != tasks.columns:
        raise ValueError(f"the hook must keep the columns {tasks.columns}")
    return out


def foreign_bindings(bound: DataFrame, local: DataFrame, ip: str = "ip") -> DataFrame:
    """Bind addresses that aren't addresses of this host."""
    return bound.join(local.select(ip).distinct(), ip, "left_anti")
