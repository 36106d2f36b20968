"""Clock synchronisation as queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

HOUR_NS = 3_600_000_000_000


def ntp(samples: DataFrame) -> DataFrame:
    """offset_ns = ((t2 - t1) + (t3 - t4)) / 2 towards zero, rtt_ns = (t4 - t1) - (t3 - t2)."""
    return samples.withColumns({"offset_ns": F.expr("((t2 - t1) + (t3 - t4)) div 2"), "rtt_ns": F.expr("(t4 - t1) - (t3 - t2)")})


def min_rtt_offset(samples: DataFrame, client: str, order: str) -> DataFrame:
    """By client the offset of the sample of least round trip; ties go to the first."""
    best = F.min_by("offset_ns", F.struct("rtt_ns", order))
    return ntp(samples).groupBy(client).agg(best.alias("offset_ns"), F.min("rtt_ns").alias("rtt_ns"))


def median_offset(samples: DataFrame, client: str, order: str, of: int = 5) -> DataFrame:
    """Upper median of the first `of` offsets and their mean round trip."""
    first = ntp(samples).withColumn("__r", F.row_number().over(Window.partitionBy(client).orderBy(order))).where(F.col("__r") <= of)
    got = first.groupBy(client).agg(F.sort_array(F.collect_list("offset_ns")).alias("__o"), F.count(F.lit(1)).alias("samples"), F.sum("rtt_ns").alias("__rtt"))
    return got.select(client, "samples", F.element_at("__o", F.expr("cast(samples div 2 + 1 as int)")).alias("offset_ns"), F.expr("__rtt div samples").alias("mean_rtt_ns"))


def running_offset(samples: DataFrame, client: str, order: str, offset: str = "offset_ns", last: int = 100) -> DataFrame:
    """Sum and number of the last offsets, and their mean towards zero, without a gate (folds.gated_mean has one)."""
    w = Window.partitionBy(client).orderBy(order).rowsBetween(1 - last, 0)
    return samples.withColumns({"kept": F.count(F.lit(1)).over(w), "__s": F.sum(offset).over(w)}).withColumn("avg_offset", F.expr("__s div kept")).drop("__s")


def drift_ppm(samples: DataFrame, client: str, order: str, time: str, offset: str = "offset_ns", last: int = 100, least: int = 10) -> DataFrame:
    """Change of offset over change of time within the last samples, in ppm, from `least` samples on."""
    w = Window.partitionBy(client).orderBy(order).rowsBetween(1 - last, 0)
    n, dt = F.count(F.lit(1)).over(w), F.col(time) - F.first(time).over(w)
    return samples.withColumn("drift_ppm", F.when((n >= least) & (dt > 0), (F.col(offset) - F.first(offset).over(w)) / dt * 1e6))


def confidence(n: Column) -> Column:
    return F.least(n / 10.0, F.lit(1.0))


def plausible(samples: DataFrame, client_ns: str, server_ns: str) -> DataFrame:
    """Client times that aren't 0 and within an hour of the server's; latency is half the difference in ms, below 0 where the
    client is ahead."""
    d = F.col(server_ns) - F.col(client_ns)
    return samples.where((F.col(client_ns) != 0) & (F.abs(d) <= HOUR_NS)).withColumn("latency_ms", d / 2e6)


def client_table(samples: DataFrame, client: str, order: str) -> DataFrame:
    """Latest state of each client: samples, last offset, confidence. A client that is reset has the samples after it only."""
    return samples.groupBy(client).agg(F.count(F.lit(1)).alias("syncs"), F.max_by("offset_ns", order).alias("offset_ns"), F.max(order).alias("last")).withColumn("confidence", confidence(F.col("syncs")))


def calibrate(intervals: DataFrame, start: str = "start_ns", end: str = "end_ns", offset: str = "offset_ns", drift: str | None = None) -> DataFrame:
    """Intervals on the common clock; with a drift in ppm, corrected over their own length."""
    out = intervals.withColumns({"cal_start_ns": F.col(start) + F.col(offset), "cal_end_ns": F.col(end) + F.col(offset)})
    if drift:
        out = out.withColumn("cal_end_ns", F.col("cal_end_ns") + F.floor((F.col(end) - F.col(start)) * F.col(drift) / 1e6).cast("bigint"))
    return out


def alignment(events: DataFrame, time: str = "cal_ns") -> DataFrame:
    """Spread of calibrated times and its grade."""
    s = F.max(time) - F.min(time)
    return events.agg(s.alias("spread_ns"), F.when(s < 1_000_000, "excellent").when(s < 10_000_000, "good").otherwise("acceptable").alias("grade"))


def after_reset(samples: DataFrame, resets: DataFrame, client: str, order: str) -> DataFrame:
    """Samples after the last reset of their client; resets: client and the order at which it was reset."""
    last = resets.groupBy(client).agg(F.max(order).alias("__reset"))
    return samples.join(last, client, "left").where(F.col("__reset").isNull() | (F.col(order) > F.col("__reset"))).drop("__reset")
