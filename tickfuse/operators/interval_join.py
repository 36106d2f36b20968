"""Coincidence joins: a range join as an equi join on time bins.

A pair of events at most W apart lies in one bin of width W or in two that follow each other, so each right row goes to
two bins (three for a delayed window) and each pair comes out once. Hot bins are split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import channel_separation

_SIDE = ("id", "channel", "crystal", "t")


def _side(singles: DataFrame, n: int, extra: list[str]) -> DataFrame:
    return singles.select(*[F.col(c).alias(f"{c}{n}") for c in _SIDE], *[F.col(c).alias(f"__{c}{n}") for c in extra])


def _separated(channels: int | None, least: int) -> Column:
    if channels:
        return channel_separation(F.col("channel1"), F.col("channel2"), channels) >= least
    return F.abs(F.col("channel1") - F.col("channel2")) >= least


def prompt_pairs(singles: DataFrame, window: int, channels: int | None = None, min_sep: int = 1, scope: list[str] | None = None) -> DataFrame:
    """Pairs (a, b) with a before b by (t, id), dt = b.t - a.t <= window, channels at least min_sep apart.

    scope: columns that must agree (a batch or group), for pairs that stay within one."""
    scope, w = scope or [], max(1, window)
    left = _side(singles, 1, scope).withColumn("bin", F.floor(F.col("t1") / w))
    right = _side(singles, 2, scope).withColumn("__own", F.floor(F.col("t2") / w))
    right = right.withColumn("bin", F.explode(F.array(F.col("__own"), F.col("__own") - 1))).drop("__own")
    on = (left["bin"] == right["bin"]) & (F.col("t2") - F.col("t1")).between(0, window) & ((F.col("t2") > F.col("t1")) | (F.col("id2") > F.col("id1"))) & _separated(channels, min_sep)
    for c in scope:
        on = on & (F.col(f"__{c}1") == F.col(f"__{c}2"))
    return left.join(right, on).select("id1", "channel1", "crystal1", "t1", "id2", "channel2", "crystal2", "t2", (F.col("t2") - F.col("t1")).alias("dt"))


def delay_pairs(singles: DataFrame, window: int, delay: int, channels: int | None = None, min_sep: int = 1, scope: list[str] | None = None) -> DataFrame:
    """Pairs with |(b.t - a.t) - delay| <= window, dt = b.t - a.t - delay. delay must exceed window."""
    if delay <= window:
        raise ValueError("the delay must be longer than the window")
    scope, w = scope or [], max(1, window)
    left = _side(singles, 1, scope).withColumn("bin", F.floor(F.col("t1") / w))
    right = _side(singles, 2, scope).withColumn("__own", F.floor((F.col("t2") - delay) / w))
    right = right.withColumn("bin", F.explode(F.array(F.col("__own") - 1, F.col("__own"), F.col("__own") + 1))).drop("__own")
    on = (left["bin"] == right["bin"]) & (F.col("t2") - F.col("t1") - delay).between(-window, window) & _separated(channels, min_sep)
    for c in scope:
        on = on & (F.col(f"__{c}1") == F.col(f"__{c}2"))
    return left.join(right, on).select("id1", "channel1", "crystal1", "t1", "id2", "channel2", "crystal2", "t2", (F.col("t2") - F.col("t1") - delay).alias("dt"))


def drop_multiples(pairs: DataFrame) -> DataFrame:
    """Pairs of which neither event is in another pair."""
    ends = pairs.select(F.explode(F.array("id1", "id2")).alias("id")).groupBy("id").count().where("count > 1").select("id")
    return pairs.join(ends.select(F.col("id").alias("id1")), "id1", "left_anti").join(ends.select(F.col("id").alias("id2")), "id2", "left_anti").select(pairs.columns)


def coincidences(singles: DataFrame, window: int, delay: int, channels: int | None = None, multiples: str = "all", scope: list[str] | None = None) -> DataFrame:
    """Prompt and delayed pairs with a column kind, as both sinks take them."""
    both = [prompt_pairs(singles, window, channels, scope=scope), delay_pairs(singles, window, delay, channels, scope=scope)]
    both = [drop_multiples(p) if multiples == "drop" else p for p in both]
    return both[0].withColumn("kind", F.lit("prompt")).unionByName(both[1].withColumn("kind", F.lit("delay")))


def overlaps(intervals: DataFrame, width: int, start: str = "start_ns", end: str = "end_ns", key: str = "idx") -> DataFrame:
    """Pairs of half-open intervals that overlap (idx1 is the smaller key), with the overlap's length.

    Bins of `width` are level 0, and each level's bins are twice as wide. An interval belongs to the level whose bins are at
    least as long as it is, so it touches two of them at most; intervals of lower levels come to that level's bins too, again to
    two at most. A pair comes out at the higher of its levels, in the bin of its later start, so no interval is cut into
    many pieces however long it is."""
    cut = intervals.select(F.col(key).alias("k"), F.col(start).alias("s"), F.col(end).alias("e")).where("e > s")
    cut = cut.withColumn("level", F.greatest(F.lit(0), F.ceil(F.log2((F.col("e") - F.col("s")) / width))).cast("int"))
    levels = sorted(r["level"] for r in cut.select("level").distinct().collect())  # 64 at most
    every = cut.withColumn("at", F.explode(F.filter(F.array(*[F.lit(x) for x in levels]).cast("array<int>"), lambda x: x >= F.col("level"))))
    wide = F.lit(width).cast("bigint") * F.expr("shiftleft(1L, at)")
    every = every.withColumn("w", wide).withColumn("bin", F.explode(F.sequence(F.floor(F.col("s") / F.col("w")), F.floor((F.col("e") - 1) / F.col("w")))))
    a = every.where("at = level").select(*[F.col(c).alias(f"{c}1") for c in ("k", "s", "e")], "at", "bin", "w")
    b = every.select(*[F.col(c).alias(f"{c}2") for c in ("k", "s", "e", "level")], "at", "bin")
    pairs = a.join(b, ["at", "bin"]).where((F.col("level2") < F.col("at")) | (F.col("k1") < F.col("k2")))
    pairs = pairs.where((F.col("s1") < F.col("e2")) & (F.col("s2") < F.col("e1")) & (F.col("bin") == F.floor(F.greatest("s1", "s2") / F.col("w"))))
    return pairs.select(F.least("k1", "k2").alias("idx1"), F.greatest("k1", "k2").alias("idx2"), (F.least("e1", "e2") - F.greatest("s1", "s2")).alias("overlap_ns"))


def merge_decisions(intervals: DataFrame, tolerance: int, width: int, mode: str = "corrected", start: str = "start_ns", end: str = "end_ns", key: str = "idx") -> DataFrame:
    """Pairs to merge: those that overlap, and in corrected mode those whose gap is at most the tolerance."""
    if mode == "faithful":
        return overlaps(intervals, width, start, end, key).select("idx1", "idx2")
    wide = intervals.where(F.col(end) > F.col(start)).withColumn(end, F.col(end) + tolerance + 1)  # a gap up to the tolerance overlaps then
    return overlaps(wide, width, start, end, key).select("idx1", "idx2")


def separation_histogram(pairs: DataFrame, channels: int) -> DataFrame:
    """Dense histogram of circular channel separation, bins 0 .. channels / 2."""
    counts = pairs.groupBy(channel_separation(F.col("channel1"), F.col("channel2"), channels).cast("bigint").alias("sep")).agg(F.count(F.lit(1)).alias("n"))
    bins = pairs.sparkSession.range(channels // 2 + 1).withColumnRenamed("id", "sep")
    return bins.join(counts, "sep", "left").select("sep", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def pair_matrix(pairs: DataFrame, channels: int) -> DataFrame:
    """Upper-triangle counts of channel pairs, and whether both are in range."""
    return pairs.groupBy(F.least("channel1", "channel2").alias("low"), F.greatest("channel1", "channel2").alias("high")).agg(F.count(F.lit(1)).alias("n")).withColumn("in_range", (F.col("low") >= 0) & (F.col("high") < channels))


def dt_stats(pairs: DataFrame, window: int) -> DataFrame:
    return pairs.agg(F.count(F.lit(1)).alias("checked"), F.count_if(F.col("dt") < 0).alias("negative"), F.count_if(F.abs("dt") > window).alias("over_window"), F.min("dt").alias("min_dt"), F.max("dt").alias("max_dt"))


def distribution(hist: DataFrame, channels: int, kind: str) -> DataFrame:
    """Share of the opposite channel's bin, and the coefficient of variation over all bins, zeros too."""
    return hist.agg(F.lit(kind).alias("kind"), F.sum("n").cast("bigint").alias("pairs"), (F.sum(F.when(F.col("sep") == channels // 2, F.col("n")).otherwise(0)) / F.sum("n")).alias("opposite_ratio"), (F.stddev_pop("n") / F.avg("n")).alias("cv"))


def top_bins(hist: DataFrame, k: int = 5) -> DataFrame:
    """The k fullest bins; ties go to the smaller separation."""
    return hist.orderBy(F.desc("n"), "sep").limit(k)


def has_peak(hist: DataFrame, expected: int, ratio: float, within: int = 2) -> DataFrame:
    """Whether the expected bin is among the `within` fullest and holds at least `ratio` of all."""
    total = hist.agg(F.sum("n").alias("total"))
    top = hist.orderBy(F.desc("n"), "sep").limit(within)
    return top.crossJoin(F.broadcast(total)).agg(F.coalesce(F.bool_or((F.col("sep") == expected) & (F.col("n") >= F.lit(ratio) * F.col("total"))), F.lit(False)).alias("peak"))

