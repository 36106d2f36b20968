"""Order-dependent folds. Each runs over rows sorted within a key and holds one state, never a group's rows."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Collection, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def streaming_fold(df: DataFrame, keys: list[str], order: list[str], values: list[str], make: Callable, out: str, kind: str) -> DataFrame:
    """Adds column `out`: make() gives a function from the row's values to the result, anew for each key. Rows come
    sorted, in batches; a key may go on over batches."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", {out} {kind}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, step = None, None
        for b in batches:
            results = []
            for row in zip(*(b[c] for c in [*keys, *values]), strict=True):
                if step is None or row[: len(keys)] != now:
                    now, step = row[: len(keys)], make()
                results.append(step(*row[len(keys) :]))
            yield b.assign(**{out: results})

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)


def rolling_files(df: DataFrame, keys: list[str], order: list[str], size: str, most: int) -> DataFrame:
    """file_seq: a new file begins where the current one holds something and this row would take it above `most`."""

    def make() -> Callable:
        seq, used = 0, 0

        def step(n: int) -> int:
            nonlocal seq, used
            if most > 0 and used > 0 and used + n > most:
                seq, used = seq + 1, 0
            used += n
            return seq

        return step

    return streaming_fold(df, keys, order, [size], make, "file_seq", "int")


def islands(df: DataFrame, start: str, gap: int, width: int, tie: str) -> DataFrame:
    """island: rows whose starts follow each other by at most `gap`. Found by ranges of `width`, so nothing sorts the
    whole table; the ranges' ends (a row each) are what one window sees."""
    cut = df.withColumn("__range", F.floor(F.col(start) / width))
    ends = cut.groupBy("__range").agg(F.max(start).alias("__max"))
    before = ends.select("__range", F.lag("__max").over(Window.orderBy("__range")).alias("__before"))
    w = Window.partitionBy("__range").orderBy(start, tie)
    cut = cut.join(before, "__range").withColumn("__prev", F.coalesce(F.lag(start).over(w), "__before"))
    cut = cut.withColumn("__new", F.when(F.col("__prev").isNull() | (F.col(start) - F.col("__prev") > gap), 1).otherwise(0))
    totals = cut.groupBy("__range").agg(F.sum("__new").alias("__t"))
    base = totals.select("__range", (F.sum("__t").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__t")).alias("__base"))
    run = F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return cut.withColumn("__run", run).join(base, "__range").withColumn("island", (F.col("__run") + F.col("__base")).cast("bigint")).drop("__range", "__before", "__prev", "__new", "__run", "__base")


def anchored_groups(df: DataFrame, start: str, end: str, tie: str, tolerance: int, width: int) -> DataFrame:
    """Groups by anchor: a row whose start is more than `tolerance` after its group's first start begins a group.
    A gap longer than the tolerance always begins one, so each island is folded by itself.

    Columns: group_start (names the group), group_end, members."""

    def make() -> Callable:
        anchor = None

        def step(s: int) -> int:
            nonlocal anchor
            if anchor is None or s > anchor + tolerance:
                anchor = s
            return anchor

        return step

    cut = islands(df.select(start, end, tie), start, tolerance, width, tie)
    folded = streaming_fold(cut, ["island"], [start, tie], [start], make, "group_start", "bigint")
    return folded.groupBy("group_start").agg(F.max(end).alias("group_end"), F.count(F.lit(1)).alias("members"))


def mean_towards_zero(x: Collection[int]) -> int:
    """Integer mean, exact however large the sum."""
    s = sum(x)
    return abs(s) // len(x) * (1 if s >= 0 else -1)


def gated_mean(df: DataFrame, keys: list[str], order: list[str], offset: str, last: int = 100, gate: int | None = 50_000_000) -> DataFrame:
    """avg_offset: mean of the last accepted offsets; one further than `gate` from that mean is not accepted."""

    def make() -> Callable:
        kept: deque = deque(maxlen=last)

        def step(x: int) -> int:
            if not kept or gate is None or abs(int(x) - mean_towards_zero(kept)) < gate:
                kept.append(int(x))
            return mean_towards_zero(kept)

        return step

    return streaming_fold(df, keys, order, [offset], make, "avg_offset", "bigint")


def ema(df: DataFrame, keys: list[str], order: list[str], value: str, old: float = 0.7, new: float = 0.3, start: float | None = None) -> DataFrame:
    """ema: old * previous + new * value; before the first value it is `start`, or where that is None, that value."""

    def make() -> Callable:
        now = start

        def step(x: float) -> float:
            nonlocal now
            now = float(x) if now is None else old * now + new * float(x)
            return now

        return step

    return streaming_fold(df, keys, order, [value], make, "ema", "double")


def bridge(df: DataFrame, keys: list[str], order: list[str], arrive: str, service: str, capacity: int, block: bool) -> DataFrame:
    """outcome of segments that pass a queue of `capacity` to one worker: taken, or where the queue is full, blocked (it waits
    till there is room) or dropped; finish is when the worker is done with it (null if dropped). Times are integers."""

    def make() -> Callable:
        queue: deque = deque()
        last = None

        def step(at: int, cost: int) -> dict:
            nonlocal last
            at, outcome = int(at), "taken"
            while queue and queue[0] <= at:
                queue.popleft()
            if len(queue) >= capacity:
                if not block:
                    return {"outcome": "dropped", "finish": None}
                at, outcome = queue[0], "blocked"
                while queue and queue[0] <= at:
                    queue.popleft()
            last = max(at, last if last is not None else at) + int(cost)
            queue.append(last)
            return {"outcome": outcome, "finish": last}

        return step

    return streaming_fold(df, keys, order, [arrive, service], make, "passed", "struct<outcome:string,finish:bigint>").select("*", "passed.*").drop("passed")
