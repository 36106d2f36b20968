"""Window and sequence operators. Orders over a whole table are cut into ranges first, so that no single task sorts it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def exclusive_sum(df: DataFrame, value: str, by: list[str], order: list[str], out: str) -> DataFrame:
    """Sum of the values before a row within its group."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)).cast("bigint"))


def ranged_sum(df: DataFrame, value: Column, order: str, width: int, out: str) -> DataFrame:
    """Exclusive sum over the whole table in the order of a distinct integer column: sums within ranges of `width`,
    and before each range the sum of the earlier ranges' totals (one row a range)."""
    cut = df.withColumn("__v", value).withColumn("__range", F.floor(F.col(order) / width))
    totals = cut.groupBy("__range").agg(F.sum("__v").alias("__total"))
    before = totals.select("__range", (F.sum("__total").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__total")).alias("__before"))
    w = Window.partitionBy("__range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    inner = cut.withColumn("__in", F.sum("__v").over(w) - F.col("__v"))
    return inner.join(before, "__range").withColumn(out, (F.col("__in") + F.col("__before")).cast("bigint")).drop("__range", "__v", "__in", "__before")


def global_number(df: DataFrame, order: str, width: int, out: str) -> DataFrame:
    """0-based place of a row over the whole table, in the order of a distinct integer column."""
    return ranged_sum(df, F.lit(1), order, width, out)


def fixed_chunks(df: DataFrame, order: str, size: int, width: int = 100_000) -> DataFrame:
    """chunk_id and the place within the chunk, `size` rows a chunk."""
    return global_number(df, order, width, "__n").withColumn("chunk_id", F.expr(f"__n div {size}")).withColumn("chunk_offset", F.col("__n") % size).drop("__n")


def sequence_gaps(df: DataFrame, node: str, chunk: str, arrival: str) -> DataFrame:
    """Rows whose chunk number doesn't follow the one that arrived before on its node: prev_id and gap."""
    prev = F.lag(chunk).over(Window.partitionBy(node).orderBy(arrival))
    return df.withColumn("prev_id", prev).where(F.col(chunk) != F.col("prev_id") + 1).withColumn("gap", F.col(chunk) - F.col("prev_id") - 1)


def reorders(df: DataFrame, node: str, time: str, arrival: str) -> DataFrame:
    """By node: chunks, and those that begin before an earlier chunk does."""
    w = Window.partitionBy(node).orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("__m", F.max(time).over(w)).groupBy(node).agg(F.count(F.lit(1)).alias("chunks"), F.count_if(F.col("__m") > F.col(time)).alias("reordered"))


def rebase_offsets(df: DataFrame, by: list[str], order: str, offset: str, out: str) -> DataFrame:
    return df.withColumn(out, F.col(offset) - F.first(offset).over(Window.partitionBy(*by).orderBy(order)))


def tile_split(df: DataFrame, by: list[str], order: list[str], parts: int, reference: Column) -> DataFrame:
    """part of each row: each part but the last takes an even share of what is left, at most `reference` rows
    (0: no cap); a share of zero takes all that is left. The last part takes the rest."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*by))
    df = df.withColumn("__n", n).withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1).withColumn("__ref", reference)
    begin, part = F.lit(0).cast("bigint"), F.lit(0)
    for p in range(parts):
        left = F.col("__n") - begin
        share = F.floor(left / (parts - p))
        if p + 1 < parts:
            share = F.when(F.col("__ref") > 0, F.least(share, F.col("__ref"))).otherwise(share)
        share = F.when(share == 0, left).otherwise(share)
        name = f"__b{p}"
        df = df.withColumn(name, begin + share)
        begin = F.col(name)
        part = part + F.when(F.col("__r") >= begin, 1).otherwise(0)
    return df.withColumn("part", F.least(part, F.lit(parts - 1)).cast("int")).drop("__n", "__r", "__ref", *[f"__b{p}" for p in range(parts)])


def even_partition(items: DataFrame, order: list[str], nodes: int) -> DataFrame:
    """node_no and local_idx: the first nodes get one item more where they don't divide evenly. Items are the channels of a
    detector, a few thousand at most, so one task orders them."""
    tile = F.ntile(nodes).over(Window.orderBy(*order)) - 1
    items = items.withColumn("node_no", tile)
    return items.withColumn("local_idx", F.row_number().over(Window.partitionBy("node_no").orderBy(*order)) - 1)


def stepped(i: Column, base: int, stride: int, most: int | None = None) -> Column:
    """base + stride * i; a stride of 0 counts as 1; above `most` raises."""
    v = F.lit(base) + F.lit(stride or 1) * i
    return v if most is None else F.when(v <= most, v).otherwise(F.raise_error(F.concat(F.lit("stepped value overflows: "), v.cast("string"))).cast("bigint"))


def counter_rates(df: DataFrame, node: str, time_us: str, counters: list[str]) -> DataFrame:
    """Change of each counter per second since the node's row before; null for the first and where time stands still."""
    w = Window.partitionBy(node).orderBy(time_us)
    dt = (F.col(time_us) - F.lag(time_us).over(w)) / 1e6
    return df.withColumns({f"{c}_per_s": F.when(dt > 0, (F.col(c) - F.lag(c).over(w)) / dt) for c in counters})
