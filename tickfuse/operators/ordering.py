"""Orders, splits at a boundary, merges of node streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def sort_within(singles: DataFrame, by: list[str], time: str = "time_100fs", ties: tuple[str, ...] = ("channel", "crystal")) -> DataFrame:
    """Sorted by time inside each segment or group, which is all that files and joins need."""
    return singles.repartition(*by).sortWithinPartitions(*by, time, *ties)


def merge_streams(streams: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), streams)


def split_at(singles: DataFrame, boundary: int, t: str = "t") -> tuple[DataFrame, DataFrame]:
    """What is due (t <= boundary), and what stays."""
    return singles.where(F.col(t) <= boundary), singles.where(F.col(t) > boundary)


def complete_chunks(chunks: DataFrame, node: str, order: list[str], max_t: str, boundary: int) -> DataFrame:
    """By node the chunks before the first that reaches beyond the boundary."""
    w = Window.partitionBy(node).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return chunks.withColumn("__ok", F.bool_and(F.col(max_t) <= boundary).over(w)).where("__ok").drop("__ok")


def packet_order(packets: DataFrame, time: str, directory: str, segment: str, packet: str) -> DataFrame:
    """Sort keys of a merge of directories: time first, then directory, segment and packet."""
    return packets.withColumns({"sort_key": F.col(time), "sort_sub": F.col(directory) * 1_000_000 + F.col(segment) * 1000 + F.col(packet)})


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def insert_chunks(buffer: DataFrame, arrived: DataFrame, node: str, time: str) -> DataFrame:
    """Chunks of a buffer and those that arrived, with their place by time within the node; of equal times the older first."""
    both = buffer.withColumn("__new", F.lit(0)).unionByName(arrived.withColumn("__new", F.lit(1)))
    return both.withColumn("place", F.row_number().over(Window.partitionBy(node).orderBy(time, "__new")) - 1).drop("__new")


def drop_front(buffer: DataFrame, node: str, time: str, n: int) -> tuple[DataFrame, DataFrame]:
    """The first n chunks of each node, and the rest."""
    placed = buffer.withColumn("__p", F.row_number().over(Window.partitionBy(node).orderBy(time)))
    return placed.where(F.col("__p") <= n).drop("__p"), placed.where(F.col("__p") > n).drop("__p")
