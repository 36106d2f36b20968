"""File listings as tables: clocks and part numbers from names, natural orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """path, name, bytes of the files of a folder; contents aren't read. Empty files aren't listed."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path", F.col("length").alias("bytes"))
    return found.withColumn("name", F.element_at(F.split("path", "/"), -1))


# How raw files are named on disk.
PREFIX, SUFFIX = "pniRaw-", ".bin"


def start_clock(name: Column, prefix: str = PREFIX, suffix: str = SUFFIX) -> Column:
    """The clock in prefix<clock>suffix: the number before the first _ or - between them; null for another name."""
    found = F.regexp_extract(name, rf"^\Q{prefix}\E[\x20\x09-\x0D]*\+?(\d+)[^_-]*(?:[_-].*)?\Q{suffix}\E$", 1)
    return F.nullif(found, F.lit("")).try_cast("bigint")


def raw_files(listed: DataFrame, prefix: str = PREFIX, suffix: str = SUFFIX) -> DataFrame:
    """Raw files with their clock, by clock and path."""
    return listed.withColumn("clock", start_clock(F.col("name"), prefix, suffix)).where("clock is not null").orderBy("clock", "path")


def natural(listed: DataFrame, pattern: str) -> DataFrame:
    """By the number that `pattern` finds in the name, then by name; names without one come last."""
    number = F.nullif(F.regexp_extract("name", pattern, 1), F.lit("")).cast("bigint")
    return listed.withColumn("number", number).orderBy(F.col("number").asc_nulls_last(), "name")


def calibrations(listed: DataFrame, extensions: list[str]) -> DataFrame:
    ext = F.lower(F.regexp_extract("name", r"(\.[^.]+)$", 1))
    return natural(listed.where(ext.isin([e.lower() for e in extensions])), r"(\d+)\.[^.]+$")


def singles_parts(listed: DataFrame) -> DataFrame:
    """Part files, _partNNNNN or a number at the end."""
    return natural(listed, r"(?:_part|_)(\d+)\.[^.]+$")
