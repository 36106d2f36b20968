"""What the text operators share: shared-folder tables, skew-safe joins, null handling."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException
from pyspark.sql.window import Window

from ..storage import shared_path, table  # noqa: F401  what the operators take from here

#: White space of the contracts, as a character class body.
SPACE = r"\x20\x09-\x0D"
#: One run of anything else is a word.
WORD = rf"[^{SPACE}]+"


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """A file system that Python can use for a path as Spark writes it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_or_empty(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    """A side table that may be missing from a folder; missing counts as empty."""
    try:
        return read(spark, sf_dir, name)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def free(df: DataFrame, name: str) -> str:
    """name, or name with underscores, so that it clashes with no column of df."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def rekey(c: Column, kind: str) -> Column:
    """The same value as an expression of which the planner knows nothing. An aggregate joined on such a key gets
    an exchange of its own, so adaptive execution may split a hot key on the other side of the join."""
    if kind == "string":
        return F.concat(c, F.lit(""))
    return F.when(c.isNotNull(), c)


def attach(df: DataFrame, small: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Joins aggregates back to their rows by null-safe keys; both sides have plain exchanges, which adaptive
    execution splits where a key is hot."""
    kinds = dict(small.dtypes)
    right = small.select(*[rekey(F.col(k), kinds[k]).alias(f"__{k}") for k in keys], *[c for c in small.columns if c not in keys])
    on = None
    for k in keys:
        c = df[k].eqNullSafe(right[f"__{k}"])
        on = c if on is None else on & c
    return df.join(right, on, how).drop(*[f"__{k}" for k in keys])


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, which gives freed memory back to the machine when its task ends: Python workers stay alive between tasks,
    and beside a full heap what they still hold counts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
        if trim:
            trim(0)

    return task


def blocks_for(total: int, each: int) -> int:
    return max(1, math.ceil(total / each))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2: such rows are never learnt from. A null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4) == 2


def row_key(text: Column) -> Column:
    """What tells rows of one id apart: 64 bits of the text as it is."""
    return F.xxhash64(text.cast("string"))


def without(docs: DataFrame, gone: DataFrame, twice: DataFrame, text: str, doc_id: str) -> DataFrame:
    """docs without the rows whose (id, row_key) is in gone, and with one row of each that is in twice; both have columns
    i and k. Ids are null-safe. Of rows that are told apart by other columns only, the first as JSON stays."""
    i, k, n = free(docs, "i"), free(docs, "k"), free(docs, "n")

    def has(df: DataFrame, these: DataFrame, how: str) -> DataFrame:
        t = these.select(F.col("i").alias(i), F.col("k").alias(k))
        return df.join(t, df[doc_id].cast("bigint").eqNullSafe(t[i]) & (row_key(df[text]) == t[k]), how)

    rest = has(docs, gone, "left_anti")
    if twice.isEmpty():
        return rest
    one = Window.partitionBy(F.col(doc_id).cast("bigint"), row_key(F.col(text))).orderBy(F.to_json(F.struct(*docs.columns)))
    again = has(rest, twice, "left_semi").withColumn(n, F.row_number().over(one)).where(F.col(n) == 1).drop(n)
    return has(rest, twice, "left_anti").unionByName(again)
