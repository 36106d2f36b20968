"""Singles tables and wire chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SINGLE, require_columns


def read_singles(spark: SparkSession, path: str) -> DataFrame:
    """Singles from a table; a missing energy column, or a null, is 0. Other missing columns are an error."""
    df = require_columns(spark.read.parquet(path), ["channel", "crystal", "time_100fs"])
    energy = F.coalesce(F.col("energy"), F.lit(0.0)) if "energy" in df.columns else F.lit(0.0)
    return df.withColumn("energy", energy.cast("float")).select(*[F.col(f.name).cast(f.dataType) for f in SINGLE], *[c for c in df.columns if c not in SINGLE.fieldNames()])


def explode_chunks(chunks: DataFrame) -> DataFrame:
    """A row per single of each chunk."""
    rest = [c for c in chunks.columns if c != "singles"]
    return chunks.select(*rest, F.inline("singles"))


def slice_segments(messages: DataFrame) -> DataFrame:
    """Chunks of batched messages: metas (chunk_id, clock_ms, duration_ms, singles_offset, singles_count) cut the
    message's singles; a slice beyond them raises."""
    m = messages.withColumn("m", F.explode("metas"))
    ok = F.col("m.singles_offset") + F.col("m.singles_count") <= F.size("singles")
    part = F.when(ok, F.slice("singles", F.col("m.singles_offset") + 1, F.col("m.singles_count"))).otherwise(F.raise_error(F.lit("INVALID_ARGUMENT: slice beyond the message")))
    return m.select("node_id", "m.chunk_id", "m.clock_ms", "m.duration_ms", part.alias("singles"))
