"""Views of the driver's tables as detector data. Times of these views are in microseconds since 2024."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def singles(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select(
        F.col("event_id").alias("id"), (F.col("user_id") % 2).cast("int").alias("node_id"), (F.col("user_id") % 12).cast("int").alias("channel"), (F.col("event_id") % 676).cast("int").alias("crystal"), F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, ts)").alias("t"), F.col("value").alias("energy")
    )


SINGLES = "SELECT event_id AS id, (user_id % 2)::INT AS node_id, (user_id % 12)::INT AS channel, (event_id % 676)::INT AS crystal, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS t, value AS energy FROM events"


def chunks(spark: SparkSession, d: str) -> DataFrame:
    return singles(spark, d).groupBy("node_id", F.expr("id div 100").alias("chunk_id")).agg(F.min("t").alias("min_t"), F.max("t").alias("max_t"), F.count(F.lit(1)).alias("n")).withColumn("clock_ms", F.expr("min_t div 1000"))


CHUNKS = f"SELECT node_id, id // 100 AS chunk_id, min(t) AS min_t, max(t) AS max_t, count(*) AS n, min(t) // 1000 AS clock_ms FROM ({SINGLES}) GROUP BY ALL"


def packets(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select(F.expr("doc_id div 50").alias("segment_id"), (F.col("doc_id") % 50).alias("packet_idx"), (F.col("doc_id") % 48).cast("int").alias("channel"), F.col("n_chars").alias("length"))


PACKETS = "SELECT doc_id // 50 AS segment_id, doc_id % 50 AS packet_idx, (doc_id % 48)::INT AS channel, n_chars AS length FROM documents"


def segments(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select((F.col("o_custkey") % 4).alias("file_index"), F.col("o_orderkey").alias("segment_index"), (F.col("o_orderkey") * 3 + F.col("o_custkey") % 7).alias("start_ms"), (1 + F.col("o_custkey") % 20).alias("duration_ms"))


SEGMENTS = "SELECT o_custkey % 4 AS file_index, o_orderkey AS segment_index, o_orderkey * 3 + o_custkey % 7 AS start_ms, 1 + o_custkey % 20 AS duration_ms FROM orders"


def chunk_log(spark: SparkSession, d: str) -> DataFrame:
    n = F.expr("event_id div 4")
    return read(spark, d, "events").select((F.col("event_id") % 4).alias("node"), F.col("event_id").alias("arrival"), (n + F.when(n % 97 == 50, 3).otherwise(0)).alias("chunk_id"), (F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, ts)") - F.when(F.col("event_id") % 41 == 7, 3600000000).otherwise(0)).alias("min_time"))


CHUNK_LOG = "SELECT event_id % 4 AS node, event_id AS arrival, event_id // 4 + CASE WHEN (event_id // 4) % 97 = 50 THEN 3 ELSE 0 END AS chunk_id, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') - CASE WHEN event_id % 41 = 7 THEN 3600000000 ELSE 0 END AS min_time FROM events"


def manifest(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    prepare = o.select((F.col("o_orderkey") * 2).alias("line_no"), F.lit("prepare").alias("type"), F.col("o_orderkey").alias("segment_id"), (F.col("o_orderkey") * 3).alias("clock_ms"), (1 + F.col("o_custkey") % 20).alias("duration_ms"), (F.col("o_orderkey") % 4).cast("int").alias("shard_id"), F.concat(F.lit("shard_"), (F.col("o_orderkey") % 4).cast("string")).alias("file"))
    commit = o.where("o_orderstatus = 'F'").select((F.col("o_orderkey") * 2 + 1).alias("line_no"), F.lit("commit").alias("type"), F.col("o_orderkey").alias("segment_id"), F.lit(None).cast("bigint").alias("clock_ms"), F.lit(None).cast("bigint").alias("duration_ms"), F.lit(None).cast("int").alias("shard_id"), F.lit(None).cast("string").alias("file"))
    return prepare.unionByName(commit)


def intervals(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("idx"), (F.col("o_orderkey") * 1000000).alias("start_ns"), (F.col("o_orderkey") * 1000000 + (1 + F.col("o_custkey") % 10) * 1000000).alias("end_ns"), ((F.col("o_custkey") % 21 - 10) * 1000000).alias("offset_ns"))


INTERVALS = "SELECT o_orderkey AS idx, o_orderkey * 1000000 AS start_ns, o_orderkey * 1000000 + (1 + o_custkey % 10) * 1000000 AS end_ns, (o_custkey % 21 - 10) * 1000000 AS offset_ns FROM orders"
CALIBRATED = f"SELECT idx, start_ns + offset_ns AS start_ns, end_ns + offset_ns AS end_ns FROM ({INTERVALS})"


def sync_samples(spark: SparkSession, d: str) -> DataFrame:
    t1 = F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, ts)") * 1000
    t2 = t1 + 1000 * (F.col("event_id") % 50)
    return read(spark, d, "events").select(F.col("user_id").alias("client"), F.col("event_id").alias("seq"), t1.alias("t1"), t2.alias("t2"), (t2 + 1000).alias("t3"), (t1 + 1000 * (2 + F.col("event_id") % 90)).alias("t4"))


SYNC = "SELECT user_id AS client, event_id AS seq, t1, t1 + 1000 * (event_id % 50) AS t2, t1 + 1000 * (event_id % 50) + 1000 AS t3, t1 + 1000 * (2 + event_id % 90) AS t4 FROM (SELECT *, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) * 1000 AS t1 FROM events)"
NTP = f"SELECT *, ((t2 - t1) + (t3 - t4)) // 2 AS offset_ns, (t4 - t1) - (t3 - t2) AS rtt_ns FROM ({SYNC})"


def node_status(spark: SparkSession, d: str) -> DataFrame:
    """By node a counter of events and one of milli-units of value, both cumulative."""
    from pyspark.sql.window import Window

    s = singles(spark, d).select("node_id", "id", "t", F.round(F.col("energy") * 1000).cast("bigint").alias("milli"))
    w = Window.partitionBy("node_id").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    return s.withColumns({"packets": F.count(F.lit(1)).over(w), "bytes": F.sum("milli").over(w)})


STATUS = f"SELECT node_id, id, t, count(*) OVER w AS packets, (sum(round(energy * 1000)::BIGINT) OVER w)::BIGINT AS bytes FROM ({SINGLES}) WINDOW w AS (PARTITION BY node_id ORDER BY id ROWS UNBOUNDED PRECEDING)"
