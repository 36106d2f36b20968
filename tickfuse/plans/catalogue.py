"""Queries by name over the driver's tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codec, scalars
from ..operators import clock, control, filters, folds, manifest, ordering, sequence, stats
from ..operators import interval_join as ij
from . import views as v

#: Coincidence window, delay and energy cut of these views (ticks are microseconds).
W, D, LOW, HIGH, CHANNELS = 60_000_000, 3_600_000_000, 20.0, 200.0, 12
MARGIN, ROLL, LATENCY_GATE = 3_600_000_000, 20_000, 50_000_000

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def cut(spark: SparkSession, d: str) -> DataFrame:
    return filters.energy_window(v.singles(spark, d), LOW, HIGH)


CUT = f"SELECT * FROM ({v.SINGLES}) WHERE energy BETWEEN {LOW} AND {HIGH}"
SEP = f"least(abs(a.channel - b.channel), {CHANNELS} - abs(a.channel - b.channel))"
PAIR = "a.id AS id1, a.channel AS channel1, a.crystal AS crystal1, a.t AS t1, b.id AS id2, b.channel AS channel2, b.crystal AS crystal2, b.t AS t2"
PROMPT = f"SELECT {PAIR}, b.t - a.t AS dt FROM s a JOIN s b ON b.t BETWEEN a.t AND a.t + {W} AND (b.t > a.t OR b.id > a.id) AND {SEP} >= 1"
DELAY = f"SELECT {PAIR}, b.t - a.t - {D} AS dt FROM s a JOIN s b ON b.t BETWEEN a.t + {D - W} AND a.t + {D + W} AND {SEP} >= 1"


@query(f"SELECT id, node_id, channel, crystal, t, energy FROM ({CUT})")
def energy_window(spark, d):
    return cut(spark, d)


@query(f"WITH s AS ({CUT}) {PROMPT}")
def prompt_pairs(spark, d):
    return ij.prompt_pairs(cut(spark, d), W, CHANNELS)


@query(f"WITH s AS ({CUT}) {DELAY}")
def delay_pairs(spark, d):
    return ij.delay_pairs(cut(spark, d), W, D, CHANNELS)


_SEPSQL = f"least(abs(channel1 - channel2), {CHANNELS} - abs(channel1 - channel2))"


def _hist_sql(pairs: str) -> str:
    return f"WITH s AS ({CUT}), p AS ({pairs}) SELECT r.sep::BIGINT AS sep, count(p.id1)::BIGINT AS n FROM range({CHANNELS // 2 + 1}) r(sep) LEFT JOIN p ON {_SEPSQL} = r.sep GROUP BY r.sep"


@query(_hist_sql(PROMPT))
def prompt_sep_hist(spark, d):
    return ij.separation_histogram(prompt_pairs(spark, d), CHANNELS)


@query(f"SELECT 'delay' AS kind, sum(n)::BIGINT AS pairs, round(sum(CASE WHEN sep = {CHANNELS // 2} THEN n ELSE 0 END) / sum(n), 9) AS opposite_ratio, round(stddev_pop(n) / avg(n), 9) AS cv FROM ({_hist_sql(DELAY)})")
def delay_cv(spark, d):
    h = ij.distribution(ij.separation_histogram(delay_pairs(spark, d), CHANNELS), CHANNELS, "delay")
    return h.withColumns({c: F.round(c, 9) for c in ("opposite_ratio", "cv")})


@query(f"SELECT sep, n FROM ({_hist_sql(DELAY)}) ORDER BY n DESC, sep LIMIT 5")
def top_bins(spark, d):
    return ij.top_bins(ij.separation_histogram(delay_pairs(spark, d), CHANNELS))


@query(f"WITH h AS ({_hist_sql(PROMPT)}), t AS (SELECT * FROM h ORDER BY n DESC, sep LIMIT 2) SELECT coalesce(bool_or(sep = 3 AND n >= 0.05 * (SELECT sum(n) FROM h)), false) AS peak FROM t")
def prompt_peak(spark, d):
    return ij.has_peak(prompt_sep_hist(spark, d), 3, 0.05)


@query(f"WITH s AS ({CUT}), p AS ({PROMPT}) SELECT least(channel1, channel2) AS low, greatest(channel1, channel2) AS high, count(*)::BIGINT AS n, true AS in_range FROM p GROUP BY 1, 2")
def pair_matrix(spark, d):
    return ij.pair_matrix(prompt_pairs(spark, d), CHANNELS)


@query(f"WITH s AS ({CUT}), p AS ({DELAY}) SELECT count(*)::BIGINT AS checked, count(*) FILTER (dt < 0)::BIGINT AS negative, count(*) FILTER (abs(dt) > {W})::BIGINT AS over_window, min(dt) AS min_dt, max(dt) AS max_dt FROM p")
def dt_stats(spark, d):
    return ij.dt_stats(delay_pairs(spark, d), W)


@query(f"WITH s AS ({CUT}), p AS ({PROMPT}), e AS (SELECT id1 AS id FROM p UNION ALL SELECT id2 FROM p), m AS (SELECT id FROM e GROUP BY id HAVING count(*) > 1) SELECT * FROM p WHERE id1 NOT IN (SELECT id FROM m) AND id2 NOT IN (SELECT id FROM m)")
def unique_pairs(spark, d):
    return ij.drop_multiples(prompt_pairs(spark, d))


@query(f"WITH s AS (SELECT *, t // 86400000000 AS batch_id FROM ({CUT})) {PROMPT} AND a.batch_id = b.batch_id")
def batch_pairs(spark, d):
    return ij.prompt_pairs(cut(spark, d).withColumn("batch_id", F.expr("t div 86400000000")), W, CHANNELS, scope=["batch_id"])


@query(f"WITH s AS ({CUT}), p AS ({PROMPT}), q AS ({DELAY}) SELECT *, 'prompt' AS kind FROM p UNION ALL SELECT *, 'delay' FROM q")
def coincidences(spark, d):
    return ij.coincidences(cut(spark, d), W, D, CHANNELS)


@query(f"WITH c AS (SELECT n_nationkey AS channel, row_number() OVER (ORDER BY n_nationkey) - 1 AS local FROM nation WHERE n_nationkey % 2 = 0) SELECT s.id, s.channel, c.local AS local_channel, s.t FROM ({v.SINGLES}) s JOIN c USING (channel)")
def assigned_channels(spark, d):
    chosen = v.read(spark, d, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("channel"))
    kept = filters.assigned_channels(v.singles(spark, d), chosen)
    local = sequence.global_number(chosen, "channel", 1000, "local_channel")
    return kept.join(local, "channel").select("id", "channel", "local_channel", "t")


@query(f"SELECT count(*)::BIGINT AS total, count(*) FILTER (energy BETWEEN {LOW} AND {HIGH})::BIGINT AS in_ev, count(*) FILTER (energy BETWEEN {LOW / 1000} AND {HIGH / 1000})::BIGINT AS in_kev, min(energy) AS min_energy, max(energy) AS max_energy, count(*) FILTER (energy BETWEEN {LOW} AND {HIGH}) / count(*) AS ratio FROM ({v.SINGLES})")
def energy_stats(spark, d):
    return stats.energy_stats(v.singles(spark, d), LOW, HIGH)


@query("SELECT count(*)::BIGINT AS kept FROM events WHERE value BETWEEN 20 AND 200")
def switched_window(spark, d):
    s = v.singles(spark, d)
    low, high = filters.effective_window(s, LOW * 1000, HIGH * 1000)
    return filters.energy_window(s, low, high).agg(F.count(F.lit(1)).alias("kept"))


@query(f"SELECT node_id, round(avg(energy), 6) AS mean, min(energy) AS least, max(energy) AS greatest, 0::BIGINT AS non_finite FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY id) AS r FROM ({v.SINGLES})) WHERE r <= 500 GROUP BY node_id")
def sampled_energy(spark, d):
    return stats.sampled_energy(v.singles(spark, d), "node_id", "id", 500).withColumn("mean", F.round("mean", 6))


_WM = f"SELECT count(*)::BIGINT AS nodes, CASE WHEN count(*) < 2 OR min(last) <= {MARGIN} THEN 0 ELSE min(last) - {MARGIN} END AS watermark FROM (SELECT node_id, max(t) AS last FROM ({v.SINGLES}) GROUP BY node_id)"


@query(_WM)
def node_watermark(spark, d):
    return stats.node_watermark(v.singles(spark, d), "node_id", "t", MARGIN, 2)


@query(f"SELECT s.* FROM ({v.SINGLES}) s, ({_WM}) w WHERE s.t <= w.watermark")
def extract_before_watermark(spark, d):
    mark = node_watermark(spark, d).first()["watermark"]
    return ordering.split_at(v.singles(spark, d), mark)[0]


_HALF = 15 * 86_400_000_000


@query(f"SELECT node_id, chunk_id, min_t, max_t, n::BIGINT AS n, clock_ms FROM (SELECT *, bool_and(max_t <= {_HALF}) OVER (PARTITION BY node_id ORDER BY chunk_id ROWS UNBOUNDED PRECEDING) AS ok FROM ({v.CHUNKS})) WHERE ok")
def complete_chunks(spark, d):
    return ordering.complete_chunks(v.chunks(spark, d), "node_id", ["chunk_id"], "max_t", _HALF)


@query(f"SELECT node_id, chunk_id, min_t, max_t, n::BIGINT AS n, clock_ms FROM ({v.CHUNKS})")
def chunk_ranges(spark, d):
    s = v.singles(spark, d).withColumn("chunk_id", F.expr("id div 100"))
    return stats.chunk_ranges(s, ["node_id", "chunk_id"]).withColumn("clock_ms", F.expr("min_t div 1000"))


@query(f"SELECT node, arrival, chunk_id, min_time, prev_id, chunk_id - prev_id - 1 AS gap FROM (SELECT *, lag(chunk_id) OVER (PARTITION BY node ORDER BY arrival) AS prev_id FROM ({v.CHUNK_LOG})) WHERE chunk_id <> prev_id + 1")
def chunk_gaps(spark, d):
    return sequence.sequence_gaps(v.chunk_log(spark, d), "node", "chunk_id", "arrival")


@query(f"SELECT node, count(*)::BIGINT AS chunks, count(*) FILTER (m > min_time)::BIGINT AS reordered FROM (SELECT *, max(min_time) OVER (PARTITION BY node ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM ({v.CHUNK_LOG})) GROUP BY node")
def chunk_reorders(spark, d):
    return sequence.reorders(v.chunk_log(spark, d), "node", "min_time", "arrival")


_OFF = 'coalesce(sum(length) OVER (PARTITION BY segment_id ORDER BY packet_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT'


@query(f"SELECT *, {_OFF} AS packet_offset FROM ({v.PACKETS}) WHERE length BETWEEN 200 AND 4000")
def packet_offsets(spark, d):
    return sequence.exclusive_sum(filters.packet_length(v.packets(spark, d), 200, 4000), "length", ["segment_id"], ["packet_idx"], "packet_offset")


@query(f"SELECT *, {_OFF} AS new_offset FROM ({v.PACKETS}) WHERE channel IN (1, 5, 17)")
def channel_extract(spark, d):
    return filters.extract_channels(v.packets(spark, d), [1, 5, 17])


@query(f"SELECT segment_id, packet_idx, o - first_value(o) OVER (PARTITION BY segment_id ORDER BY packet_idx) AS rebased FROM (SELECT segment_id, packet_idx, (coalesce(sum(length) OVER (ORDER BY segment_id, packet_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS o FROM ({v.PACKETS}))")
def rebased_offsets(spark, d):
    p = v.packets(spark, d).withColumn("n", F.col("segment_id") * 50 + F.col("packet_idx"))
    p = sequence.ranged_sum(p, F.col("length"), "n", 5000, "o")
    return sequence.rebase_offsets(p, ["segment_id"], "packet_idx", "o", "rebased").select("segment_id", "packet_idx", "rebased")


@query(f"SELECT count(*) FILTER (channel BETWEEN 8 AND 23)::BIGINT AS sent, count(*) FILTER (channel NOT BETWEEN 8 AND 23)::BIGINT AS skipped FROM ({v.PACKETS})")
def replay_counts(spark, d):
    return filters.replay_filter(v.packets(spark, d), 8, 16)[1]


@query(f"SELECT DISTINCT channel FROM ({v.PACKETS}) WHERE channel NOT IN (SELECT n_nationkey FROM nation)")
def unknown_channels(spark, d):
    known = v.read(spark, d, "nation").select(F.col("n_nationkey").alias("channel"))
    return filters.unknown_channels(v.packets(spark, d), known)


@query(f"""WITH RECURSIVE p AS (SELECT channel % 8 AS shard, segment_id * 50 + packet_idx AS n, length + 32 AS size, row_number() OVER (PARTITION BY channel % 8 ORDER BY segment_id, packet_idx) AS r FROM ({v.PACKETS})),
f(shard, n, r, size, file_seq, used) AS (SELECT shard, n, r, size, 0, size FROM p WHERE r = 1
UNION ALL SELECT p.shard, p.n, p.r, p.size, CASE WHEN f.used > 0 AND f.used + p.size > {ROLL} THEN f.file_seq + 1 ELSE f.file_seq END, CASE WHEN f.used > 0 AND f.used + p.size > {ROLL} THEN p.size ELSE f.used + p.size END FROM f JOIN p ON p.shard = f.shard AND p.r = f.r + 1)
SELECT shard, n, size, file_seq FROM f""")
def rolling_files(spark, d):
    p = v.packets(spark, d).select((F.col("channel") % 8).alias("shard"), (F.col("segment_id") * 50 + F.col("packet_idx")).alias("n"), (F.col("length") + 32).alias("size"))
    return folds.rolling_files(p, ["shard"], ["n"], "size", ROLL)


@query(f"""WITH RECURSIVE s AS (SELECT start_ms, start_ms + duration_ms AS end_ms, row_number() OVER (ORDER BY start_ms, segment_index) AS r FROM ({v.SEGMENTS})),
f(r, anchor, end_ms) AS (SELECT r, start_ms, end_ms FROM s WHERE r = 1
UNION ALL SELECT s.r, CASE WHEN s.start_ms > f.anchor + 5 THEN s.start_ms ELSE f.anchor END, s.end_ms FROM f JOIN s ON s.r = f.r + 1)
SELECT anchor AS group_start, max(end_ms) AS group_end, count(*)::BIGINT AS members FROM f GROUP BY anchor""")
def segment_groups(spark, d):
    s = v.segments(spark, d).withColumn("end_ms", F.col("start_ms") + F.col("duration_ms"))
    return folds.anchored_groups(s, "start_ms", "end_ms", "segment_index", 5, 100_000)


@query(f"SELECT min(start_ms) AS first_ms, max(start_ms + duration_ms) AS last_ms, count(*)::BIGINT AS segments, sum(duration_ms)::BIGINT AS total_ms FROM ({v.SEGMENTS})")
def segment_inventory(spark, d):
    return stats.inventory(v.segments(spark, d))


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 400 AS chunk_id, (row_number() OVER (ORDER BY o_orderkey) - 1) % 400 AS chunk_offset FROM orders")
def fixed_chunks(spark, d):
    return sequence.fixed_chunks(v.read(spark, d, "orders").select("o_orderkey"), "o_orderkey", 400)


@query("SELECT n_nationkey, n_name, node_no, row_number() OVER (PARTITION BY node_no ORDER BY n_nationkey) - 1 AS local_idx, 100 + 16 * (n_nationkey::BIGINT) AS base_port FROM (SELECT *, (ntile(4) OVER (ORDER BY n_nationkey) - 1) AS node_no FROM nation)")
def even_partition(spark, d):
    p = sequence.even_partition(v.read(spark, d, "nation").select("n_nationkey", "n_name"), ["n_nationkey"], 4)
    return p.withColumn("base_port", sequence.stepped(F.col("n_nationkey").cast("bigint"), 100, 16, 65535))


_SHARE = "CASE WHEN least({left} // {parts}, 7) = 0 THEN {left} ELSE least({left} // {parts}, 7) END"


@query(f"""WITH p AS (SELECT segment_id, packet_idx, row_number() OVER (PARTITION BY segment_id ORDER BY packet_idx) - 1 AS r, count(*) OVER (PARTITION BY segment_id) AS n FROM ({v.PACKETS}) WHERE length > 400),
a AS (SELECT *, {_SHARE.format(left="n", parts=3)} AS e1 FROM p), b AS (SELECT *, e1 + {_SHARE.format(left="(n - e1)", parts=2)} AS e2 FROM a)
SELECT segment_id, packet_idx, CASE WHEN r < e1 THEN 0 WHEN r < e2 THEN 1 ELSE 2 END::INT AS part FROM b""")
def tile_split(spark, d):
    p = filters.packet_length(v.packets(spark, d), 401, 1 << 30)
    return sequence.tile_split(p, ["segment_id"], ["packet_idx"], 3, F.lit(7)).select("segment_id", "packet_idx", "part")


@query("SELECT s_suppkey, s_nationkey, CASE WHEN n_nationkey IS NULL THEN 1024 ELSE 900 + n_nationkey END AS max_packet, CASE WHEN n_nationkey IS NULL THEN 512 ELSE 512 END AS min_packet FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 12) ON s_nationkey = n_nationkey")
def node_overrides(spark, d):
    base = v.read(spark, d, "supplier").select("s_suppkey", "s_nationkey", F.lit(1024).alias("max_packet"), F.lit(512).alias("min_packet"))
    over = v.read(spark, d, "nation").where("n_nationkey < 12").select(F.col("n_nationkey").alias("s_nationkey"), (900 + F.col("n_nationkey")).alias("max_packet"))
    return control.node_overrides(base, over, "s_nationkey", ["max_packet"])


@query("""WITH t AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 > 0 THEN s_suppkey % 3 * 700 ELSE 1024 END AS min_packet, CASE WHEN s_suppkey % 5 > 0 THEN s_suppkey % 5 * 500 ELSE 1024 END AS max_packet, least(65000 + s_suppkey, 65535) AS port, CASE WHEN s_suppkey % 4 > 0 THEN greatest(s_suppkey % 4 * 4, 10) ELSE 1000 END AS time_switch_ms, CASE WHEN s_suppkey % 2 = 0 THEN 4294967296 ELSE 65536 END AS max_buffer, s_suppkey % 7 AS channels FROM supplier)
SELECT *, CASE WHEN max_packet < min_packet THEN 'max_packet below min_packet' WHEN channels = 0 THEN 'no channels' END AS fault FROM t""")
def task_defaults(spark, d):
    k = F.col("s_suppkey")
    t = v.read(spark, d, "supplier").select("s_suppkey", (k % 3 * 700).alias("min_packet"), (k % 5 * 500).alias("max_packet"), (65000 + k).alias("port"), (k % 4 * 4).alias("time_switch_ms"), (k % 2 * 65536).alias("max_buffer"), (k % 7).alias("channels"))
    return control.task_defaults(t, strict=False)


@query("SELECT o_orderkey AS segment_id, o_orderkey * 3 AS clock_ms, 1 + o_custkey % 20 AS duration_ms, (o_orderkey % 4)::INT AS shard_id, 'shard_' || (o_orderkey % 4) AS file FROM orders WHERE o_orderstatus = 'F'")
def manifest_committed(spark, d):
    return manifest.committed(v.manifest(spark, d))


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1)::BIGINT % 4 AS round_robin, o_custkey % 4 AS by_channel FROM orders")
def shard_assignment(spark, d):
    o = v.read(spark, d, "orders").select("o_orderkey", "o_custkey")
    o = manifest.assign_shards(o, 4, "RoundRobin", "o_orderkey", "o_custkey").withColumnRenamed("shard_id", "round_robin")
    return manifest.assign_shards(o, 4, "HashByChannel", "o_orderkey", "o_custkey").select("o_orderkey", F.col("round_robin").cast("bigint").alias("round_robin"), F.col("shard_id").cast("bigint").alias("by_channel"))


@query("SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN 'spilled' ELSE 'written' END AS outcome FROM orders")
def queue_outcomes(spark, d):
    o = v.read(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 10 == 0).alias("full"))
    return manifest.queue_outcomes(o, "full", True, True).select("o_orderkey", "outcome")


@query("SELECT o_orderdate AS clock FROM (SELECT DISTINCT o_orderdate, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey) GROUP BY o_orderdate HAVING count(*) = (SELECT count(DISTINCT c_mktsegment) FROM customer)")
def clock_intersection(spark, d):
    o, c = v.read(spark, d, "orders"), v.read(spark, d, "customer")
    n = c.select("c_mktsegment").distinct().count()
    files = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderdate").alias("clock"), "c_mktsegment")
    return manifest.common_clocks(files, "clock", "c_mktsegment", n)


@query(f"SELECT client, seq, offset_ns, rtt_ns FROM ({v.NTP})")
def ntp_offset(spark, d):
    return clock.ntp(v.sync_samples(spark, d)).select("client", "seq", "offset_ns", "rtt_ns")


@query(f"SELECT client, arg_min(offset_ns, struct_pack(a := rtt_ns, b := seq)) AS offset_ns, min(rtt_ns) AS rtt_ns FROM ({v.NTP}) GROUP BY client")
def min_rtt_offset(spark, d):
    return clock.min_rtt_offset(v.sync_samples(spark, d), "client", "seq")


@query(f"SELECT client, samples, o[samples // 2 + 1] AS offset_ns, rtt // samples AS mean_rtt_ns FROM (SELECT client, count(*)::BIGINT AS samples, list_sort(list(offset_ns)) AS o, sum(rtt_ns)::BIGINT AS rtt FROM (SELECT *, row_number() OVER (PARTITION BY client ORDER BY seq) AS r FROM ({v.NTP})) WHERE r <= 5 GROUP BY client)")
def median_offset(spark, d):
    return clock.median_offset(v.sync_samples(spark, d), "client", "seq")


_LAST = "WINDOW w AS (PARTITION BY client ORDER BY seq ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)"


@query(f"SELECT client, seq, s // kept AS avg_offset, kept FROM (SELECT client, seq, (sum(offset_ns) OVER w)::BIGINT AS s, count(*) OVER w AS kept FROM ({v.NTP}) {_LAST})")
def running_offset(spark, d):
    return clock.running_offset(clock.ntp(v.sync_samples(spark, d)), "client", "seq").select("client", "seq", "avg_offset", "kept")


@query(f"SELECT client, seq, round(CASE WHEN n >= 10 AND dt > 0 THEN dof / dt * 1e6 END, 9) AS drift_ppm FROM (SELECT client, seq, count(*) OVER w AS n, offset_ns - first_value(offset_ns) OVER w AS dof, t1 - first_value(t1) OVER w AS dt FROM ({v.NTP}) {_LAST})")
def drift_ppm(spark, d):
    out = clock.drift_ppm(clock.ntp(v.sync_samples(spark, d)), "client", "seq", "t1")
    return out.select("client", "seq", F.round("drift_ppm", 9).alias("drift_ppm"))


@query(f"""WITH RECURSIVE s AS (SELECT client, seq, offset_ns::HUGEINT AS x, row_number() OVER (PARTITION BY client ORDER BY seq) AS r FROM ({v.NTP})),
f(client, seq, r, kept) AS (SELECT client, seq, r, [x] FROM s WHERE r = 1
UNION ALL SELECT s.client, s.seq, s.r, CASE WHEN abs(s.x - trunc(list_sum(f.kept)::DECIMAL(38,0) / len(f.kept))) < 20000 THEN list_append(f.kept, s.x)[-100:] ELSE f.kept END FROM f JOIN s ON s.client = f.client AND s.r = f.r + 1)
SELECT client, seq, trunc(list_sum(kept)::DECIMAL(38,0) / len(kept))::BIGINT AS avg_offset FROM f""")
def gated_offset(spark, d):
    s = clock.ntp(v.sync_samples(spark, d)).select("client", "seq", "offset_ns")
    return folds.gated_mean(s, ["client"], ["seq"], "offset_ns", 100, 20_000).select("client", "seq", "avg_offset")


@query(f"""WITH RECURSIVE s AS (SELECT client, seq, rtt_ns, row_number() OVER (PARTITION BY client ORDER BY seq) AS r FROM ({v.NTP})),
f(client, seq, r, ema) AS (SELECT client, seq, r, 0.3::DOUBLE * rtt_ns FROM s WHERE r = 1
UNION ALL SELECT s.client, s.seq, s.r, 0.7 * f.ema + 0.3 * s.rtt_ns FROM f JOIN s ON s.client = f.client AND s.r = f.r + 1)
SELECT client, seq, round(ema, 3) AS ema FROM f""")
def latency_ema(spark, d):
    s = clock.ntp(v.sync_samples(spark, d)).select("client", "seq", "rtt_ns")
    return folds.ema(s, ["client"], ["seq"], "rtt_ns", start=0.0).select("client", "seq", F.round("ema", 3).alias("ema"))


@query(f"SELECT client, count(*)::BIGINT AS syncs, arg_max(offset_ns, seq) AS offset_ns, max(seq) AS last, least(count(*) / 10.0, 1.0)::DOUBLE AS confidence FROM ({v.NTP}) GROUP BY client")
def client_table(spark, d):
    return clock.client_table(clock.ntp(v.sync_samples(spark, d)), "client", "seq")


def _calibrated(spark, d):
    return clock.calibrate(v.intervals(spark, d)).select("idx", F.col("cal_start_ns").alias("start_ns"), F.col("cal_end_ns").alias("end_ns"))


@query(f"WITH i AS ({v.CALIBRATED}) SELECT a.idx AS idx1, b.idx AS idx2, least(a.end_ns, b.end_ns) - greatest(a.start_ns, b.start_ns) AS overlap_ns FROM i a JOIN i b ON a.idx < b.idx AND a.start_ns < b.end_ns AND b.start_ns < a.end_ns")
def segment_overlap(spark, d):
    return ij.overlaps(_calibrated(spark, d), 10_000_000)


@query(f"WITH i AS ({v.CALIBRATED}) SELECT a.idx AS idx1, b.idx AS idx2 FROM i a JOIN i b ON a.idx < b.idx AND a.start_ns <= b.end_ns + 2000000 AND b.start_ns <= a.end_ns + 2000000")
def should_merge(spark, d):
    return ij.merge_decisions(_calibrated(spark, d), 2_000_000, 10_000_000)


@query(f"SELECT max(t) - min(t) AS spread_ns, CASE WHEN max(t) - min(t) < 1000000 THEN 'excellent' WHEN max(t) - min(t) < 10000000 THEN 'good' ELSE 'acceptable' END AS grade FROM (SELECT start_ns AS t FROM ({v.CALIBRATED}))")
def alignment(spark, d):
    return clock.alignment(_calibrated(spark, d).withColumnRenamed("start_ns", "cal_ns"))


_VSRC = "SELECT p_partkey, ((2 + p_partkey % 3) * 256 + 1 + p_size % 48)::INT AS src FROM part"


@query(f"SELECT p_partkey, src, src // 256 AS ring, src % 256 AS ip, (src // 256 - 2) * 48 + src % 256 - 1 AS detector, CASE WHEN src // 256 + 249 <= 255 THEN (src // 256 + 249) * 256 + src % 256 END AS shifted FROM ({_VSRC})")
def src_channel_decode(spark, d):
    s = v.read(spark, d, "part").select("p_partkey", ((2 + F.col("p_partkey") % 3) * 256 + 1 + F.col("p_size") % 48).cast("int").alias("src"))
    c = F.col("src")
    return s.withColumns({"ring": codec.src_ring(c), "ip": codec.src_ip(c), "detector": codec.src_to_detector(c), "shifted": codec.shift_ring(c, 83)})


_LINE = "SELECT l_orderkey, l_linenumber, (l_partkey % 40000)::INT AS channel, (l_suppkey % 300)::INT AS crystal, l_extendedprice AS energy, l_orderkey * 1000 + l_linenumber AS time_100fs FROM lineitem"
_ENC = f"SELECT *, (((channel // 48 + 2) & 255) * 256 + channel % 48 + 1)::INT AS ip, (crystal // 36 * 37 + crystal % 36 + 1)::INT AS ch, (energy * 0.001)::FLOAT AS vendor_energy, time_100fs::DOUBLE * 0.0001 AS vendor_time FROM ({_LINE}) WHERE channel <= 32767 AND crystal < 288"


def _line_singles(spark, d):
    return v.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 40000).cast("int").alias("channel"), (F.col("l_suppkey") % 300).cast("int").alias("crystal"), F.col("l_extendedprice").alias("energy"), (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("time_100fs"))


@query(f"SELECT l_orderkey, l_linenumber, ip, ch, round(vendor_energy::DOUBLE, 4) AS vendor_energy, round(vendor_time, 4) AS vendor_time FROM ({_ENC})")
def vendor_encode(spark, d):
    e = codec.encode_event(_line_singles(spark, d))
    return e.select("l_orderkey", "l_linenumber", "ip", "ch", F.round(F.col("vendor_energy").cast("double"), 4).alias("vendor_energy"), F.round("vendor_time", 4).alias("vendor_time"))


# A ring has 8 bits, so channels from ring 256 on come back on a lower ring, and not at all where that is below the first.
@query(f"SELECT l_orderkey, l_linenumber, (((channel // 48 + 2) & 255) - 2) * 48 + channel % 48 AS channel, crystal, time_100fs FROM ({_LINE}) WHERE channel <= 32767 AND crystal < 288 AND ((channel // 48 + 2) & 255) >= 2")
def vendor_decode(spark, d):
    e = codec.encode_event(_line_singles(spark, d)).select("l_orderkey", "l_linenumber", "ip", "ch", "vendor_energy", "vendor_time")
    return codec.decode_event(e).select("l_orderkey", "l_linenumber", "channel", "crystal", "time_100fs")


@query("SELECT l_returnflag, l_linestatus, l_linenumber, (sum(CASE WHEN l_quantity > 10 THEN 1 ELSE 0 END) - sum(CASE WHEN l_quantity <= 30 THEN 1 ELSE 0 END))::BIGINT AS surplus FROM lineitem GROUP BY ALL HAVING surplus <> 0")
def multiset_diff(spark, d):
    rows = v.read(spark, d, "lineitem")
    cols = ["l_returnflag", "l_linestatus", "l_linenumber"]
    return stats.multiset_difference(rows.where("l_quantity > 10").select(cols), rows.where("l_quantity <= 30").select(cols))


@query("SELECT l_returnflag, l_linestatus, l_linenumber, count(*)::BIGINT AS n FROM lineitem GROUP BY ALL")
def multiset_histogram(spark, d):
    return stats.multiset(v.read(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber"))


_MIX = f"SELECT (xor({stats.MIX_START}::UHUGEINT, channel::UHUGEINT) * {stats.MIX_PRIME}) % 18446744073709551616 AS h, crystal, t, energy FROM ({v.SINGLES})"
for _c in ("crystal::UHUGEINT", "t::UHUGEINT", "(energy::FLOAT::BIT::UINTEGER)::UHUGEINT"):
    _MIX = f"SELECT ((xor(h, {_c}) * {stats.MIX_PRIME}) % 18446744073709551616)::UHUGEINT AS h, crystal, t, energy FROM ({_MIX})"
DIGEST = f"SELECT count(*)::BIGINT AS total, (CASE WHEN x >= 9223372036854775808 THEN x::HUGEINT - 18446744073709551616 ELSE x::HUGEINT END)::BIGINT AS checksum FROM (SELECT h, bit_xor(h) OVER () AS x FROM ({_MIX})) GROUP BY x"


@query(DIGEST)
def digest(spark, d):
    return stats.digest(v.singles(spark, d), ("channel", "crystal", "t", "energy"))


@query(f"SELECT file_index, count(*)::BIGINT AS segments, sum(duration_ms)::BIGINT AS duration_ms, min(start_ms) AS first_clock, max(start_ms) AS last_clock, max(start_ms) - min(start_ms) + arg_max(duration_ms, struct_pack(a := start_ms, b := segment_index)) AS span_ms FROM ({v.SEGMENTS}) GROUP BY file_index")
def file_info(spark, d):
    return stats.file_info(v.segments(spark, d), "file_index")


@query(f"SELECT node_id, id, CASE WHEN dt > 0 THEN round((packets - p0) / dt, 9) END AS packets_per_s, CASE WHEN dt > 0 THEN round((bytes - b0) / dt, 6) END AS bytes_per_s FROM (SELECT *, (t - lag(t) OVER w) / 1e6::DOUBLE AS dt, lag(packets) OVER w AS p0, lag(bytes) OVER w AS b0 FROM ({v.STATUS}) WINDOW w AS (PARTITION BY node_id ORDER BY id))")
def counter_rates(spark, d):
    r = sequence.counter_rates(v.node_status(spark, d), "node_id", "t", ["packets", "bytes"])
    return r.select("node_id", "id", F.round("packets_per_s", 9).alias("packets_per_s"), F.round("bytes_per_s", 6).alias("bytes_per_s"))


@query(f"SELECT node_id, count(*)::BIGINT AS chunks, sum(n)::BIGINT AS singles FROM ({v.CHUNKS}) GROUP BY ROLLUP (node_id)")
def status_rollup(spark, d):
    return stats.status_rollup(v.singles(spark, d).withColumn("chunk", F.expr("id div 100")), "node_id", "chunk")


@query(f"SELECT node_id, arg_max(id, struct_pack(a := t, b := id)) AS id, max(t) AS t FROM ({v.SINGLES}) GROUP BY node_id")
def node_snapshot(spark, d):
    return control.snapshot(v.singles(spark, d).select("node_id", "id", "t"), "node_id", "t", "id")


_CMD = "SELECT conv_id, turn, 'a=stale;;bad;=none;a=' || role || '; b = ' || length(text) || ';n= -' || turn || 'x' AS cmd FROM conversations"


@query(f"""WITH i AS (SELECT conv_id, turn, unnest(string_split(cmd, ';')) AS item, generate_subscripts(string_split(cmd, ';'), 1) AS pos FROM ({_CMD})),
p AS (SELECT conv_id, turn, pos, substr(item, 1, instr(item, '=') - 1) AS k, substr(item, instr(item, '=') + 1) AS x FROM i WHERE instr(item, '=') > 1),
l AS (SELECT conv_id, turn, k, arg_max(x, pos) AS x FROM p GROUP BY ALL)
SELECT conv_id, turn, max(x) FILTER (k = 'a') AS a, max(x) FILTER (k = 'b') AS b_trimmed, max(x) FILTER (k = ' b ') AS b, CASE WHEN turn = 0 THEN 0 ELSE 18446744073709551616 - turn END::DECIMAL(20, 0) AS n, 7::DECIMAL(20, 0) AS none FROM l GROUP BY conv_id, turn""")
def kv_command_parse(spark, d):
    cmd = F.concat(F.lit("a=stale;;bad;=none;a="), F.col("role"), F.lit("; b = "), F.length("text").cast("string"), F.lit(";n= -"), F.col("turn").cast("string"), F.lit("x"))
    m = scalars.parse_command(cmd)
    get = lambda k: F.try_element_at(m, F.lit(k))
    return v.read(spark, d, "conversations").select("conv_id", "turn", get("a").alias("a"), get("b").alias("b_trimmed"), get(" b ").alias("b"), scalars.parse_uint64(m, "n", 7).alias("n"), scalars.parse_uint64(m, "a", 7).alias("none"))


@query("SELECT o_orderkey, list_filter(regexp_split_to_array(o_orderpriority || '; ' || o_orderstatus || ',, ,x' , '[,;]'), lambda x: x <> '') AS parts FROM orders")
def list_split(spark, d):
    return v.read(spark, d, "orders").select("o_orderkey", scalars.split_list(F.concat("o_orderpriority", F.lit("; "), "o_orderstatus", F.lit(",, ,x"))).alias("parts"))


@query("SELECT n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN 'HashByChannel' WHEN 1 THEN 'RoundRobin' WHEN 2 THEN 'FreeSpaceAware' END AS strategy, CASE n_nationkey % 3 WHEN 0 THEN 'BDM2' WHEN 1 THEN 'BDM50100' ELSE 'Unknown' END AS detector FROM nation")
def names_parse(spark, d):
    k = F.col("n_nationkey")
    strategy = F.element_at(F.array(*[F.lit(x) for x in ("hashbychannel", "ROUNDROBIN", "FreeSpaceAware", "hash_by_channel", "")]), (k % 5 + 1).cast("int"))
    detector = F.element_at(F.array(*[F.lit(x) for x in ("BDM2", "BDM50100", "bdm2")]), (k % 3 + 1).cast("int"))
    return v.read(spark, d, "nation").select("n_nationkey", scalars.shard_strategy(strategy).alias("strategy"), scalars.detector_type(detector).alias("detector"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN ' ' WHEN c_custkey % 3 = 1 AND c_custkey % 2 = 0 THEN c_name ELSE 'run_' || c_custkey END AS session FROM customer")
def session_names(spark, d):
    k, name = F.col("c_custkey"), F.col("c_name")
    given = F.when(k % 3 == 0, F.lit(" ")).otherwise(F.lit(""))
    options = scalars.parse_command(F.concat(F.lit("session="), F.when((k % 3 == 1) & (k % 2 == 0), name).otherwise(F.lit(""))))
    return v.read(spark, d, "customer").select("c_custkey", scalars.session_name(given, options, F.lit("run"), k).alias("session"))


@query("SELECT c_custkey, '10.' || (c_custkey // 65536) % 256 || '.' || (c_custkey // 256) % 256 || '.' || c_custkey % 256 AS ip, 167772160 + c_custkey AS back FROM customer")
def ip_text(spark, d):
    c = v.read(spark, d, "customer").select("c_custkey", scalars.ip_to_text(F.lit(167772160).cast("bigint") + F.col("c_custkey")).alias("ip"))
    return c.withColumn("back", scalars.text_to_ip(F.col("ip")))


@query(f"SELECT id, channel * 676 + crystal AS global_crystal, least(abs(channel - 3), 12 - abs(channel - 3)) AS sep, channel + 288 AS shifted, (t // 60000000) || 'm ' || ((t // 1000000) % 60) || 's ' || ((t // 1000) % 1000) || 'ms' AS shown FROM ({v.SINGLES})")
def scalar_columns(spark, d):
    s = v.singles(spark, d)
    return s.select("id", scalars.global_crystal(F.col("channel"), F.col("crystal"), 676).alias("global_crystal"), scalars.channel_separation(F.col("channel"), F.lit(3), 12).alias("sep"), scalars.shift_channel(F.col("channel"), 288).alias("shifted"), scalars.format_time_ns(F.col("t") * 1000).alias("shown"))


@query("SELECT DISTINCT user_id % 576 // 144 AS ring FROM events")
def distinct_rings(spark, d):
    return control.distinct_rings(v.read(spark, d, "events"), 4, 144, "user_id")


@query(f"SELECT kept::BIGINT AS kept, (total - kept)::BIGINT AS skipped, kept / total AS ratio FROM (SELECT count(*) FILTER (channel IN (1, 5, 17)) AS kept, count(*) AS total FROM ({v.PACKETS}))")
def extraction_ratio(spark, d):
    return stats.extraction_ratio(v.packets(spark, d), F.col("channel").isin(1, 5, 17))


@query(f"SELECT segment_id, packet_idx, segment_id // 4 AS sort_key, (segment_id % 4) * 1000000 + segment_id * 1000 + packet_idx AS sort_sub FROM ({v.PACKETS})")
def packet_order(spark, d):
    p = v.packets(spark, d).withColumns({"t0": F.expr("segment_id div 4"), "dir": F.col("segment_id") % 4})
    return ordering.packet_order(p, "t0", "dir", "segment_id", "packet_idx").select("segment_id", "packet_idx", "sort_key", "sort_sub")


@query("SELECT n_regionkey * 5 + i AS channel, n_name AS file, n_regionkey AS ring, i::INT AS within FROM nation, range(5) r(i)")
def ring_placement(spark, d):
    n = v.read(spark, d, "nation").select(F.col("n_regionkey").alias("ring"), F.col("n_name").alias("file"))
    return control.ring_placement(n, 5)


@query(f"SELECT count(DISTINCT node_id)::BIGINT AS registered, count(DISTINCT node_id) >= 2 AS ready, CASE WHEN count(DISTINCT node_id) >= 2 THEN max(t // 1000) + 1000 END AS start_ms FROM ({v.SINGLES})")
def start_barrier(spark, d):
    s = v.singles(spark, d).withColumn("ms", F.expr("t div 1000"))
    return control.start_barrier(s, "node_id", "ms", 2)


@query(f"WITH s AS ({CUT}) SELECT {PAIR}, b.t - a.t AS dt FROM s a JOIN s b ON b.t BETWEEN a.t AND a.t + {W} AND (b.t > a.t OR b.id > a.id) AND a.channel <> b.channel")
def stream_prompt_pairs(spark, d):
    """The stream-stream join over two node streams, drained; the same pairs as the batch join of on-time data."""
    from ..storage import shared_path
    from ..streaming import coincidence as live

    path, out = shared_path(spark, "stream-in"), shared_path(spark, "stream-out")
    cut(spark, d).repartition("node_id").write.partitionBy("node_id").parquet(path)
    schema = "id bigint, channel int, crystal int, t bigint, energy double"
    streams = [live.node_stream(spark, f"{path}/node_id={n}", schema, 5_000_000) for n in (0, 1)]
    live.run_available(live.stream_pairs(streams, W), out, shared_path(spark, "stream-checkpoint"))
    return spark.read.schema("id1 bigint, channel1 int, crystal1 int, t1 bigint, id2 bigint, channel2 int, crystal2 int, t2 bigint, dt bigint").parquet(out)


STEPS = 4
# A row leaves at the first step from its own on whose mark reaches it and is above the mark before; what never does, at the end.
_BATCHES = f"""m AS (SELECT (max(id) + {STEPS}) // {STEPS} AS width FROM ({v.SINGLES})),
s AS (SELECT c.*, id // width AS step FROM ({CUT}) c, m),
n AS (SELECT g.step, max(max(t) FILTER (node_id = 0)) OVER w AS a, max(max(t) FILTER (node_id = 1)) OVER w AS b FROM range({STEPS}) g(step) LEFT JOIN s USING (step) GROUP BY g.step WINDOW w AS (ORDER BY g.step)),
k AS (SELECT step, CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE greatest(0, least(a, b) - {MARGIN}) END AS mark FROM n),
v AS (SELECT step, mark, row_number() OVER (ORDER BY step) - 1 AS batch FROM (SELECT *, lag(mark, 1, 0) OVER (ORDER BY step) AS before FROM k) WHERE mark > before),
o AS (SELECT s.*, coalesce((SELECT min(batch) FROM v WHERE v.step >= s.step AND v.mark >= s.t), (SELECT count(*) FROM v))::INT AS batch FROM s)"""


@query(f"WITH {_BATCHES}, p AS (SELECT a.batch, {PAIR}, b.t - a.t AS dt FROM o a JOIN o b ON a.batch = b.batch AND b.t BETWEEN a.t AND a.t + {W} AND (b.t > a.t OR b.id > a.id) AND {SEP} >= 1), q AS (SELECT a.batch, {PAIR}, b.t - a.t - {D} AS dt FROM o a JOIN o b ON a.batch = b.batch AND b.t BETWEEN a.t + {D - W} AND a.t + {D + W} AND {SEP} >= 1) SELECT *, 'prompt' AS kind FROM p UNION ALL SELECT *, 'delay' FROM q")
def stream_watermark_batches(spark, d):
    """Pairs of watermark batches, each paired by itself, with the batch they left in; the same singles as in batch queries."""
    from ..storage import shared_path
    from ..streaming import coincidence as live

    path = shared_path(spark, "stream-in")
    width = -(-(v.singles(spark, d).agg(F.max("id")).first()[0] + 1) // STEPS)
    for k in range(STEPS):  # a file each, in this order
        cut(spark, d).where(F.expr(f"id div {width}") == k).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema("id bigint, node_id int, channel int, crystal int, t bigint, energy double").option("maxFilesPerTrigger", 1).parquet(path)
    handler = live.WatermarkBatches(spark, shared_path(spark, "stream-out"), shared_path(spark, "stream-state"), 2, MARGIN, live.prompt_and_delay(W, D, CHANNELS))
    live.run_batches(stream, handler, shared_path(spark, "stream-checkpoint"))
    return handler.pairs()


from . import round_trips  # noqa: E402, F401  adds its queries
