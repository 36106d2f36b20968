import json

import pytest
from pyspark.sql import functions as F

from tickfuse import schemas
from tickfuse.functions import codec, scalars
from tickfuse.operators import clock, control, filters, folds, interval_join, manifest, sequence, stats


def test_energy_bounds_nan_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),), (None,)], "energy double")
    assert [r[0] for r in filters.energy_window(df, 1.0, 2.0).collect()] == [1.0, 2.0]
    assert filters.energy_window(df, 2.0, 1.0).count() == 5


def test_channels(spark):
    p = spark.createDataFrame([(0, 0, 1, 10), (0, 1, 2, 20), (0, 2, 1, 30)], "segment_id bigint, packet_idx bigint, channel int, length int")
    assert sorted(r["new_offset"] for r in filters.extract_channels(p, [1]).collect()) == [0, 10]
    with pytest.raises(ValueError):
        filters.require_channels(p, p.where("channel = 1"))
    with pytest.raises(ValueError):
        filters.check_capacity(3, 2)


def test_rolling_limit(spark):
    df = spark.createDataFrame([(0, i, n) for i, n in enumerate([40, 60, 1, 200, 5])], "k int, n int, bytes int")
    assert [r["file_seq"] for r in folds.rolling_files(df, ["k"], ["n"], "bytes", 100).orderBy("n").collect()] == [0, 0, 1, 2, 3]
    assert {r["file_seq"] for r in folds.rolling_files(df, ["k"], ["n"], "bytes", 0).collect()} == {0}


def test_anchor_does_not_move(spark):
    df = spark.createDataFrame([(s, s + 1, i) for i, s in enumerate([0, 2, 5, 6, 11, 30])], "s bigint, e bigint, i bigint")
    for width in (3, 1000):
        got = folds.anchored_groups(df, "s", "e", "i", 5, width).orderBy("group_start").collect()
        assert [(r["group_start"], r["members"]) for r in got] == [(0, 3), (6, 2), (30, 1)]


def test_fold_carries_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = spark.range(20).select((F.col("id") % 2).alias("k"), "id", F.lit(1.0).alias("x"))
        got = folds.ema(df, ["k"], ["id"], "x").collect()
        assert all(abs(r["ema"] - 1) < 1e-9 for r in got)
        gated = folds.gated_mean(spark.createDataFrame([(0, 0, 10), (0, 1, 12), (0, 2, 10_000), (0, 3, 14)], "k int, n int, o bigint"), ["k"], ["n"], "o", 100, 100)
        assert [r["avg_offset"] for r in gated.orderBy("n").collect()] == [10, 11, 11, 12]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_bridge(spark):
    """A queue of two: arrivals at 0, 1, 2, 3 that take 10 each, and one at 100."""
    df = spark.createDataFrame([(0, i, t, 10) for i, t in enumerate([0, 1, 2, 3, 100])], "k int, n int, t bigint, cost bigint")
    run = lambda block: [(r["outcome"], r["finish"]) for r in folds.bridge(df, ["k"], ["n"], "t", "cost", 2, block).orderBy("n").collect()]
    assert run(True) == [("taken", 10), ("taken", 20), ("blocked", 30), ("blocked", 40), ("taken", 110)]
    assert run(False) == [("taken", 10), ("taken", 20), ("dropped", None), ("dropped", None), ("taken", 110)]


def test_command_line(spark, tmp_path, capsys):
    from tickfuse import __main__ as cli
    from tickfuse.sources import generators

    cli.main(["list"])
    assert "prompt_pairs" in capsys.readouterr().out.split()
    cli.main(["run", "segment_inventory", "/root/testdata/sf0.001", str(tmp_path / "q")])
    assert spark.read.parquet(str(tmp_path / "q")).count() == 1
    generators.singles(spark, 2000, 0, 10**7, 48, 9).write.parquet(str(tmp_path / "s"))
    cli.main(["pair", str(tmp_path / "s"), str(tmp_path / "p")])
    assert {r["kind"] for r in spark.read.parquet(str(tmp_path / "p")).select("kind").distinct().collect()} <= {"prompt", "delay"}


def test_tile_and_even_split(spark):
    df = spark.range(10).select(F.lit(0).alias("g"), "id")
    parts = [r["part"] for r in sequence.tile_split(df, ["g"], ["id"], 3, F.lit(2)).orderBy("id").collect()]
    assert parts == [0, 0, 1, 1] + [2] * 6
    even = sequence.even_partition(spark.range(12), ["id"], 3).collect()
    assert sorted((r["node_no"], r["local_idx"]) for r in even) == [(n, i) for n in range(3) for i in range(4)]


def test_interval_fixture(spark):
    rows = [(0, 1000, 500, -5), (1, 1200, 500, 3), (2, 1100, 500, -2), (3, 1300, 500, 8)]
    df = spark.createDataFrame([(i, s * 10**6, (s + d) * 10**6, o * 10**6) for i, s, d, o in rows], "idx bigint, start_ns bigint, end_ns bigint, offset_ns bigint")
    cal = clock.calibrate(df).select("idx", F.col("cal_start_ns").alias("start_ns"), F.col("cal_end_ns").alias("end_ns"))
    assert interval_join.overlaps(cal, 10**8).count() == 6
    ev = spark.createDataFrame([(1500000000 - 5 * 10**6,), (1500003000 + 3 * 10**6,), (1500001000 - 2 * 10**6,), (1500004000 + 8 * 10**6,)], "cal_ns bigint")
    assert clock.alignment(ev).first()["spread_ns"] == 13004000


def test_overlaps_of_all_lengths(spark):
    """Long and short intervals together, against all pairs; the longest would touch a million bins."""
    import random

    rng = random.Random(5)
    rows = [(i, s, s + rng.choice([1, 3, 10, 40, 1000, 10**6])) for i in range(120) for s in [rng.randrange(-2000, 2000)]]
    df = spark.createDataFrame(rows, "idx bigint, start_ns bigint, end_ns bigint")
    want = sorted((i, j, min(e, f) - max(s, t)) for i, s, e in rows for j, t, f in rows if i < j and s < f and t < e)
    assert sorted(map(tuple, interval_join.overlaps(df, 1).collect())) == want
    assert sorted(map(tuple, interval_join.overlaps(df, 37).collect())) == want


def test_gap_tolerance(spark):
    df = spark.createDataFrame([(0, 0, 10), (1, 15, 20), (2, 100, 110)], "idx bigint, start_ns bigint, end_ns bigint")
    assert interval_join.merge_decisions(df, 5, 7).count() == 1
    assert interval_join.merge_decisions(df, 4, 7).count() == 0
    assert interval_join.merge_decisions(df, 5, 7, "faithful").count() == 0


def test_ntp_fixture(spark):
    s = spark.createDataFrame([(0, 0, 10**9 + 5_000_000, 10**9 + 1_000_000, 10**9 + 1_000_000, 10**9 + 7_000_000)], "c int, n int, t1 bigint, t2 bigint, t3 bigint, t4 bigint")
    r = clock.ntp(s).first()
    assert abs(r["offset_ns"] + 5_000_000) <= r["rtt_ns"] / 2 + 1_000_000


def test_watermark_waits_for_all_nodes(spark):
    df = spark.createDataFrame([(0, 20), (0, 15), (1, 12)], "node int, t bigint")
    assert stats.node_watermark(df, "node", "t", 2, 2).first()["watermark"] == 10
    assert stats.node_watermark(df, "node", "t", 2, 3).first()["watermark"] == 0
    assert stats.node_watermark(df.limit(0), "node", "t", 2, 2).first()["watermark"] == 0


def test_digest_ignores_order(spark):
    df = spark.createDataFrame([(1, 2, 3, 4.0), (5, 6, 7, 8.0), (9, 9, 9, 9.5)], schemas.SINGLE)
    a, b = stats.digest(df).first(), stats.digest(df.orderBy(F.desc("time_100fs")).repartition(3)).first()
    h = 0
    import struct

    for c, k, t, e in [(1, 2, 3, 4.0), (5, 6, 7, 8.0), (9, 9, 9, 9.5)]:
        x = stats.MIX_START
        for v in (c, k, t, struct.unpack("<I", struct.pack("<f", e))[0]):
            x = ((x ^ v) * stats.MIX_PRIME) % (1 << 64)
        h ^= x
    assert a == b and a["total"] == 3 and a["checksum"] % (1 << 64) == h


def test_manifest_order(spark):
    log = spark.createDataFrame(
        [(0, "commit", 1, None, None, None, None), (1, "prepare", 1, 5, 1, 0, "a"), (2, "prepare", 2, 3, 1, 0, "b"), (3, "commit", 2, None, None, None, None), (4, "prepare", 3, 1, 1, 0, "c"), (5, "commit", 3, None, None, None, None), (6, "prepare", 3, 2, 1, 0, "d")],
        "line_no bigint, type string, segment_id bigint, clock_ms bigint, duration_ms bigint, shard_id int, file string",
    )
    assert [r["segment_id"] for r in manifest.committed(log).collect()] == [2]


def test_codec_round_trip(spark):
    s = spark.createDataFrame([(0, 0, 0, 1.0), (47, 35, 10**9, 511000.0), (48, 36, 5, 2.0), (143, 287, 7, float("nan")), (0x8000, 1, 1, 1.0), (1, 288, 1, 1.0)], "channel int, crystal int, time_100fs bigint, energy double")
    back = codec.decode_event(codec.encode_event(s).select("ip", "ch", "vendor_energy", "vendor_time")).collect()
    assert sorted((r["channel"], r["crystal"], r["time_100fs"]) for r in back) == [(0, 0, 0), (47, 35, 10**9), (48, 36, 5), (143, 287, 7)]
    t0 = spark.createDataFrame([(bytes([9, 9, 1, 2, 3, 4, 5, 6]),), (b"short",)], "p binary").select(codec.packet_t0(F.col("p"))).collect()
    assert [r[0] for r in t0] == [0x010203040506, 0]


def test_scalars(spark):
    r = spark.range(1).select(scalars.channel_separation(F.lit(1), F.lit(11), 12).alias("s"), scalars.is_ipv4(F.lit("1.2.3.256")).alias("bad"), scalars.text_to_ip(F.lit("1.2.3.4")).alias("ip"), scalars.shard_strategy(F.lit("HASHBYCHANNEL")).alias("k"), scalars.corrected_time(F.lit(-1500).cast("bigint"), F.lit(0).cast("bigint"), "us").alias("us"), scalars.session_name(F.lit(" "), scalars.parse_command(F.lit("session=x")), F.lit("p"), F.lit(3)).alias("n")).first()
    assert tuple(r) == (2, False, 0x01020304, "HashByChannel", -1, " ")
    r = spark.range(1).select(scalars.shard_strategy(F.lit("hash")).alias("a"), scalars.split_list(F.lit("a, ;;b")).alias("b"), scalars.session_name(F.lit(""), scalars.parse_command(F.lit("x;session=a=b")), F.lit("p"), F.lit(3)).alias("c"), scalars.session_name(F.lit(""), scalars.parse_command(F.lit("session=;=z")), F.lit("p"), F.lit(3)).alias("d")).first()
    assert tuple(r) == (None, ["a", " ", "b"], "a=b", "p_3")
    cases = [("5", 5), (" +7x", 7), ("x7", 9), ("-1", (1 << 64) - 1), ("18446744073709551615", (1 << 64) - 1), ("18446744073709551616", 9), ("9" * 60, 9), ("-0", 0), (None, 9)]
    got = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "i int, v string").select("i", scalars.parse_uint64(F.map_from_arrays(F.array(F.lit("k")), F.array("v")), "k", 9).alias("n")).orderBy("i").collect()
    assert [int(x["n"]) for x in got] == [n for _, n in cases]
    big = spark.range(1).select(scalars.reserve_singles(F.lit(1.0), 1024, 64).alias("a"), scalars.reserve_singles(F.lit(0.0), 1024, 64).alias("b"), scalars.reserve_singles(F.lit(1e15), 1024, 64).alias("c"), scalars.shift_channel(F.lit(0xFFFF), 1).alias("d")).first()
    assert tuple(int(x) for x in big) == (131072 * 64, 0, (1 << 64) - 1, 0x10000)


def test_states(spark):
    log = spark.createDataFrame([(0, 1, "CONFIGURED"), (0, 2, "RUNNING"), (0, 3, "IDLE"), (1, 1, "RUNNING")], "node int, n int, state string")
    assert sorted((r["node"], r["n"]) for r in control.bad_transitions(log, "node", "state", "n").collect()) == [(1, 1)]  # shutdown to IDLE is legal


def test_tasks(spark):
    t = spark.createDataFrame([(0, 0, 0, 70000, 3), (1, 2000, 0, 5, 1), (2, 5, 9, 5, 0)], "id int, min_packet int, max_packet int, port int, channels int")
    got = control.task_defaults(t, strict=False).orderBy("id").collect()
    assert [(r["min_packet"], r["max_packet"], r["port"], r["fault"]) for r in got] == [(1024, 1024, 65535, None), (2000, 1024, 5, "max_packet below min_packet"), (5, 9, 5, "no channels")]
    for i in (1, 2):
        with pytest.raises(Exception, match="max_packet|no channels"):
            control.task_defaults(t.where(F.col("id") == i)).collect()
    with pytest.raises(ValueError):
        control.effective_channels(t, "id", None, 1)
    with pytest.raises(Exception, match="overflows"):
        control.effective_channels(t, "id", 1, (1 << 32) - 2).collect()
    assert control.override_tasks(t, lambda x: x.withColumn("port", F.lit(9))).first()["port"] == 9
    with pytest.raises(ValueError):
        control.override_tasks(t, lambda x: x.drop("port"))
    assert control.admitted(t, 1, "id").count() == 2


def test_ring_pairing(spark):
    dirs = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "place bigint, dir string")
    on = spark.createDataFrame([(10,), (300,), (301,), (450,)], "channel int")
    ring = lambda *a: sorted((r["dir"], r["ring"]) for r in control.pair_rings(dirs, *a).collect())
    assert ring(3, on, 144) == [("a", 0), ("b", 1), ("c", 2)]
    assert ring(4, on, 144) == [("a", 0), ("b", 2), ("c", 3)]
    assert ring(2, None, 144) == [("a", 0), ("b", 1)]


def test_clock_details(spark):
    s = spark.createDataFrame([(1, 1, 10**9, 10**9 - 4_000_000), (1, 2, 0, 5), (1, 3, 1, 4 * 10**12)], "c int, n int, client_ns bigint, server_ns bigint")
    assert [r["latency_ms"] for r in clock.plausible(s, "client_ns", "server_ns").collect()] == [-2.0]
    assert [r["n"] for r in clock.after_reset(s, s.where("n = 2"), "c", "n").collect()] == [3]
    spread = lambda x: clock.alignment(spark.createDataFrame([(0,), (x,)], "cal_ns bigint")).first()["grade"]
    assert [spread(x) for x in (999_999, 1_000_000, 10_000_000, 10**9)] == ["excellent", "good", "acceptable", "acceptable"]
    tied = spark.createDataFrame([(0, 5, 1, "a"), (0, 5, 2, "b")], "node int, t int, n int, v string")
    assert control.snapshot(tied, "node", "t", "n").first()["v"] == "b"


def test_config(tmp_path, monkeypatch):
    p = tmp_path / "c.json"
    p.write_text(json.dumps({"channel_num": 576, "protocol": {"window_ps": 4000}}))
    c = schemas.load_config(schemas.AlignerConfig, str(p))
    assert c.channel_num == 576 and c.protocol.window == 40000 and c.safety_margin == (5_000_000_000 + 2_000_000) * 10
    for bad in ({"nope": 1}, {"channel_num": "x"}, {"save_prompt": 1}, {"channel_num": -1}):
        with pytest.raises(ValueError):
            schemas.load_config(schemas.AlignerConfig, bad)
    monkeypatch.setenv("TICKFUSE_RAW_OUTPUT_ROOTS", "/a;/b")
    assert schemas.with_environment(schemas.StorageConfig()).output_roots == ("/a", "/b")
    assert schemas.R2SConfig(use_energy_cut=True, energy_cut_low=2, energy_cut_high=1).energy_cut is None
    from tickfuse import config

    node = schemas.load_config(config.Node, {"bridge": {"queue_capacity": 8, "block_when_queue_full": False}, "coin_client": {"node_id": 3}})
    assert (node.bridge.queue_capacity, node.coin_client.node_id, node.acq_node.status_interval_ms) == (8, 3, 500)
    with pytest.raises(ValueError, match="queue_capacity"):
        schemas.load_config(config.Node, {"bridge": {"queue_capacity": "8"}})
    assert schemas.load_config(config.Master, {}).coin_master.wait_for_start_default_timeout_ms == 30000
    presets = schemas.ALIGNER_PRESETS
    assert (presets["BDM2"].channel_num, presets["BDM2"].crystals_per_channel, presets["9120"].channel_num, presets["9120"].crystals_per_channel) == (48, 676, 576, 288)
