import random
import pytest
from pyspark.sql import functions as F

from tickfuse.plans import offline, sinks
from tickfuse.schemas import AlignerConfig, CoincidenceProtocol, R2SConfig, StorageConfig
from tickfuse.sources import generators, listing, manifests, raw_packets, singles, vendor
from tickfuse.streaming import clock_sync, coincidence


def test_raw_packets_round_trip(spark, tmp_path):
    p = generators.packets(spark, 40, 5).withColumns({"segment_id": F.expr("packet_idx div 7"), "clock_ms": F.expr("100 + packet_idx div 20"), "duration_ms": F.lit(3).cast("bigint")})
    written = raw_packets.write(p, str(tmp_path / "raw"), 5).collect()
    assert len(written) == 2
    back = raw_packets.read(spark, str(tmp_path / "raw"), 2)
    assert back.count() == 40
    assert sorted((r["channel"], r["payload"]) for r in back.collect()) == sorted((r["channel"], r["payload"]) for r in p.collect())
    assert raw_packets.file_info(back).count() == 2
    names = listing.raw_files(listing.files(spark, str(tmp_path / "raw")))
    assert [r["clock"] for r in names.collect()] == [100, 101]


def test_clocks_of_names(spark):
    names = {"pniRaw-123.bin": 123, "pniRaw-123-4.bin": 123, "pniRaw-123_x.bin": 123, "pniRaw-12ab.bin": 12, "pniRaw--5.bin": None, "pniRaw-x.bin": None, "pniRaw-.bin": None, "other-1.bin": None, "pniRaw-1.txt": None}
    df = spark.createDataFrame([(n,) for n in names], "name string").select("name", listing.start_clock(F.col("name")).alias("clock"))
    assert {r["name"]: r["clock"] for r in df.collect()} == names


def test_plain_decoder(spark, tmp_path):
    from tickfuse.functions import decoders

    payload = decoders.encode_plain(1000, [(5, 3, 10.0), (6, 4, 20.0), (7, 500, 5.0), (700, 1, 1.0)])
    rows = [(0, 7, 1, bytearray(payload)), (0, 7, 2, bytearray(b"short")), (0, 7, 3, None)]
    p = spark.createDataFrame(rows, "segment_id bigint, clock_ms bigint, channel int, payload binary")
    run = lambda **c: sorted((r["crystal"], r["time_100fs"]) for r in offline.raw_to_singles(p, R2SConfig(detector_type="plain", **c)).collect())
    assert run(time_shift=0) == [(5, 1003), (6, 1004), (7, 1500)]
    assert run(time_shift=10, cross_talk_enabled=True, time_window=25) == [(6, 1014), (7, 1510)]
    files = p.where("channel = 1").withColumns({"packet_idx": F.lit(0).cast("bigint"), "duration_ms": F.lit(1).cast("bigint")})
    raw_packets.write(files, str(tmp_path / "raw"), 4).collect()
    assert {r["input_clock"] for r in offline.raw_files_to_singles(spark, str(tmp_path / "raw"), R2SConfig(detector_type="plain")).collect()} == {7}


def test_manifest_over_files(spark, tmp_path):
    """Commit after prepare, in files that are dealt to tasks in another order than by name."""
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.txt").write_text('{"type": "prepare", "segment_id": 1, "segment_clock_ms": 5, "duration_ms": 1, "shard_id": 0, "file": "x"}\n')
    (tmp_path / "m" / "b.txt").write_text('{"type": "commit", "segment_id": 1}\n' + "not json\n" * 5000)
    assert [r["segment_id"] for r in manifests.recover(spark, str(tmp_path / "m")).collect()] == [1]


def test_datagrams(spark, tmp_path):
    """A port as a stream: what is sent is there once, and again the same from the spool."""
    import socket
    import threading
    import time

    from tickfuse.sources import feed

    with socket.socket(socket.AF_INET, socket.SOCK_DGRAM) as probe:
        probe.bind(("127.0.0.1", 0))
        port = probe.getsockname()[1]
    stream = feed.udp_stream(spark, port, str(tmp_path / "spool"))
    q = feed.write_feed(stream, str(tmp_path / "feed"), str(tmp_path / "cp"))
    sent = [f"packet {i}".encode() for i in range(40)]

    def send():
        with socket.socket(socket.AF_INET, socket.SOCK_DGRAM) as s:
            for p in sent:
                s.sendto(p, ("127.0.0.1", port))
                time.sleep(0.002)

    folder = tmp_path / "spool"
    for _ in range(100):  # the socket is there once the first micro-batch has begun
        if folder.exists():
            break
        time.sleep(0.2)
    t = threading.Thread(target=send)
    t.start()
    t.join()
    for _ in range(60):
        time.sleep(0.3)
        if folder.exists() and folder.read_bytes().count(b"packet") == 40:
            break
    q.processAllAvailable()
    q.stop()
    back = feed.read_feed(spark, str(tmp_path / "feed")).writeStream.format("memory").queryName("fed").start()
    back.processAllAvailable()
    rows = spark.sql("select n, payload from fed order by n").collect()
    back.stop()
    assert [bytes(r["payload"]) for r in rows] == sent and [r["n"] for r in rows] == list(range(40))
    reader = feed.UdpReader({"port": str(port), "spool": str(folder)})
    assert [r[3] for r in reader.readBetweenOffsets(reader.initialOffset(), {"at": folder.stat().st_size})] == sent


def test_batches_survive_a_restart(spark, tmp_path):
    """A run that dies in a micro-batch, after its pairs were written, and goes on with new objects: the same pairs as without."""
    g = generators.singles(spark, 300, 0, 100_000, 6, 3).withColumnRenamed("time_100fs", "t").withColumn("node_id", (F.col("channel") % 2).cast("int")).select("id", "node_id", "channel", "crystal", "t")
    for k in range(5):
        g.where(F.expr("t div 20000") == k).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    schema = "id bigint, node_id int, channel int, crystal int, t bigint"
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    make = lambda name: coincidence.WatermarkBatches(spark, str(tmp_path / name / "out"), str(tmp_path / name / "state"), 2, 3000, coincidence.prompt_and_delay(300, 5000, 6))
    whole = make("whole")
    coincidence.run_batches(stream(), whole, str(tmp_path / "cp1"))
    want = sorted(map(tuple, whole.pairs().collect()))
    assert want

    class Dies(coincidence.WatermarkBatches):
        def _save(self, step, meta, held):
            if step == 3:
                raise RuntimeError("killed")
            super()._save(step, meta, held)

    first = Dies(spark, str(tmp_path / "cut" / "out"), str(tmp_path / "cut" / "state"), 2, 3000, coincidence.prompt_and_delay(300, 5000, 6))
    with pytest.raises(Exception, match="killed"):
        coincidence.run_batches(stream(), first, str(tmp_path / "cp2"))
    second = make("cut")
    live = coincidence.Live(stream(), second, str(tmp_path / "cp2"), 50)
    with pytest.raises(ValueError):
        live.control("PAUSE")
    live.control("FLUSH")
    second.flush()  # a second flush adds nothing
    assert sorted(map(tuple, second.pairs().collect())) == want
    third = make("cut")  # after a flush, new rows don't meet what was flushed
    g.where("t < 400").write.mode("append").parquet(str(tmp_path / "in"))
    coincidence.run_batches(stream(), third, str(tmp_path / "cp2"))
    new = [r for r in map(tuple, third.pairs().collect()) if r not in want]
    assert len(new) + len(want) == third.pairs().count() and {r[-1] for r in new} <= {max(x[-1] for x in want) + 1}
    totals = coincidence.totals(live.query, second.pairs().where(F.col("batch") <= max(x[-1] for x in want)))
    assert totals["prompt"] + totals["delay"] == len(want)


def test_no_local_folder_on_a_cluster():
    from types import SimpleNamespace

    from tickfuse import storage

    conf = {}
    session = lambda master: SimpleNamespace(conf=SimpleNamespace(get=conf.get, set=conf.__setitem__), sparkContext=SimpleNamespace(master=master))
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            storage.shared_dir(session(master))
    assert storage.shared_dir(session("local[4]")).startswith("file://")
    conf["spark.checkpoint.dir"] = "hdfs://shared"
    assert storage.shared_dir(session("yarn")) == "hdfs://shared"


def test_vendor_round_trip(spark, tmp_path):
    s = spark.createDataFrame([(0, i, i % 288, i * 100, 1000.0 * i) for i in range(10)], "run int, channel int, crystal int, time_100fs bigint, energy double")
    assert vendor.write_listmode(s, str(tmp_path / "lm"), "run", ["time_100fs"]).first()["events"] == 10
    back = vendor.listmode_singles(spark, str(tmp_path / "lm"))
    assert sorted((r["channel"], r["crystal"], r["time_100fs"]) for r in back.collect()) == [(i, i % 288, i * 100) for i in range(10)]
    (tmp_path / "bad.lm").write_bytes(b"x" * 600)
    with pytest.raises(Exception, match="not vendor listmode"):
        vendor.read_listmode(spark, str(tmp_path / "bad.lm")).collect()
    frame = bytes(1024) + (2 * 256 + 1).to_bytes(2, "little")
    (tmp_path / "f.raw").write_bytes(bytes(510) + frame * 3)
    assert [r["channel"] for r in vendor.read_frames(spark, str(tmp_path / "f.raw"), 1).collect()] == [144, 144, 144]


def test_natural_order(spark, tmp_path):
    for n in ("c_10.cal", "c_2.cal", "x.cal", "c_1.txt"):
        (tmp_path / n).write_text("x")
    assert [r["name"] for r in listing.calibrations(listing.files(spark, str(tmp_path)), [".cal"]).collect()] == ["c_2.cal", "c_10.cal", "x.cal"]


def test_shards_and_manifest(spark, tmp_path):
    seg = spark.range(10).select(F.col("id").alias("segment_id"), (F.col("id") % 3).alias("first_channel"), (F.col("id") == 4).alias("full"), F.lit(10).alias("bytes"), (F.col("id") * 5).alias("clock_ms"), F.lit(1).cast("bigint").alias("duration_ms"))
    out = sinks.shard_segments(seg, StorageConfig(output_roots=("a", "b"), use_spill_to_disk=True), "segment_id", "first_channel", "full")
    sinks.write_manifest(out, str(tmp_path / "m"))
    (tmp_path / "m" / "broken.txt").write_text('{"type": "prep\n')
    assert [r["segment_id"] for r in manifests.recover(spark, str(tmp_path / "m")).collect()] == [0, 1, 2, 3, 5, 6, 7, 8, 9]


def test_singles_and_chunks(spark, tmp_path):
    g = generators.singles(spark, 50, 0, 1000, 4, 9)
    g.drop("energy").write.parquet(str(tmp_path / "s"))
    assert {r["energy"] for r in singles.read_singles(spark, str(tmp_path / "s")).collect()} == {0.0}
    with pytest.raises(ValueError, match="missing columns"):
        singles.read_singles(spark, str(tmp_path / "s")).transform(lambda d: __import__("tickfuse.schemas").schemas.require_columns(d, ["nope"]))
    m = spark.sql("select 1 node_id, array(named_struct('channel', 1, 'crystal', 1, 'time_100fs', 5L, 'energy', 1f), named_struct('channel', 2, 'crystal', 1, 'time_100fs', 6L, 'energy', 1f)) singles, array(named_struct('chunk_id', 0L, 'clock_ms', 0L, 'duration_ms', 1L, 'singles_offset', 0, 'singles_count', 1), named_struct('chunk_id', 1L, 'clock_ms', 0L, 'duration_ms', 1L, 'singles_offset', 1, 'singles_count', 1)) metas")
    assert sorted((r["chunk_id"], r["channel"]) for r in singles.explode_chunks(singles.slice_segments(m)).collect()) == [(0, 1), (1, 2)]


def test_offline_pipeline(spark, tmp_path):
    def decode(batches):
        import pandas as pd

        for b in batches:
            yield pd.DataFrame({"segment_id": b.segment_id, "clock_ms": b.clock_ms, "channel": b.channel, "crystal": b.channel * 0, "time_100fs": b.packet_idx * 1000, "energy": (b.packet_idx % 4).astype("float32")})

    offline.register_generator("test", lambda config: decode)
    p = generators.packets(spark, 40, 5).withColumns({"segment_id": F.expr("packet_idx div 7"), "clock_ms": F.lit(1).cast("bigint")})
    s = offline.raw_to_singles(p, R2SConfig(detector_type="test", channel_indices=(1, 2), use_energy_cut=True, energy_cut_low=1, energy_cut_high=2))
    assert {r["channel"] for r in s.collect()} <= {1, 2} and s.count() > 0
    with pytest.raises(ValueError):
        offline.raw_to_singles(p, R2SConfig(detector_type="none"))


def test_merge_modes(spark, tmp_path):
    s = spark.createDataFrame([(0, "a", 0, 0, 0, 100, 5.0), (1, "b", 0, 1, 0, 150, 5.0), (2, "b", 1, 2, 0, 160, 5.0)], "id bigint, file string, segment_id bigint, channel int, crystal int, time_100fs bigint, energy double")
    seg = spark.createDataFrame([("a", 0, 0, 10), ("b", 0, 4, 14), ("b", 1, 9, 20)], "file string, segment_id bigint, start_ms bigint, end_ms bigint")
    proto = CoincidenceProtocol(window_ps=10, delay_ps=1000, energy_lower_ev=0, energy_upper_ev=10)
    assert offline.merge_and_pair(s, seg, proto, 8).where("kind = 'prompt'").count() == 3
    assert offline.merge_and_pair(s, seg, proto, 8, "faithful").where("kind = 'prompt'").count() == 1
    sinks.write_coincidences(offline.merge_and_pair(s, seg, proto, 8), str(tmp_path / "out"), AlignerConfig(save_delay=False))
    assert {r["kind"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"prompt"}


def test_stream_equals_batch(spark, tmp_path):
    from tickfuse.operators.interval_join import prompt_pairs

    g = generators.singles(spark, 400, 0, 100_000, 6, 3).withColumnRenamed("time_100fs", "t").withColumn("node", F.col("channel") % 2)
    streams = []
    for n in (0, 1):
        g.where(F.col("node") == n).drop("node").repartition(1).write.parquet(str(tmp_path / f"n{n}"))
        streams.append(coincidence.node_stream(spark, str(tmp_path / f"n{n}"), "id bigint, channel int, crystal int, t bigint, energy float", 200_000))
    q = coincidence.run_available(coincidence.stream_pairs(streams, 300), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out"))
    want = prompt_pairs(g, 300)
    assert sorted((r["id1"], r["id2"]) for r in got.collect()) == sorted((r["id1"], r["id2"]) for r in want.collect())
    assert sum(p["rows"] for p in coincidence.progress(q)) > 0


def test_streaming_offsets(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i % 2, i, i * 1_000_000, rng.randrange(-5000, 5000) - (10**9 if i % 11 == 3 else 0), float(i % 7)) for i in range(80)]
    schema = "client bigint, seq bigint, time_ns bigint, offset_ns bigint, delay_ms double"
    for k in range(2):  # two files, so that state is carried over
        spark.createDataFrame(rows[40 * k : 40 * k + 40] + [(None, 1, 1, 1, 1.0), (1, 1, 1, None, 1.0)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    coincidence.run_available(clock_sync.streaming_offsets(stream, last=20), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {(r["client"], r["seq"]): r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert len(got) == 80
    for client in (0, 1):
        kept, latency = [], 0.0
        for n, (_, seq, time, offset, delay) in enumerate((r for r in rows if r[0] == client), 1):
            if not kept or abs(offset - int(sum(x for x, _ in kept) / len(kept))) < 50_000_000:
                kept = [*kept, (offset, time)][-20:]
            latency = 0.7 * latency + 0.3 * delay
            r = got[client, seq]
            assert (r["avg_offset"], r["syncs"], r["confidence"]) == (int(sum(x for x, _ in kept) / len(kept)), n, min(len(kept) / 10, 1.0))
            assert abs(r["latency_ms"] - latency) < 1e-9
            if len(kept) >= 10:
                assert abs(r["drift_ppm"] - (kept[-1][0] - kept[0][0]) / (kept[-1][1] - kept[0][1]) * 1e6) < 1e-6
