import oracle
import pytest

from tickfuse.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_against_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = oracle.rows(df)
    if name in ORACLES:
        assert got == oracle.sql_rows(con, ORACLES[name], df.columns)


def test_scalar_limits_beyond_64_bits(spark, tmp_path):
    """Keys at both limits: products pass 64 bits at 2200, the SQL saturates at 3000. The scalar itself saturates at 2200."""
    from pyspark.sql import functions as F

    from tickfuse.functions import scalars

    keys = [1, 2199, 2200, 2999, 3000, 15000, 900_000]
    spark.createDataFrame([(k,) for k in keys], "c_custkey bigint").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    df = QUERIES["scalar_limits"](spark, str(tmp_path))
    assert oracle.rows(df) == oracle.sql_rows(oracle.connect(str(tmp_path)), ORACLES["scalar_limits"], df.columns)
    limit = spark.range(2199, 2201).select(scalars.reserve_singles(F.col("id") * 10**9, 1024, 64).alias("n")).collect()
    assert sorted(int(r["n"]) for r in limit) == [2199 * 10**9 * 131072 * 64, (1 << 64) - 1]


def test_watermark_batches_take_the_energy_window(spark):
    """What the batch query finds, but for pairs whose singles left in different batches."""
    got = [tuple(r) for r in QUERIES["stream_watermark_batches"](spark, SF).select("kind", "id1", "id2", "batch").collect()]
    want = {tuple(r) for r in QUERIES["coincidences"](spark, SF).select("kind", "id1", "id2").collect()}
    energy = {r["id"]: r["energy"] for r in QUERIES["energy_window"](spark, SF).collect()}
    pairs = [x[:3] for x in got]
    assert len(pairs) == len(set(pairs)) and set(pairs) <= want
    assert any(min(energy[a], energy[b]) < 100 for _, a, b in pairs)
    batch = {}
    for _, a, b, n in got:
        assert batch.setdefault(a, n) == n and batch.setdefault(b, n) == n
    assert all(batch[a] != batch[b] for k, a, b in want - set(pairs) if a in batch and b in batch)


def test_binned_join_equals_nested_loop(spark):
    from pyspark.sql import functions as F

    from tickfuse.operators.interval_join import delay_pairs, prompt_pairs

    s = spark.range(300).select("id", (F.col("id") % 7).cast("int").alias("channel"), (F.col("id") % 5).cast("int").alias("crystal"), (F.pmod(F.xxhash64("id"), F.lit(2000))).alias("t"))
    a, b = s.select(*[F.col(c).alias(c + "1") for c in s.columns]), s.select(*[F.col(c).alias(c + "2") for c in s.columns])
    dt = F.col("t2") - F.col("t1")
    loop = a.join(b, dt.between(0, 13) & ((dt > 0) | (F.col("id2") > F.col("id1"))) & (F.abs(F.col("channel1") - F.col("channel2")) >= 1))
    assert sorted((r["id1"], r["id2"]) for r in loop.collect()) == sorted((r["id1"], r["id2"]) for r in prompt_pairs(s, 13).collect())
    late = a.join(b, (dt - 100).between(-13, 13) & (F.col("channel1") != F.col("channel2")))
    assert sorted((r["id1"], r["id2"]) for r in late.collect()) == sorted((r["id1"], r["id2"]) for r in delay_pairs(s, 13, 100).collect())


def test_window_edges(spark):
    from tickfuse.operators.interval_join import prompt_pairs

    s = spark.createDataFrame([(0, 0, 0, 0), (1, 1, 0, 10), (2, 2, 0, 21), (3, 3, 0, 21)], "id bigint, channel int, crystal int, t bigint")
    assert sorted((r["id1"], r["id2"]) for r in prompt_pairs(s, 10).collect()) == [(0, 1), (2, 3)]


def test_plan_is_an_equi_join(spark):
    plan = QUERIES["prompt_pairs"](spark, SF)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 5
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
