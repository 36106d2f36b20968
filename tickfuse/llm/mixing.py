"""Mixing sources to target weights by Sainte-Lague apportionment.

The corpus is cut into equal-token blocks. Targets (weights, with a ceiling per source) are the votes and blocks the
seats: seats go to the highest quotients votes / (2 seats + 1). The seats of a source are shared out over its shards
the same way, and each shard then takes its quota of blocks from a seeded order of its documents. What whole blocks leave
open of a source's target is settled in words, in part of one more block a shard.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, attach, table

WEIGHTS, CEILING = (5, 2, 1), 3
#: Words of a block, blocks of a shard, shards of a source at most.
BLOCK, SHARD_BLOCKS, SHARDS, SEED = 64, 256, 4096, 20240501


def capped_targets(sizes: list[int], weights: list[float], ceiling: float = CEILING) -> list[float]:
    """Shares sum(sizes) by weight; what a source would get above ceiling times its size is shared again by weight."""
    total, target, open_ = float(sum(sizes)), [0.0] * len(sizes), list(range(len(sizes)))
    left = total
    while open_:
        w = sum(weights[i] for i in open_)
        above = [i for i in open_ if left * weights[i] / w > ceiling * sizes[i]]
        if not above:
            for i in open_:
                target[i] = left * weights[i] / w
            break
        for i in above:
            target[i] = float(ceiling * sizes[i])
            left -= target[i]
        open_ = [i for i in open_ if i not in set(above)]
    return target


def sainte_lague(votes: list[float], seats: int, most: list[int] | None = None) -> list[int]:
    """Seats by highest quotients votes / (2 s + 1), none above most. A divisor gives every list nearly all of its
    seats at once; a heap settles the last few, so the cost doesn't grow with the seats. Ties: the earlier list."""
    n = len(votes)
    most = most or [seats] * n
    seats = min(seats, sum(m for m, v in zip(most, votes, strict=True) if v > 0))
    given = [0] * n
    if seats <= 0:
        return given
    v, m = np.asarray(votes, float), np.asarray(most, float)
    low, high = 0.0, 2.0 * seats / max(min(x for x in votes if x > 0), 1e-12) + 2
    for _ in range(200):  # the multiplier at which rounding down still gives too few seats
        mid = (low + high) / 2
        if np.minimum(np.floor(v * mid + 0.5), m).sum() <= seats:
            low = mid
        else:
            high = mid
    given = [int(x) for x in np.maximum(np.minimum(np.floor(v * low + 0.5), m) - 1, 0)]
    heap = [(-votes[i] / (2 * given[i] + 1), i) for i in range(n) if votes[i] > 0 and given[i] < most[i]]
    heapq.heapify(heap)
    for _ in range(seats - sum(given)):
        _, i = heapq.heappop(heap)
        given[i] += 1
        if given[i] < most[i]:
            heapq.heappush(heap, (-votes[i] / (2 * given[i] + 1), i))
    return given


def plan_sources(sizes: dict[str | None, int], weights: tuple = WEIGHTS, ceiling: float = CEILING, block: int = BLOCK) -> list[dict]:
    """Target, shards of each source. Weights repeat along the sources by code point, null last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = capped_targets([sizes[s] for s in names], [weights[i % len(weights)] for i in range(len(names))], ceiling)
    return [{"source": s, "source_size": sizes[s], "target": t, "shards": min(SHARDS, max(1, math.ceil(sizes[s] / block / SHARD_BLOCKS)))} for s, t in zip(names, target, strict=True)]


def settle(words: list[int], seats: list[int], wanted: int, block: int, ceiling: int) -> list[int]:
    """Words of each shard: those of its seats, and what is open of `wanted` in words, from the first shard on."""
    quota = [min(k * block, ceiling * n) for k, n in zip(seats, words, strict=True)]
    rest = wanted - sum(quota)
    for i, n in enumerate(words):
        step = max(-quota[i], min(rest, ceiling * n - quota[i]))
        quota[i], rest = quota[i] + step, rest - step
    return quota


def taken_words(block: int) -> str:
    """SQL for the words that the mix takes of a document whose shard has `words` words in its seeded order, this one's
    from `start` to `stop`, and is to give `quota` of them, from a seeded `phase`.

    All words are taken quota div words times. The rest is as many whole blocks as fit, by a systematic sample of the
    `full` whole blocks of the shard (block j is hit once more if (j picks + phase) div full grows there), and the words left
    then, from the first block that isn't hit, or from the end if all are. What a document gives is a difference of two sums,
    so no block needs a row, and a shard gives exactly its quota."""
    more = "(quota % words)"
    picks = f"least({more} div {block}, full)"
    rest = f"({more} - {block} * {picks})"
    begin = f"CASE WHEN {picks} = full THEN full * {block} ELSE {block} * ((phase % greatest(full, 1)) div (full - {picks})) END"

    def upto(word: str) -> str:
        j = f"least({word} div {block}, full)"
        hits = lambda x: f"CASE WHEN full = 0 THEN 0L ELSE (({x}) * {picks} + phase % full) div full END"
        inside = f"least({word} - {block} * {j}, {block})"
        sample = f"{block} * ({hits(j)}) + CASE WHEN {j} = full THEN 0L ELSE (({hits(j + ' + 1')}) - ({hits(j)})) * {inside} END"
        return f"({sample} + greatest(0L, least({word} - ({begin}), {rest})))"

    return f"(quota div words) * size + {upto('stop')} - {upto('start')}"


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", weights: tuple = WEIGHTS, ceiling: int = CEILING, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """One row per row of docs: doc_id, size, source, source_size, target, taken.

    size counts words (null text: 0), of whole texts whatever their length. taken counts the words that the mix takes from
    the row, repeats included: never above ceiling * size. A source's taken words are its target, rounded. A null source is
    a source of its own and comes last. Rows that repeat an id are taken one by one. Sources without words get target 0; so
    does an empty table's every source. Other columns are not looked at, so their names can't clash. What goes to the driver
    is one row per source and per shard (SHARDS of a source at most), never per document.
    """
    spark = docs.sparkSession
    sized = table(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size")), "mix-sizes")
    sizes = {r["source"]: int(r["n"]) for r in sized.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    plan = plan_sources(sizes, weights, ceiling, block)
    schema = "source string, source_size bigint, target double, shards int"
    sources = spark.createDataFrame([(p["source"], p["source_size"], p["target"], p["shards"]) for p in plan], schema)
    key = F.xxhash64(F.lit(seed), "doc_id", "size")
    dealt = attach(sized, sources, ["source"], "inner").withColumn("key", key)
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("key"), F.col("shards").cast("bigint")).cast("int"))
    shards: dict = {}
    for r in dealt.groupBy("source", "shard").agg(F.sum("size").alias("n")).where("n > 0").collect():
        shards.setdefault(r["source"], []).append((r["shard"], int(r["n"])))
    cut = {s: sorted(own) for s, own in shards.items()}
    cells = [sum(ceiling * n // block for _, n in cut.get(p["source"], [])) for p in plan]
    seats = sainte_lague([p["target"] for p in plan], round(sum(sizes.values()) / block), [int(c) for c in cells])
    quotas = []
    for p, q in zip(plan, seats, strict=True):
        own = cut.get(p["source"], [])
        words = [n for _, n in own]
        each = sainte_lague([float(n) for n in words], q, [int(ceiling) * n // block for n in words]) if own else []
        wanted = settle(words, each, round(p["target"]), block, int(ceiling))
        quotas += [(p["source"], i, n, k) for (i, n), k in zip(own, wanted, strict=True)]
    quota = spark.createDataFrame(quotas, "source string, shard int, words bigint, quota bigint")
    order = Window.partitionBy("source", "shard").orderBy("key", "doc_id", "size")
    stop = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = dealt.where("size > 0").withColumn("stop", stop).withColumn("start", F.col("stop") - F.col("size"))
    rows = attach(rows, quota, ["source", "shard"]).withColumn("full", F.expr(f"words div {block}"))
    rows = rows.withColumn("phase", F.pmod(F.xxhash64(F.lit(seed), "source", "shard"), F.greatest("full", F.lit(1).cast("bigint"))))
    rows = rows.withColumn("taken", F.expr(taken_words(block)).cast("bigint"))
    empty = dealt.where("size = 0").withColumn("taken", F.lit(0).cast("bigint"))
    cols = ["doc_id", "size", "source", "source_size", "target", "taken"]
    return rows.select(cols).unionByName(empty.select(cols))
