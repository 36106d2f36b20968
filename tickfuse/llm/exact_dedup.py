"""Exact deduplication with counting quotient filters.

Every partition builds a counting quotient filter of its text fingerprints; the filters are cut into blocks by
quotient, and blocks of equal quotients merge by their sorted remainders, without loss. Fingerprints that count more
than once route their documents to a comparison of the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, attach, row_key, table, without

#: log2 of the number of quotients of a filter block; block, quotient and remainder are 64 bits together, of which a packed
#: remainder has 48 at most.
QUOTIENT_BITS = 12
#: Rows that a block is meant for, and log2 of the least and greatest number of blocks.
BLOCK_ROWS, LEAST_BITS, MOST_BITS = 1 << 16, 6, 30


#: The part of a row's key that tells apart rows of one id and length.
KEY_MASK = (1 << 30) - 1


def bits_for(rows: int) -> int:
    """log2 of the number of blocks for so many rows, so that a block stays of one size however large the table."""
    return min(MOST_BITS, max(LEAST_BITS, (max(1, rows) // BLOCK_ROWS).bit_length()))


class CountingQuotientFilter:
    """The multiset of 64-bit fingerprints of one block. Fingerprints share their top bits (the block); the next
    QUOTIENT_BITS are the quotient, kept only as the length of its run; the remainders are stored in sorted runs.
    A remainder that occurs more than once has a counter; the others have none."""

    def __init__(self, runs: np.ndarray, remainders: np.ndarray, at: np.ndarray, counts: np.ndarray):
        self.runs, self.remainders, self.at, self.counts = runs, remainders, at, counts

    @staticmethod
    def shift(block_bits: int) -> int:
        return 64 - block_bits - QUOTIENT_BITS

    @classmethod
    def of(cls, prints: np.ndarray, times: np.ndarray, block_bits: int) -> CountingQuotientFilter:
        """prints: sorted, distinct; times: how often each occurs."""
        shift = cls.shift(block_bits)
        if not 0 <= shift <= 48:
            raise ValueError(f"{block_bits} block bits leave remainders of {shift} bits, which 48 can't hold")
        quotients = ((prints >> np.uint64(shift)) & np.uint64((1 << QUOTIENT_BITS) - 1)).astype(np.int64)
        runs = np.bincount(quotients, minlength=1 << QUOTIENT_BITS).astype(np.uint32)
        at = np.flatnonzero(times > 1)
        return cls(runs, prints & np.uint64((1 << shift) - 1), at.astype(np.uint32), times[at].astype(np.int64))

    def entries(self, block: int, block_bits: int) -> tuple[np.ndarray, np.ndarray]:
        shift = self.shift(block_bits)
        high = np.repeat(np.arange(1 << QUOTIENT_BITS, dtype=np.uint64), self.runs) | np.uint64(block << QUOTIENT_BITS)
        times = np.ones(len(self.remainders), np.int64)
        times[self.at] = self.counts
        return (high << np.uint64(shift)) | self.remainders, times

    def pack(self) -> bytes:
        """Occupied quotients with their run lengths, remainders in as many bytes as they need, counters."""
        q = np.flatnonzero(self.runs).astype(np.uint16)
        head = np.array([len(q), len(self.remainders), len(self.at)], np.uint32)
        return b"".join(x.tobytes() for x in (head, q, self.runs[q], self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6], self.at, self.counts))

    @classmethod
    def unpack(cls, data: bytes) -> CountingQuotientFilter:
        nq, n, nc = (int(x) for x in np.frombuffer(data, np.uint32, 3))
        at = 12
        q = np.frombuffer(data, np.uint16, nq, at)
        at += 2 * nq
        runs = np.zeros(1 << QUOTIENT_BITS, np.uint32)
        runs[q] = np.frombuffer(data, np.uint32, nq, at)
        at += 4 * nq
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :6] = np.frombuffer(data, np.uint8, 6 * n, at).reshape(n, 6)
        at += 6 * n
        places = np.frombuffer(data, np.uint32, nc, at)
        return cls(runs, wide.reshape(-1).view("<u8"), places, np.frombuffer(data, np.int64, nc, at + 4 * nc))

    @staticmethod
    def merge(prints: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Joins sorted runs; equal remainders of equal quotients add their counts."""
        p, t = np.concatenate(prints), np.concatenate(times)
        order = np.argsort(p, kind="stable")  # merges the runs that are sorted already
        p, t = p[order], t[order]
        first = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1]))) if len(p) else np.zeros(0, np.int64)
        return p[first], np.add.reduceat(t, first) if len(p) else t


def _build(block_bits: int, flush: int = 1 << 20):
    """Filters of a partition, block by block; at most flush fingerprints are held at once."""

    def blocks(prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        p, t = np.unique(prints, return_counts=True)
        owner = (p >> np.uint64(64 - block_bits)).astype(np.int64)
        at = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        ends = np.append(at[1:], len(p))
        packed = [CountingQuotientFilter.of(p[a:b], t[a:b], block_bits).pack() for a, b in zip(at, ends, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(owner[at], pa.int32()), pa.array(packed, pa.binary())], ["block", "filter"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            n += len(held[-1])
            if n >= flush:
                yield from blocks(np.concatenate(held))
                held, n = [], 0
        if n:
            yield from blocks(np.concatenate(held))

    return run


def _merge(block_bits: int):
    """Merges the filters of each block as they come, sorted by block; gives fingerprints that count above one."""

    def close(block: int, prints: list[np.ndarray], times: list[np.ndarray]) -> pa.RecordBatch:
        p, t = CountingQuotientFilter.merge(prints, times)
        return pa.RecordBatch.from_arrays([pa.array(p[t > 1].view(np.int64)), pa.array(t[t > 1])], ["print", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, prints, times = None, [], []
        for b in batches:
            for block, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if block != now and now is not None:
                    yield close(now, prints, times)
                    prints, times = [], []
                now = block
                p, t = CountingQuotientFilter.unpack(data).entries(block, block_bits)
                prints.append(p)
                times.append(t)
                if len(prints) == 64:  # never more than 64 filters at once beside what they merge to
                    p, t = CountingQuotientFilter.merge(prints, times)
                    prints, times = [p], [t]
        if now is not None:
            yield close(now, prints, times)

    return run


def repeated_prints(prints: DataFrame, block_bits: int) -> DataFrame:
    """prints: one bigint column of 64-bit fingerprints. Returns (print, times) of those that occur more than once."""
    filters = prints.mapInArrow(_build(block_bits), "block int, filter binary")
    dealt = filters.repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(_merge(block_bits), "print bigint, times bigint")


def compare(docs: DataFrame, text: str, doc_id: str, block_bits: int | None) -> DataFrame:
    """One row per row of docs: doc_id, k (row_key), keep_id, keep_k (of the row that stays), group_size, text_sha256; keep_k
    is null for a group of one row."""
    src = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), row_key(F.col(text)).alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    norm = F.regexp_replace("text", f"[{SPACE}]+", "")
    prints = src.select(F.xxhash64(norm).alias("print"))
    again = table(repeated_prints(prints, bits_for(src.count()) if block_bits is None else block_bits), "exact-prints").select("print")
    # Byte verification: only texts whose fingerprint repeats, grouped by the normalised bytes themselves; copies meet
    # in the map-side aggregate first. Length, then smallest id, then part of the row's key, as one number, so that the
    # aggregate can hash: 31, 64 and 30 bits. A null id comes after all others of its length.
    place = F.coalesce(F.expr("9223372036854775807BD - doc_id"), F.expr("-1BD"))
    rank = (F.expr("cast(length(text) as decimal(38,0)) * 18446744073709551616BD") + place).cast("decimal(38,0)")
    rank = (rank * F.expr("1073741824BD") + F.col("k").bitwiseAND(F.lit(KEY_MASK))).cast("decimal(38,0)")
    suspects = src.select(norm.alias("norm"), rank.alias("rank")).withColumn("print", F.xxhash64("norm"))
    suspects = suspects.join(again, "print", "left_semi")
    groups = suspects.groupBy("norm").agg(F.count(F.lit(1)).alias("group_size"), F.max("rank").alias("rank")).where("group_size > 1")
    place = F.expr("cast((rank - rank % 1073741824BD) / 1073741824BD as decimal(38,0)) % 18446744073709551616BD")
    keep = F.when(place <= F.expr("18446744073709551614BD"), F.expr("9223372036854775807BD") - place).cast("bigint")
    best = groups.select(F.sha2("norm", 256).alias("text_sha256"), keep.alias("keep_id"), F.expr("cast(rank % 1073741824BD as bigint)").alias("keep_k"), "group_size")
    best = table(best, "exact-groups")
    rows = src.select("doc_id", "k", F.sha2(norm, 256).alias("text_sha256"))
    out = attach(rows, best, ["text_sha256"])
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select("doc_id", "k", keep_id.alias("keep_id"), "keep_k", F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"), "text_sha256")


def exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", block_bits: int | None = None) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when equal after removing white space; a null text counts as empty, and all empty texts are one
    group. Of equal texts the one with the most code points stays, then the smallest id; a null id comes last. Rows that
    repeat an id count one by one and are all kept or dropped alike. Texts are compared whole, whatever their length; other
    columns are not looked at, so their names can't clash. An empty table gives an empty result.
    """
    out = compare(docs, text, doc_id, block_bits)
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_distinct(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs with one row of each group of equal texts, that which exact_duplicates names; all columns stay. Rows are told
    apart by id and text, so an id that recurs with another text loses neither."""
    rows = table(compare(docs, text, doc_id, None).select(F.col("doc_id").alias("i"), "k", "keep_id", "keep_k"), "exact-rows")
    stays = F.col("keep_k").isNull() | (F.col("i").eqNullSafe(F.col("keep_id")) & (F.col("k").bitwiseAND(F.lit(KEY_MASK)) == F.col("keep_k")))
    gone = rows.where(~stays).select("i", "k").distinct()
    twice = rows.where(stays & F.col("keep_k").isNotNull()).groupBy("i", "k").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("i", "k")
    return without(docs, gone, table(twice, "exact-twice"), text, doc_id)
