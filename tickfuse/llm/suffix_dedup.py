"""Removal of repeated byte strings, one suffix bucket at a time.

Every suffix that is at least WINDOW bytes long belongs to the bucket of its anchor, a sample position that equal
windows share (anchors.py). Neighbouring suffixes of a bucket form runs. A bucket is sorted by the precomputed name of
the run's whole text, which settles all suffixes of equal runs at once, however long the repeat; only buckets that hold
different runs have their bytes fetched and their suffixes compared one by one. Names are two hashes of 64 bits each. README
says how this differs from a difference cover over positions, and why.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import WINDOW, K, runs
from .common import attach, lean, row_key, table
from .words import chunks, mix, prefix, spans

#: A run's place as one number: first window * PACK + windows (a run has fewer than PACK, as its windows share an anchor).
PACK = 128
#: Runs of a bucket that one task compares at once; a bucket of more is cut into parts, whose first suffixes then meet by name.
RUNS = 512
#: Those suffixes meet in blocks of so many offsets of the anchor, by the bytes that all windows of a block share: what has
#: them in one part only is settled, the rest goes on in smaller blocks. The last is a single window.
STEPS = (16, 4, 1)
#: Rows of runs that are looked at together.
ROWS = 2048
LAST = (1 << 63) - 1
#: An anchor that holds this share of all runs is dealt to so many tasks by name. It is looked for in a share of documents;
#: where a run is dealt doesn't change what is found.
HOT, SALTS, LOOKED = 0.001, 64, 64


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for _, off, buf in chunks(pc.fill_null(b.column(0), "")):
            found, n = np.unique(runs(off, buf)["anchor"], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["anchor", "n"])


def hot_anchors(docs: DataFrame, share: float = HOT, looked: int = LOOKED) -> np.ndarray:
    """Anchors that hold at least `share` of the runs in one of `looked` documents, so 1 / share at most."""
    some = docs.where(F.pmod(F.xxhash64("doc", "tag"), F.lit(looked)) == 0).select("text")
    counts = table(some.mapInArrow(lean(_anchors), "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n")), "suffix-anchors")
    total = counts.agg(F.sum("n")).first()[0] or 0
    got = counts.where(F.col("n") >= max(4, share * total)).select("anchor").collect()
    return np.sort(np.array([r["anchor"] for r in got], np.int64)).view(np.uint64)


def _runs(hot: np.ndarray, most: int = 1 << 19):
    """(doc, tag, text) to (key, salt, span, span2, doc, tag, place). A run that equals an earlier one of this task is settled
    here: its place is negative and its key random, so that a frequent passage sends one row per task to its bucket. Runs of
    a hot anchor have a salt above 0, by their name."""

    def give(held: list[tuple]) -> pa.RecordBatch:
        anchor, span, span2, doc, tag, place = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((place, tag, doc, span2, span, anchor))
        anchor, span, span2, doc, tag, place = (x[order] for x in (anchor, span, span2, doc, tag, place))
        again = np.zeros(len(anchor), bool)
        # Equal ids, tags and places are one document that is there twice; neither is before the other.
        again[1:] = (anchor[1:] == anchor[:-1]) & (span[1:] == span[:-1]) & (span2[1:] == span2[:-1])
        first = np.maximum.accumulate(np.where(again, 0, np.arange(len(anchor))))
        settled = (doc != doc[first]) | (tag != tag[first]) | (place != place[first])
        key = np.where(settled, mix(doc.view(np.uint64) * np.uint64(31) + place.view(np.uint64)), anchor)
        salt = np.where(~settled & np.isin(anchor, hot), span2 % np.uint64(SALTS) + np.uint64(1), np.uint64(0)).astype(np.int32)
        names = [pa.array(np.where(settled, np.uint64(0), x).view(np.int64)) for x in (span, span2)]
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(salt), *names, pa.array(doc), pa.array(tag), pa.array(np.where(settled, -place - 1, place))], ["key", "salt", "span", "span2", "doc", "tag", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            docs, tags = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for first, off, buf in chunks(pc.fill_null(b.column(2), "")):
                r = runs(off, buf)
                held.append((r["anchor"], r["span"], r["span2"], docs[first + r["row"]], tags[first + r["row"]], r["start"] * PACK + r["n"]))
                n += len(r["row"])
                if n >= most:
                    yield give(held)
                    held, n = [], 0
        if n:
            yield give(held)

    return run


def _resolve(batches: Iterator[pa.RecordBatch], runs_held: int) -> Iterator[pa.RecordBatch]:
    """Runs sorted by (key, salt, span, span2, doc, tag, place) to (doc, tag, place, anchor, part): repeats of an earlier run
    with a null anchor; and, where a bucket holds several names or is salted, the first run of each with its anchor, numbered
    into parts of `runs_held`. Only the last run is carried on."""
    last: tuple | None = None  # the first run of the name at hand, all columns
    alone = False  # that run is all there is of its bucket so far, and hasn't been given
    numbered, count = (0, 0), 0  # the bucket of the last run given with its anchor, and how many it has given
    for b in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        if not b.num_rows:
            continue
        done = cols[6] < 0
        none = np.zeros(int(done.sum()), np.int64)
        out = {"doc": [cols[4][done]], "tag": [cols[5][done]], "place": [-cols[6][done] - 1], "anchor": [none], "part": [none]}
        real = [none != 0]
        cols = [x[~done] for x in cols]
        if len(cols[0]):
            if last is not None:
                cols = [np.concatenate((np.array([v], x.dtype), x)) for v, x in zip(last, cols, strict=True)]
            key, salt, span, span2, doc, tag, place = cols
            same_key = np.concatenate(([False], (key[1:] == key[:-1]) & (salt[1:] == salt[:-1])))
            same = same_key & np.concatenate(([False], (span[1:] == span[:-1]) & (span2[1:] == span2[:-1])))
            first = np.maximum.accumulate(np.where(same, 0, np.arange(len(key))))
            dup = same & ((doc != doc[first]) | (tag != tag[first]) | (place != place[first]))
            # A name's first run is ambiguous if its bucket has another name: before it, or after it, or in another salt.
            heads = np.flatnonzero(~same)
            later = np.append(same_key[heads[1:]], False)
            unclear = same_key[heads] | later | (salt[heads] > 0)
            given = np.ones(len(heads), bool)
            if last is not None:
                given[0] = alone  # carried over: given before, unless it was alone
            pick = heads[unclear & given]
            begin = np.flatnonzero(np.concatenate((np.ones(min(1, len(pick)), bool), (key[pick[1:]] != key[pick[:-1]]) | (salt[pick[1:]] != salt[pick[:-1]]))))
            number = np.arange(len(pick)) - np.repeat(begin, np.diff(np.append(begin, len(pick))))
            number += np.where((key[pick] == numbered[0]) & (salt[pick] == numbered[1]), count, 0)
            if len(pick):
                numbered, count = (key[pick[-1]], salt[pick[-1]]), int(number[-1]) + 1
            none = np.zeros(int(dup.sum()), np.int64)
            for c, x in (("doc", doc), ("tag", tag), ("place", place)):
                out[c] += [x[dup], x[pick]]
            out["anchor"] += [none, key[pick]]
            out["part"] += [none, (salt[pick].astype(np.int64) << 32) + number // runs_held]
            real += [none != 0, np.ones(len(pick), bool)]
            z = heads[-1]
            alone = bool(given[-1] and not unclear[-1])
            last = tuple(x[z] for x in cols)
        arrays = [pa.array(np.concatenate(out[c]), mask=~np.concatenate(real) if c == "anchor" else None) for c in out]
        yield pa.RecordBatch.from_arrays(arrays, list(out))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, tag, text) to (doc, tag, compressed text), for the way to its task."""
    press = zstandard.ZstdCompressor(level=1)
    for b in batches:
        packed = [press.compress(t) if t is not None else None for t in b.column(2).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(packed, pa.binary())], ["doc", "tag", "packed"])


CONTEXT = {"anchor": pa.int64(), "part": pa.int64(), "doc": pa.int64(), "tag": pa.int64(), "place": pa.int64(), "bytes": pa.binary()}


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, tag, packed, runs) to the bytes of each run."""
    press = zstandard.ZstdDecompressor()

    def give(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), CONTEXT.values(), strict=True)], list(CONTEXT))

    for b in batches:
        rows = []
        for doc, tag, packed, own in zip(*(c.to_pylist() for c in b.columns), strict=True):
            text = press.decompress(packed) if packed is not None else b""
            rows += [(r["anchor"], r["part"], doc, tag, r["place"], text[r["place"] // PACK : r["place"] // PACK + r["place"] % PACK + WINDOW - 1]) for r in own]
            if len(rows) > 50_000:
                yield give(rows)
                rows = []
        if rows:
            yield give(rows)


LEADS = {"doc": pa.int64(), "tag": pa.int64(), "place": pa.int64(), "name": pa.int64(), "name2": pa.int64(), "anchor": pa.int64(), "part": pa.int64(), "left": pa.int64(), "bytes": pa.binary()}


def _left(sums: np.ndarray, begin: np.ndarray, n: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """The anchor's offset in the first window of each run: the first place of its bytes that the run's last window has."""
    size = WINDOW - K + 2 - n
    run = np.repeat(np.arange(len(n)), size)
    at = np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size) + (n - 1)[run]
    hit = spans(sums, begin[run] + at, begin[run] + at + K) == anchor.view(np.uint64)[run]
    out = np.full(len(n), WINDOW - K)
    np.minimum.at(out, run[hit], at[hit])
    return out


def _blocks(sums: list[np.ndarray], begin: np.ndarray, left: np.ndarray, run: np.ndarray, inner: np.ndarray, want: np.ndarray, step: int) -> tuple[np.ndarray, ...]:
    """Maximal runs of wanted windows with anchor offsets in one block of `step`: run, first window in it, windows, and both
    names of the bytes that every window of that block covers, which equal windows have in common."""
    block = (left[run] - inner) // step
    edge = np.ones(len(run), bool)
    edge[1:] = (run[1:] != run[:-1]) | (block[1:] != block[:-1]) | (want[1:] != want[:-1])
    a = np.flatnonzero(edge & want)
    z = np.flatnonzero(np.append(edge[1:], True) & want) + 1
    block, at = block[a], (begin + left)[run[a]]
    most = np.minimum(block * step + step - 1, WINDOW - K)
    names = (mix(spans(p, at - block * step, at + WINDOW - most) ^ block.astype(np.uint64)) for p in sums)
    return run[a], inner[a], z - a, *names


def _finer(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[pa.RecordBatch]:
    """Leads to those of blocks of `step` offsets in them; single windows without bytes."""
    for b in (batch.slice(at, ROWS) for batch in batches for at in range(0, batch.num_rows, ROWS)):
        doc, tag, place, _, _, anchor, part, left = (b.column(i).to_numpy(zero_copy_only=False) for i in range(8))
        text = b.column(8).to_pylist()
        buf = np.frombuffer(b"".join(text), np.uint8)
        begin = np.concatenate(([0], np.cumsum([len(t) for t in text])))[:-1].astype(np.int64)
        n = place % PACK
        run = np.repeat(np.arange(len(n)), n)
        inner = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
        r, first, size, name, name2 = _blocks([prefix(buf, t) for t in (0, 1)], begin, left, run, inner, np.ones(len(run), bool), step)
        own = [text[i][a : a + m + WINDOW - 1] if step > 1 else None for i, a, m in zip(r.tolist(), first.tolist(), size.tolist(), strict=True)]
        cols = [doc[r], tag[r], (place[r] // PACK + first) * PACK + size, name.view(np.int64), name2.view(np.int64), anchor[r], part[r], left[r] - first, own]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, LEADS.values(), strict=True)], list(LEADS))


def _compare(batches: Iterator[pa.RecordBatch], runs_held: int) -> Iterator[pa.RecordBatch]:
    """Runs with their bytes, sorted by (anchor, part, doc, tag, place), to the suffixes that start earlier too in their part,
    as runs (doc, tag, place) of null name; and, of buckets that have several parts, the first suffix of each name, in blocks
    of the first of STEPS with their names, anchor, part and bytes. What is held is whole parts, of at most `runs_held` runs
    each."""

    def close(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        all_ = pa.Table.from_batches(held).combine_chunks()
        anchor, part, doc, tag, place = (all_.column(i).to_numpy() for i in range(5))
        text = all_.column(5).to_pylist()
        new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])))
        size = np.diff(np.append(np.flatnonzero(new), len(new)))
        several = np.repeat((part[new] > 0) | (size >= runs_held), size)  # a full first part may have a second
        n = place % PACK
        whole = np.array([len(t) for t in text]) >= n + WINDOW - 1
        anchor, part, doc, tag, place, n, several = (x[whole] for x in (anchor, part, doc, tag, place, n, several))
        text = [t for t, ok in zip(text, whole.tolist(), strict=True) if ok]
        if not len(n):
            return pa.RecordBatch.from_arrays([pa.array([], k) for k in LEADS.values()], list(LEADS))
        buf = np.frombuffer(b"".join(text), np.uint8)
        begin = np.concatenate(([0], np.cumsum([len(t) for t in text])))[:-1].astype(np.int64)
        run = np.repeat(np.arange(len(n)), n)
        inner = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
        s = begin[run] + inner
        sums = [prefix(buf, t) for t in (0, 1)]
        name, name2 = (spans(p, s, s + WINDOW) for p in sums)
        wdoc, wtag, start = doc[run], tag[run], (place // PACK)[run] + inner
        bucket = np.cumsum(np.concatenate(([0], ((anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])).astype(np.int64))))[run]
        order = np.lexsort((start, wtag, wdoc, name2, name, bucket))
        head = np.ones(len(order), bool)
        head[1:] = (name[order][1:] != name[order][:-1]) | (name2[order][1:] != name2[order][:-1]) | (bucket[order][1:] != bucket[order][:-1])
        first = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
        d, lead = np.zeros(len(order), bool), np.zeros(len(order), bool)
        differs = np.zeros(len(order), bool)
        for x in (wdoc, wtag, start):
            differs |= x[order] != x[order][first]
        d[order], lead[order] = differs, head
        lead &= several[run]
        edge = np.ones(len(d), bool)
        edge[1:] = (run[1:] != run[:-1]) | (d[1:] != d[:-1])
        starts = np.flatnonzero(edge & d)
        ends = np.flatnonzero(np.append(edge[1:], True) & d) + 1
        none, places = [None] * len(starts), start[starts] * PACK + (ends - starts)
        if not lead.any():
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((wdoc[starts], wtag[starts], places, *[none] * 6), LEADS.values(), strict=True)], list(LEADS))
        left = _left(sums[0], begin, n, anchor)
        r, first, size, *names = _blocks(sums, begin, left, run, inner, lead, STEPS[0])
        own = [text[i][x : x + m + WINDOW - 1] for i, x, m in zip(r.tolist(), first.tolist(), size.tolist(), strict=True)]
        unknown = np.arange(len(starts) + len(r)) < len(starts)
        known = [pa.array(np.concatenate((np.zeros(len(starts), np.int64), x)), mask=unknown) for x in (*(y.view(np.int64) for y in names), anchor[r], part[r], left[r] - first)]
        places = np.concatenate((places, (place[r] // PACK + first) * PACK + size))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate((doc[run[starts]], doc[r]))), pa.array(np.concatenate((tag[run[starts]], tag[r]))), pa.array(places), *known, pa.array(none + own, pa.binary())], list(LEADS))

    held: list[pa.RecordBatch] = []
    for b in (batch.slice(at, ROWS) for batch in batches for at in range(0, batch.num_rows, ROWS)):
        anchor, part = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        cut = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1]))))
        if held and (held[-1].column(0)[-1].as_py(), held[-1].column(1)[-1].as_py()) != (anchor[0], part[0]):
            yield close(held)
            held = []
        if cut[-1]:  # all but the last part of the batch is whole
            yield close([*held, b.slice(0, cut[-1])])
            held = []
        held.append(b.slice(cut[-1]))
    if held:
        yield close(held)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, packed, places) to what is left of each text."""
    press = zstandard.ZstdDecompressor()
    for b in batches:
        rows = []
        for doc, packed, own in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            text = press.decompress(packed) if packed is not None else b""
            places = own.values.to_numpy(zero_copy_only=False) if own.is_valid else np.zeros(0, np.int64)
            if not len(places):
                rows.append((doc, len(text), 0, 0, hashlib.sha256(text).hexdigest()))
                continue
            mark = np.zeros(len(text) + 1, np.int32)
            np.add.at(mark, np.minimum(places // PACK, len(text)), 1)
            np.add.at(mark, np.minimum(places // PACK + places % PACK + WINDOW - 1, len(text)), -1)
            gone = np.cumsum(mark[:-1]) > 0
            rest = np.frombuffer(text, np.uint8)[~gone].tobytes()
            rows.append((doc, len(text), int(gone.sum()), int((gone & ~np.concatenate(([False], gone[:-1]))).sum()), hashlib.sha256(rest).hexdigest()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_runs(docs: DataFrame, runs_held: int = RUNS, hot: np.ndarray | None = None) -> DataFrame:
    """docs: doc, tag (bigint), text. Returns (doc, tag, place): runs of windows that also start earlier, as start * PACK + windows."""
    hot = hot_anchors(docs) if hot is None else hot
    found = docs.mapInArrow(lean(_runs(hot)), "key bigint, salt int, span bigint, span2 bigint, doc bigint, tag bigint, place bigint")
    dealt = found.repartition("key", "salt").sortWithinPartitions("key", "salt", "span", "span2", "doc", "tag", "place")
    found = table(dealt.mapInArrow(lean(lambda b: _resolve(b, runs_held)), "doc bigint, tag bigint, place bigint, anchor bigint, part bigint"), "suffix-runs")
    # A document's list is of its own runs, fewer bytes than its text.
    unclear = found.where("anchor is not null").groupBy("doc", "tag").agg(F.collect_list(F.struct("place", "anchor", "part")).alias("runs"))
    packed = docs.mapInArrow(lean(_pack), "doc bigint, tag bigint, packed binary")
    texts = packed.join(unclear, ["doc", "tag"]).select("doc", "tag", "packed", "runs").mapInArrow(lean(_contexts), "anchor bigint, part bigint, doc bigint, tag bigint, place bigint, bytes binary")
    parts = texts.repartition("anchor", "part").sortWithinPartitions("anchor", "part", "doc", "tag", "place")
    leads = "doc bigint, tag bigint, place bigint, name bigint, name2 bigint, anchor bigint, part bigint, left bigint, bytes binary"
    more = table(parts.mapInArrow(lean(lambda b: _compare(b, runs_held)), leads), "suffix-windows")
    # The names grow with the input: sorted, never broadcast.
    named, name = more.where("name is not null"), ["anchor", "name", "name2"]
    for step in STEPS[1:]:
        shared = named.groupBy(*name).agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a <> b").select(*name)
        named = table(attach(named, shared.hint("merge"), name, "inner").mapInArrow(lean(lambda b, step=step: _finer(b, step)), leads), "suffix-blocks")
    # A name has at most one suffix here from each part of its bucket; all but the earliest of them go.
    place = F.struct("doc", "tag", "place")
    across = attach(named, named.groupBy(*name).agg(F.min(place).alias("least")).hint("merge"), name, "inner").where(place != F.col("least"))
    cols = ["doc", "tag", "place"]
    settled = found.where("anchor is null").select(cols).unionByName(more.where("name is null").select(cols))
    return settled.unionByName(across.select(cols))


def repeated_bytes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", runs_held: int = RUNS, hot: np.ndarray | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if a WINDOW-byte string over it also starts earlier, in a document of a smaller id or before in the same
    one; strings never cross documents and are judged on the input. A null text is empty; a null id comes after all
    others. Rows that repeat an id with its text are one document that is there twice: treated alike, none before the other.
    Rows that repeat an id (or null) with another text are documents of their own, in the order of a hash of their texts.
    Texts shorter than WINDOW bytes stay whole; long ones are worked on in pieces, but a text and its list of places must fit
    into a task. Other columns are not looked at. An empty table gives an empty result.
    """
    src = docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST)).alias("doc"), F.col(text).cast("string").alias("text"))
    key = row_key(F.col("text"))
    clash = table(src.groupBy("doc").agg(F.min(key).alias("a"), F.max(key).alias("b")).where("a <> b").select("doc", F.lit(True).alias("clash")), "suffix-clashes")
    none = F.lit(0).cast("bigint")
    if clash.isEmpty():
        src = src.select("doc", none.alias("tag"), "text")
    else:
        src = attach(src, clash, ["doc"]).select("doc", F.when(F.col("clash"), key).otherwise(none).alias("tag"), "text")
    gone = repeated_runs(src, runs_held, hot).groupBy("doc", "tag").agg(F.collect_list("place").alias("places"))
    packed = src.mapInArrow(lean(_pack), "doc bigint, tag bigint, packed binary")
    out = packed.join(gone, ["doc", "tag"], "left").select("doc", "packed", "places").mapInArrow(lean(_cut), "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    return out.select(F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
