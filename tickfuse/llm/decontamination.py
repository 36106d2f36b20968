"""Benchmark decontamination by pigeonhole edit matching.

A test item with an error budget of k edits is cut into k + 1 pieces; a copy within the budget has at least one piece
unchanged. Pieces are found by one automaton over each text. The pieces are the leaves of a binary tree: a stretch of n
pieces with fewer than n edits has a half of which the same is true, so a hit counts only if it holds from its leaf up to
the root, and most chance hits end beside the leaf. What is left is verified by Myers' bit-parallel edit distance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks_for, lean, open_fs, shared_path

#: Edits as a share of an item's length; items of fewer characters are matched exactly, as whole words.
RATE, ITEM = 0.1, 24
#: Bytes of items in one automaton, and bytes of texts that a task holds while it goes from automaton to automaton.
BLOCK_BYTES, HELD_BYTES = 4 << 20, 32 << 20
HITS = "array<struct<item_id:bigint,edits:int,stop:int>>"
_WORD = re.compile(r"[^\W_]+")


def normalise(text: str) -> str:
    """Lower case; words of letters and digits, one space between."""
    return " ".join(_WORD.findall(text.lower()))


def pieces(item: str, rate: float = RATE) -> tuple[int, list[tuple[int, str]]]:
    """The error budget k, and k + 1 pieces with their offsets."""
    k = int(rate * len(item))
    cuts = [i * len(item) // (k + 1) for i in range(k + 2)]
    return k, [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def masks_of(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


#: A stretch of pieces: offset, characters, edits it may have, masks, and what of it is probed: (from, to, text).
Node = tuple[int, int, int, dict[str, int], list[tuple[int, int, str]]]


def climbs(item: str, own: list[tuple[int, str]]) -> list[list[Node]]:
    """For each piece the stretches around it, from the smallest to the last before the whole item.

    A stretch of n pieces may have n - 1 edits. If the rest of the smallest one beside the leaf is cut into n parts, one of
    them is unchanged, at most n - 1 characters off its place; these parts are the probes.
    """
    ends = [a for a, _ in own] + [len(item)]
    out: list[list[Node]] = [[] for _ in own]

    def split(i: int, j: int) -> None:
        if j - i > 1:
            mid = (i + j) // 2
            split(i, mid)
            split(mid, j)
            a, n = ends[i], j - i
            masks = masks_of(item[a : ends[j]])
            for leaf in range(i, j):
                probes = []
                if not out[leaf]:
                    sides = [(a, ends[leaf]), (ends[leaf + 1], ends[j])]
                    # n parts over both sides at least: as many for each side that there is.
                    for x, y in sides:
                        cuts = [x + q * (y - x) // n for q in range(n + 1)]
                        probes += [(p, q, item[p:q]) for p, q in zip(cuts, cuts[1:], strict=False)] if y > x else []
                out[leaf].append((a, ends[j] - a, n - 1, masks, probes))

    split(0, len(own))
    return [c[:-1] for c in out]


def myers(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of a pattern of m characters to any substring of text, and where the first such one ends."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, at = m, 0
    get = masks.get
    for i, c in enumerate(text):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
        if score < best:
            best, at = score, i + 1
    return best, at


class Matcher:
    """Finds items of one block in texts."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float = RATE, shortest: int = ITEM):
        self.items, places = [], {}
        for item_id, text in items:
            norm = normalise(text or "")
            if not norm:
                continue
            k, own = pieces(norm, rate) if len(norm) >= shortest else (0, [(0, norm)])
            for (offset, piece), climb in zip(own, climbs(norm, own), strict=True):
                places.setdefault(piece, []).append((len(self.items), offset, climb))
            self.items.append((item_id, norm, k, masks_of(norm), len(norm) < shortest))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    @staticmethod
    def holds(text: str, at: int, climb: list[Node]) -> bool:
        """Whether each stretch around a hit may be there; at is where the item would start."""
        for a, size, edits, masks, probes in climb:
            if probes:
                for p, q, part in probes:
                    if text.find(part, max(0, at + p - edits), max(0, at + q + edits)) >= 0:
                        break
                else:
                    return False
            if myers(masks, size, text[max(0, at + a - edits) : max(0, at + a + size + edits)])[0] > edits:
                return False
        return True

    def find(self, text: str | None) -> list[dict]:
        """Items within their budget in text: id, edits, and where the best copy ends in the normalised text."""
        if not text or not self.items:
            return []
        norm = normalise(text)
        windows: dict[int, list[list[int]]] = {}
        for end, (size, where) in self.automaton.iter(norm):
            for i, offset, climb in where:
                _, item, k, _, whole = self.items[i]
                at = end + 1 - size - offset
                if whole and (norm[max(0, at - 1) : at].strip() or norm[end + 1 : end + 2].strip()):
                    continue
                a, b = max(0, at - k), at + len(item) + k
                own = windows.get(i)
                if own and own[-1][0] <= a and b <= own[-1][1]:
                    continue
                if climb and not self.holds(norm, at, climb):
                    continue
                if own is None:
                    windows[i] = [[a, b]]
                elif a <= own[-1][1]:  # hits come by place, so windows of an item join up
                    own[-1][0], own[-1][1] = min(a, own[-1][0]), max(b, own[-1][1])
                else:
                    own.append([a, b])
        found = []
        for i, own in windows.items():
            item_id, item, k, masks, whole = self.items[i]
            best, at = k + 1, 0
            for a, b in own:
                exact = -1 if whole else norm.find(item, a, b)
                if whole:
                    edits, stop = 0, len(item)
                else:
                    edits, stop = (0, exact + len(item) - a) if exact >= 0 else myers(masks, len(item), norm[a:b])
                if edits < best:
                    best, at = edits, a + stop
            if best <= k:
                found.append({"item_id": item_id, "edits": best, "stop": at})
        return sorted(found, key=lambda h: (h["item_id"] is None, h["item_id"]))


def write_items(benchmark: DataFrame, item_id: str, text: str) -> tuple[str, int]:
    """Writes the test items into the shared folder, in blocks of bounded bytes; returns the folder and the number of blocks.
    Only their total is with the driver."""
    items = benchmark.select(F.col(item_id).cast("bigint").alias("i"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    n = blocks_for(int(items.agg(F.sum(F.octet_length("t"))).first()[0] or 0), BLOCK_BYTES)
    folder = shared_path(benchmark.sparkSession, "benchmark-items")
    blocks = items.withColumn("block", F.pmod(F.xxhash64("t"), F.lit(n)).cast("int"))
    blocks.repartition(min(n, 1024), "block").write.partitionBy("block").parquet(folder)
    return folder, n


_LOADED: dict[tuple[str, int], Matcher] = {}


def matcher_of(folder: str, block: int) -> Matcher:
    """The matcher of a block of items; a worker holds one at a time, and keeps it for its next task."""
    if (folder, block) not in _LOADED:
        _LOADED.clear()
        fs, root = open_fs(folder)
        files = fs.get_file_info(pafs.FileSelector(f"{root}/block={block}", allow_not_found=True))
        rows = [pq.read_table(f.path, filesystem=fs, columns=["i", "t"], partitioning=None) for f in files if f.path.endswith(".parquet")]
        items = [(i, t) for r in rows for i, t in zip(r.column("i").to_pylist(), r.column("t").to_pylist(), strict=True)]
        _LOADED[folder, block] = Matcher(sorted(items, key=lambda x: (x[0] is None, x[0] or 0, x[1])))
    return _LOADED[folder, block]


def matched(batches: Iterator[pa.RecordBatch], column: str, folder: str, n: int) -> Iterator[tuple[pa.RecordBatch, list[list[dict]]]]:
    """Batches with the hits of each row. With several blocks of items, batches are held up to HELD_BYTES and each block is
    loaded once for all of them, so that a text goes through Python once however many blocks there are."""

    def search(held: list[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[dict]]]]:
        hits: list[list[list[dict]]] = [[[] for _ in range(b.num_rows)] for b in held]
        for block in range(n):
            find = matcher_of(folder, block).find
            for b, own in zip(held, hits, strict=True):
                for row, t in zip(own, b.column(b.schema.get_field_index(column)), strict=True):
                    row.extend(find(t.as_py()))
        yield from zip(held, hits, strict=True)

    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if n == 1 or size >= HELD_BYTES:
            yield from search(held)
            held, size = [], 0
    if held:
        yield from search(held)


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """One row per row of docs: doc_id, contaminated, n_items, item_ids, hits (item, edits, end in the normalised text).

    An item is found where a stretch of a text is within int(RATE * its length) edits of it, both normalised to words of
    letters and digits in lower case; every item has this budget, none is left out for its length. Items shorter than ITEM
    normalised characters are found as they are (no edit), on word bounds; those without a letter or digit have nothing to
    be searched for. Equal items are each reported. A null or empty text is never contaminated. Rows that repeat give equal results;
    empty tables give empty results or no hits. Texts are searched whole; a text must fit into a task. Other columns are not
    looked at, so their names can't clash.
    """
    folder, n = write_items(benchmark, item_id, item_text)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("stop", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, hits in matched(batches, "text", folder, n):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(hits, kind)], ["doc_id", "hits"])

    src = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    out = src.mapInArrow(lean(run), f"doc_id bigint, hits {HITS}")
    ids = F.transform("hits", lambda h: h["item_id"])
    return out.select("doc_id", (F.size("hits") > 0).alias("contaminated"), F.size("hits").cast("bigint").alias("n_items"), ids.alias("item_ids"), "hits")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """docs without the contaminated rows; all columns stay, whatever their names, and no row moves to another task."""
    folder, n = write_items(benchmark, item_id, item_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, hits in matched(batches, text, folder, n):
            yield b.filter(pa.array([not h for h in hits], pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)
