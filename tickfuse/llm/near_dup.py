"""N-gram Jaccard join by MinHash banding.

Equal word sequences first become one representative. Bands of MinHash values deal representatives into buckets.
Buckets that overlap are put together: each goes to the site of the least band hash that any of its members has, so that
near copies, which share most of their bands, meet once and not once a band. A site reaches two buckets far at most;
nothing chains further before it is verified. At their sites, pairs that share a bucket are verified on their full shingle sets,
block against block, so that no pair is ever a row, and a hot site is many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, lean, row_key, table, without
from .components import components
from .words import _ODD, chunks, hashes, mix, sequences, words

SHINGLE, SIMILARITY, RECALL, ROWS = 5, 0.8, 0.996, 8
#: A site is cut into about PARTS blocks, of LEAST to MOST representatives and so many shingles each.
PARTS, LEAST, MOST, BLOCK_SHINGLES = 12, 128, 4096, 4 << 20


def bands_for(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS) -> int:
    """Bands of so many rows that a pair of this similarity meets in one with probability `recall`."""
    b = 1
    while 1 - (1 - similarity**rows) ** b < recall:
        b += 1
    return b


def shingles(off: np.ndarray, buf: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a chunk: shingle hashes, the row of each (sorted), and two hashes of each row's word sequence. A text of
    fewer words than a shingle has its whole sequence as the one shingle; a text without words has none."""
    n = len(off) - 1
    s, e, rows = words(off, buf)
    h, other = hashes(buf, s, e)
    cut = np.searchsorted(rows, np.arange(n + 1))
    ids = sequences(h, other, cut)
    if len(h) >= size:
        x = h[: len(h) - size + 1].copy()
        for k in range(1, size):
            x = x * _ODD + h[k : len(h) - size + 1 + k]
        whole = rows[: len(x)] == rows[size - 1 :]
        x, r = mix(x[whole]), rows[: len(x)][whole]
    else:
        x, r = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    few = np.flatnonzero((np.diff(cut) > 0) & (np.diff(cut) < size))
    if len(few):
        x, r = np.concatenate((x, ids[few, 0].view(np.uint64))), np.concatenate((r, few))
        order = np.argsort(r, kind="stable")
        x, r = x[order], r[order]
    return x, r, ids[:, 0], ids[:, 1]


def signatures(x: np.ndarray, r: np.ndarray, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have shingles, and their band hashes (64 bits; the band's number is part of the hash)."""
    starts = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1]))) if len(r) else np.zeros(0, np.int64)
    if not len(starts):
        return starts, np.zeros((0, bands), np.uint64)
    mult = np.random.default_rng(11).integers(1, 1 << 32, (bands, rows), dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    add = np.random.default_rng(12).integers(0, 1 << 32, (bands, rows), dtype=np.uint64).astype(np.uint32)
    x32, out = (x >> np.uint64(32)).astype(np.uint32), np.zeros((len(starts), bands), np.uint64)
    for b in range(bands):
        acc = np.full(len(starts), b + 1, np.uint64)
        for k in range(rows):
            acc = mix(acc * _ODD + np.minimum.reduceat(x32 * mult[b, k] + add[b, k], starts))
        out[:, b] = acc
    return r[starts], out


def _sign(bands: int, rows: int):
    """(doc_id, k, text) to (doc_id, k, h1, h2, n, bands)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, off, buf in chunks(pc.utf8_lower(pc.fill_null(batch.column(2), ""))):
                n = len(off) - 1
                x, r, h1, h2 = shingles(off, buf)
                count = np.bincount(r, minlength=n)
                have, sig = signatures(x, r, bands, rows)
                size = np.zeros(n + 1, np.int32)
                size[have + 1] = bands
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(size, dtype=np.int32)), pa.array(sig.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), batch.column(1).slice(first, n), pa.array(h1), pa.array(h2), pa.array(count.astype(np.int32)), lists], ["doc_id", "k", "h1", "h2", "n", "bands"])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, text) to (node, sorted distinct shingles)."""
    for batch in batches:
        for first, off, buf in chunks(pc.utf8_lower(pc.fill_null(batch.column(1), ""))):
            n = len(off) - 1
            x, r, _, _ = shingles(off, buf)
            cut = np.searchsorted(r, np.arange(n + 1))
            sets = [np.unique(x[a:b]).tobytes() for a, b in zip(cut, cut[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.array(sets, pa.binary())], ["node", "shingles"])


def overlaps(a: list[np.ndarray], b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets a[i], b[j]: pair by pair, or as a blocked matrix product where that's less."""
    if len(i) < 64:
        return np.array([np.intersect1d(a[x], b[y], assume_unique=True).size for x, y in zip(i, j, strict=True)], np.int64)
    sizes = [len(s) for s in a] + [len(s) for s in b]
    flat, owner = np.concatenate([*a, *b]), np.repeat(np.arange(len(sizes)), sizes)
    _, ids, df = np.unique(flat, return_inverse=True, return_counts=True)
    more = df > 1
    number = np.cumsum(more) - 1
    own, ids = owner[more[ids]], number[ids[more[ids]]]
    width = int(more.sum())
    pairwise, product = 3e-8 * len(i) * (sum(sizes) / len(sizes)) * 2 + 1.5e-5 * len(i), 2e-10 * len(a) * len(b) * width
    if pairwise < product:
        return np.array([np.intersect1d(a[x], b[y], assume_unique=True).size for x, y in zip(i, j, strict=True)], np.int64)
    out, order = np.zeros((len(a), len(b)), np.float32), np.argsort(ids, kind="stable")
    own, ids = own[order], ids[order]
    for c in range(0, width, 1024):
        at = slice(np.searchsorted(ids, c), np.searchsorted(ids, c + 1024))
        m = np.zeros((len(sizes), min(1024, width - c)), np.float32)
        m[own[at], ids[at] - c] = 1
        out += m[: len(a)] @ m[len(a) :].T
    return out[i, j].astype(np.int64)


def link(nodes: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], bands: np.ndarray, here: np.ndarray, lower: np.ndarray, left: np.ndarray, same: bool, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of a block pair: for each representative, the documents that it is linked to, and the smallest
    representative that its links reach here. here and lower: which of a row's bands have this site, or a smaller one (a
    pair that shares one of those is verified there). left: which rows are of the first block; same: both are one block."""
    la = np.flatnonzero(left) if not same else np.arange(len(nodes))
    lb = np.flatnonzero(~left) if not same else la
    i, j = [], []
    for k, x in enumerate(la):
        others = lb[k + 1 :] if same else lb
        own, less = np.flatnonzero(here[x]), np.flatnonzero(lower[x])
        y = others[(bands[others][:, own] == bands[x, own]).any(1)]
        if len(less) and len(y):
            y = y[~(bands[y][:, less] == bands[x, less]).any(1)]
        i.append(np.full(len(y), k))
        j.append(np.searchsorted(lb, y))
    i, j = np.concatenate(i) if i else np.zeros(0, int), np.concatenate(j) if j else np.zeros(0, int)
    na, nb = np.array([len(sets[x]) for x in la]), np.array([len(sets[x]) for x in lb])
    fits = np.minimum(na[i], nb[j]) >= similarity * np.maximum(na[i], nb[j]) - 1e-9  # else the sizes alone rule it out
    i, j = i[fits], j[fits]
    both = overlaps([sets[x] for x in la], [sets[x] for x in lb], i, j) if len(i) else np.zeros(0, np.int64)
    good = both >= similarity * (na[i] + nb[j] - both) - 1e-9
    x, y = la[i[good]], lb[j[good]]
    links = np.bincount(x, copies[y], minlength=len(nodes)) + np.bincount(y, copies[x], minlength=len(nodes))
    order = np.argsort(nodes, kind="stable")
    root = np.empty(len(nodes), np.int64)
    root[order] = np.arange(len(nodes))  # by rank of the node, so that the smallest node wins
    while len(x):
        before = root.copy()
        np.minimum.at(root, x, root[y])
        np.minimum.at(root, y, root[x])
        root = np.minimum(root, root[order[root]])
        if (root == before).all():
            break
    return links.astype(np.int64), nodes[order[root]]


def _verify(similarity: float, bands: int):
    """Block pairs, each the consecutive rows of one (site, i, j), to (node, links, root) of linked nodes."""

    def close(rows: pa.Table) -> pa.RecordBatch | None:
        node = rows.column("node").to_numpy()
        one = np.concatenate(([True], node[1:] != node[:-1]))  # equal rows of the input are one representative
        if one.sum() < 2:
            return None
        rows = rows.filter(pa.array(one))
        i, j, block, copies, here, lower = (rows.column(c).to_numpy() for c in ("i", "j", "block", "copies", "here", "lower"))
        sets = [np.frombuffer(x, np.uint64) for x in rows.column("shingles").to_pylist()]
        own = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, bands)
        flags = [(m[:, None] >> np.arange(bands)) & 1 == 1 for m in (here, lower)]
        links, root = link(node[one], copies, sets, own, *flags, block == i[0], bool(i[0] == j[0]), similarity)
        on = links > 0
        return pa.RecordBatch.from_arrays([pa.array(node[one][on]), pa.array(links[on]), pa.array(root[on])], ["node", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last: tuple | None = None
        for b in batches:
            if not b.num_rows:
                continue
            site, i, j = (b.column(c).to_numpy() for c in range(3))
            cut = [0, *(np.flatnonzero((site[1:] != site[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1).tolist(), b.num_rows]
            for a, z in zip(cut, cut[1:], strict=False):
                if last != (site[a], i[a], j[a]):
                    if held and (done := close(pa.Table.from_batches(held))):
                        yield done
                    held, last = [], (site[a], i[a], j[a])
                held.append(b.slice(a, z - a))
        if held and (done := close(pa.Table.from_batches(held))):
            yield done

    return run


def candidates(reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """reps: node, n, copies, bands. The representatives that share a bucket (a column), and a row for each of them, site
    that it meets others at, and pair of blocks: site, i, j, node, block, copies, here, lower, bands."""
    dealt = reps.select("node", F.posexplode("bands").alias("at", "bucket"))
    full = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("bucket")
    members = table(attach(dealt, full, ["bucket"], "inner"), "near-members")
    lows = members.groupBy("node").agg(F.min("bucket").alias("low"))
    sites = attach(members, lows, ["node"], "inner").groupBy("bucket").agg(F.min("low").alias("site"))
    each = attach(members, sites, ["bucket"], "inner").groupBy("node", "site").agg(F.sum(F.expr("1L << at")).alias("here"))
    own = each.groupBy("node").agg(F.collect_list(F.struct("site", "here")).alias("sites"))  # at most one a band
    cand = table(own.join(reps, "node").select("node", "n", "copies", "sites", "bands"), "near-candidates")
    less = F.aggregate("sites", F.lit(0).cast("bigint"), lambda acc, s: F.when(s["site"] < F.col("s.site"), acc.bitwiseOR(s["here"])).otherwise(acc))
    placed = cand.withColumn("s", F.explode("sites")).withColumn("lower", less)
    sizes = cand.select("n", F.explode("sites.site").alias("site")).groupBy("site").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("s")).where("m > 1")
    size = F.least(F.greatest(F.ceil(F.col("m") / PARTS), F.lit(LEAST)), F.lit(MOST))
    blocks = sizes.select("site", F.greatest(F.ceil(F.col("m") / size), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = placed.select(F.col("s.site").alias("site"), "node", "copies", F.col("s.here").alias("here"), "lower", "bands")
    placed = attach(placed, blocks, ["site"], "inner").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return cand.select("node"), pairs.select("site", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "block", "copies", "here", "lower", "bands")


def classify(docs: DataFrame, text: str, doc_id: str, similarity: float, recall: float, rows: int) -> DataFrame:
    """One row per row of docs: doc_id, k (row_key), class_id, n_links, copies, kept (the row's text and id are those of the
    document that its class keeps)."""
    bands = bands_for(similarity, recall, rows)
    src = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), row_key(F.col(text)).alias("k"), F.col(text).cast("string").alias("text"))
    signed = table(src.mapInArrow(lean(_sign(bands, rows)), "doc_id bigint, k bigint, h1 bigint, h2 bigint, n int, bands array<bigint>"), "near-signatures")
    some = signed.where("n > 0")
    # The first row of each word sequence names its place in the tables; nodes are numbers of their own, as ids may repeat.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k"))
    reps = some.groupBy("h1", "h2").agg(first.alias("f"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    reps = reps.select(F.monotonically_increasing_id().alias("node"), "h1", "h2", "f.doc_id", "f.k", "copies", "n", "bands")
    reps = table(reps, "near-representatives")
    met, pairs = candidates(reps)
    ids = reps.join(met, "node").select("node", F.col("doc_id").alias("d"), F.col("k").alias("kk"))
    texts = src.join(ids, src["doc_id"].eqNullSafe(ids["d"]) & (src["k"] == ids["kk"])).select("node", "text")
    sets = texts.mapInArrow(lean(_sets), "node bigint, shingles binary")
    pairs = pairs.join(sets, "node").select("site", "i", "j", "node", "block", "copies", "shingles", "bands", "here", "lower")
    pairs = pairs.repartition("site", "i", "j").sortWithinPartitions("site", "i", "j", "node")
    found = table(pairs.mapInArrow(lean(_verify(similarity, bands)), "node bigint, links bigint, root bigint"), "near-links")
    links = found.groupBy("node").agg(F.sum("links").alias("others"))
    joined = table(components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))).join(links, "node"), "near-components")
    # Of a class, the row of the smallest id stays; ids that are null come last.
    own = joined.join(reps.select("node", "doc_id", "h1"), "node")
    leads = own.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h1", "node")).alias("l"))
    grouped = attach(joined, leads, ["root"], "inner").select("node", "others", F.col("l.doc_id").alias("first_id"), F.coalesce("l.doc_id", "l.h1").alias("class_id"), (F.col("l.node") == F.col("node")).alias("lead"))
    alone = [F.coalesce("first_id", "doc_id").alias("first_id"), F.coalesce("class_id", "doc_id", "h1").alias("class_id"), F.coalesce("others", F.lit(0).cast("bigint")).alias("others"), F.coalesce("lead", F.lit(True)).alias("lead")]
    known = table(attach(reps, grouped, ["node"]).select("h1", "h2", F.col("k").alias("first_k"), "copies", *alone), "near-classes")
    out = attach(some.select("doc_id", "k", "h1", "h2"), known, ["h1", "h2"])
    kept = F.col("lead") & F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("k") == F.col("first_k"))
    out = out.select("doc_id", "k", "class_id", (F.col("others") + F.col("copies") - 1).alias("n_links"), "copies", kept.alias("kept"))
    one = F.lit(1).cast("bigint")
    bare = signed.where("n = 0").select("doc_id", "k", F.col("doc_id").alias("class_id"), (one - 1).alias("n_links"), one.alias("copies"), F.lit(True).alias("kept"))
    return out.unionByName(bare)


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS) -> DataFrame:
    """One row per row of docs: doc_id, class_id, n_links, copies.

    Two documents are linked if their sets of five-word shingles (words between white space, in lower case) have a
    Jaccard similarity of at least `similarity`; class_id is the smallest id that links reach, n_links how many other
    documents this one is linked to, copies how many rows have its word sequence. Texts without words (null, empty,
    white space) have no shingle and are each a class of their own. Texts of fewer words than a shingle are linked to
    equal sequences only. Rows that repeat an id are rows of their own, whatever their texts. A class of rows with null
    ids only is named by a hash of a text of it. An empty table stays empty; other columns are not looked at, and a text's length
    is bounded by a task's memory only (a text is one chunk).
    Pairs are found with probability `recall` at the threshold, and more above it; links are exact but for chance
    collisions of 64-bit shingle hashes, and word sequences are told apart by 128 bits.
    """
    return classify(docs, text, doc_id, similarity, recall, rows).select("doc_id", "class_id", "n_links", "copies")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS) -> DataFrame:
    """docs with one row of each class, that of the smallest id; all columns stay, whatever their names. Rows are told
    apart by id and text, so an id that recurs with a text of another class loses neither. Texts without words stay."""
    all_ = table(classify(docs, text, doc_id, similarity, recall, rows).select(F.col("doc_id").alias("i"), "k", "copies", "kept"), "near-kept")
    gone = all_.where("not kept").select("i", "k").distinct()
    twice = table(all_.where("kept and copies > 1").groupBy("i", "k").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("i", "k"), "near-twice")
    return without(docs, gone, twice, text, doc_id)
