"""A quality classifier by nearest-neighbour voting in a latent-semantic space.

A bounded sample of labelled documents gives terms (hashed words, bytes, word shapes), their weights and a truncated
singular value decomposition. The sample's latent vectors, with labels, are broadcast; each document's cosine with all
of them is computed exactly, block by block, and its nearest neighbours vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, lean
from .words import chunks, hashes, words

#: Labelled documents to fit on at most; the broadcast is bounded by it: SAMPLE * DIMS floats and the projection.
SAMPLE, DIMS, NEIGHBOURS, THRESHOLD = 4096, 64, 16, 0.7
BUCKETS, SHAPES = 4096, 32
#: Weights of the blocks of terms: words, bytes, word shapes.
BLOCKS = (0.4, 0.7, 1.0)
#: Documents of one product with the sample.
ROWS = 512

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"()-?"]] = True


def terms(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Chunk by chunk: first row; row, bucket and count of hashed words; shares of bytes and word shapes by row."""
    for first, off, buf in chunks(column):
        n = len(off) - 1
        row_of = np.repeat(np.arange(n), np.diff(off))
        bytes_ = np.bincount(row_of * 256 + buf, minlength=n * 256).reshape(n, 256).astype(np.float32)
        bytes_ = np.sqrt(bytes_ / np.maximum(bytes_.sum(1, keepdims=True), 1))
        s, e, rows = words(off, buf)
        h = hashes(buf, s, e)[0]
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (rows[1:] == rows[:-1])
        count = lambda flag: (c := np.concatenate(([0], np.cumsum(flag[buf]))))[e] - c[s]
        shape = again * 1 + (count(_UPPER) > 1) * 2 + (count(_SYMBOL) > 0) * 4 + (count(_DIGIT) > 0) * 8 + (e - s > 30) * 16
        shapes = np.bincount(rows * SHAPES + shape, minlength=n * SHAPES).reshape(n, SHAPES).astype(np.float32)
        shapes = np.sqrt(shapes / np.maximum(shapes.sum(1, keepdims=True), 1))
        key, times = np.unique(rows * BUCKETS + (h % np.uint64(BUCKETS)).astype(np.int64), return_counts=True)
        yield first, key // BUCKETS, key % BUCKETS, times, np.hstack((bytes_ * BLOCKS[1], shapes * BLOCKS[2]))


class Model:
    """Term weights, projection, and the sample's latent vectors with their labels."""

    def __init__(self, idf: np.ndarray, project: np.ndarray, vectors: np.ndarray, labels: np.ndarray):
        self.idf, self.project, self.vectors, self.labels = idf, project, vectors, labels

    @staticmethod
    def weigh(rows: np.ndarray, times: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
        w = (1 + np.log(times)).astype(np.float32) * idf
        norm = np.sqrt(np.bincount(rows, w * w, minlength=n))
        return (BLOCKS[0] * w / np.maximum(norm[rows], 1e-9)).astype(np.float32)

    @classmethod
    def fit(cls, docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, dims: int = DIMS) -> Model:
        """docs: bucket, count, dense terms of each. The decomposition is by subspace iteration from a fixed seed."""
        n = len(docs)
        df = np.zeros(BUCKETS)
        for b, _, _ in docs:
            df[b] += 1
        idf = np.log((n + 1) / (df + 1)).astype(np.float32) + np.float32(0.1)
        a = np.zeros((n, BUCKETS + 256 + SHAPES), np.float32)
        for i, (b, c, dense) in enumerate(docs):
            a[i, b] = cls.weigh(np.zeros(len(b), int), c, idf[b], 1)
            a[i, BUCKETS:] = dense
        dims = min(dims, n)
        q = np.random.default_rng(5).standard_normal((a.shape[1], dims + 8), dtype=np.float32)
        for _ in range(4):
            q = np.linalg.qr(a.T @ (a @ q))[0]
        _, _, vt = np.linalg.svd(a @ q, full_matrices=False)
        project = np.ascontiguousarray((q @ vt.T)[:, :dims], dtype=np.float32)
        return cls(idf, project, cls.unit(a @ project), labels.astype(np.float32))

    @staticmethod
    def unit(x: np.ndarray) -> np.ndarray:
        return (x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)).astype(np.float32)

    def latent(self, column: pa.Array) -> np.ndarray:
        out = np.zeros((len(column), self.project.shape[1]), np.float32)
        for first, rows, bucket, times, dense in terms(column):
            n = len(dense)
            w = self.weigh(rows, times, self.idf[bucket], n)
            z = dense @ self.project[BUCKETS:]
            starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1]))) if len(rows) else np.zeros(0, int)
            for a in range(0, len(starts), 64):  # a few documents at a time, so that their terms' rows stay small
                own = starts[a : a + 64]
                end = starts[a + 64] if a + 64 < len(starts) else len(rows)
                z[rows[own]] += np.add.reduceat(self.project[bucket[own[0] : end]] * w[own[0] : end, None], own - own[0], axis=0)
            out[first : first + n] = z
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        """The share of label 1 among the nearest neighbours, by similarity; 0 for an empty text. Neighbours that tie for the last
        places share them, so that their order plays no part."""
        z = self.latent(column)
        norm = np.sqrt((z * z).sum(1))
        z, k, out = self.unit(z), min(NEIGHBOURS, len(self.labels)), np.zeros(len(z))
        for a in range(0, len(z), ROWS):
            sims = z[a : a + ROWS] @ self.vectors.T
            least = np.partition(sims, len(self.labels) - k, axis=1)[:, len(self.labels) - k, None]
            near, tied = sims > least, sims == least
            # All that tie for the last places share those.
            w = near + tied * ((k - near.sum(1)) / tied.sum(1))[:, None].astype(np.float32)
            w *= np.maximum(sims, 1e-6)
            out[a : a + ROWS] = (w @ self.labels) / w.sum(1)
        return np.where(norm > 0, np.clip(out, 0, 1), 0.0)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first, rows, bucket, times, dense in terms(pc.fill_null(b.column(0), "")):
            cut = np.searchsorted(rows, np.arange(len(dense) + 1))
            get = lambda x, t: [x[i:j].astype(t).tobytes() for i, j in zip(cut, cut[1:], strict=False)]
            labels = b.column(1).slice(first, len(dense))
            yield pa.RecordBatch.from_arrays([labels, pa.array(get(bucket, np.int32)), pa.array(get(times, np.int32)), pa.array([d.tobytes() for d in dense])], ["label", "buckets", "times", "dense"])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", sample: int = SAMPLE) -> Model | None:
    """Fits on at most `sample` labelled rows, those of the smallest id hashes among rows that aren't held out. Null
    labels and ids don't count; without any labelled row there is no model. Of an id that recurs the smallest text is learnt,
    and each of its labels. The driver gets the sample's term counts only."""
    lab = labels.select(F.col(doc_id).cast("bigint").alias("i"), (F.col(label) == 1).cast("int").alias("y")).where(~held_out(F.col("i")) & F.col("y").isNotNull() & F.col("i").isNotNull())
    own = docs.select(F.col(doc_id).cast("bigint").alias("i"), F.col(text).cast("string").alias("text"))
    known = own.select("i").join(lab, "i").distinct()
    picked = known.orderBy(F.xxhash64("i"), "i", "y").limit(sample).collect()
    if not picked:
        return None
    chosen = docs.sparkSession.createDataFrame([(r["i"], r["y"]) for r in picked], "i bigint, y int")
    rows = own.join(F.broadcast(chosen), "i").groupBy("i", "y").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    got = rows.select("text", "y").mapInArrow(lean(_features), "label int, buckets binary, times binary, dense binary").collect()
    got.sort(key=lambda r: (bytes(r["dense"]), bytes(r["buckets"]), bytes(r["times"]), r["label"]))
    docs_ = [(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["times"], np.int32), np.frombuffer(r["dense"], np.float32)) for r in got]
    return Model.fit(docs_, np.array([r["label"] for r in got])) if docs_ else None


def score_of(column: pa.Array, model: Model | None) -> np.ndarray:
    """Scores of texts (null: empty); without a model 1 for a text with a word, else 0."""
    column = pc.fill_null(column.cast(pa.string()), "")
    if model is None:
        return np.array([float(bool(t.strip(" \t\n\v\f\r"))) for t in column.to_pylist()])
    return model.score(column)


def scores(docs: DataFrame, model: Model | None, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted. Only the text enters a score.

    Null and empty texts score 0, texts of white space as their bytes say; without a model every text with a word scores 1, any other
    0. Rows that repeat score alike. Texts are read whole; a text must fit into a task. Other columns are not looked at. An
    empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score_of(b.column(1), sent.value), pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    out = rows.mapInArrow(lean(run), "doc_id bigint, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accept(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows that the classifier rejects, just those that scores predicts 0 for; all columns stay, whatever
    their names, and no row moves to another task."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(score_of(b.column(b.schema.get_field_index(text)), sent.value) >= threshold, pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)
