"""Language identification by interpolated Kneser-Ney character models.

Character 4-grams are counted over all texts that may be learnt from, with partial counts per task. A language's model
keeps sorted arrays of packed n-grams for each order; a text goes to the language of the lowest cross-entropy per
character, and is rejected where even that is above what the language's own texts show, all of those learnt from.

Models of up to MODEL_GRAMS n-grams are broadcast. Beyond that they stay tables, dealt by n-gram, and the n-grams of the texts
are joined to them (Tables); both ways give the same figures.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, held_out, lean, row_key, table

#: The share of a language's own texts below its threshold, and what is added to it, in nats.
SHARE, MARGIN = 0.995, 0.15
#: Sharpness of the score in the difference of cross-entropies.
SHARP = 12.0
CHUNK = 1 << 20
#: N-grams, of all languages together, whose models are broadcast (some 50 bytes each, and 4 for each language).
MODEL_GRAMS = 4 << 20
_EDGE = 0xFFFF
_LETTER = np.array([chr(i).isalpha() for i in range(_EDGE)] + [False])


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the texts, 16 bits each, and the row of each: letters in lower case, runs of anything else as one
    space, three edges before each text."""
    sep = chr(_EDGE) * 3
    joined = sep + sep.join(t.replace(chr(_EDGE), " ").lower() for t in texts)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    wide = code > _EDGE
    code = np.where(wide, (code & np.uint32(0x7FFF)) | np.uint32(0x8000), code)
    edge = (code == _EDGE) & ~wide
    space = ~(_LETTER[code] | wide | edge)
    rows = np.cumsum(edge) // 3 - 1
    keep = np.ones(len(code), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    code = np.where(space, np.uint32(32), code)[keep]
    return code.astype(np.uint64), rows[keep]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed 4-grams that end in a symbol of a text, and their rows."""
    c, rows = symbols(texts)
    s = np.uint64(16)
    key = (((c[:-3] << s | c[1:-2]) << s | c[2:-1]) << s) | c[3:]
    real = c[3:] != _EDGE
    return key[real], rows[3:][real]


def parts(texts: list[str], most: int = CHUNK) -> Iterator[tuple[int, list[str]]]:
    a, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield a, texts[a:i]
            a, size = i, 0
        size += len(t)
    if a < len(texts):
        yield a, texts[a:]


def _count(batches: Iterator[pa.RecordBatch], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Partial counts by language; at most so many distinct n-grams are held."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def give() -> Iterator[pa.RecordBatch]:
        for lang, (k, n) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])
        held.clear()

    for b in batches:
        langs, texts = b.column(0), pc.fill_null(b.column(1), "")
        for lang in pc.unique(langs).to_pylist():
            own = texts.filter(pc.equal(langs, lang)).to_pylist()
            for _, some in parts(own, 4 * CHUNK):
                k, n = np.unique(grams(some)[0], return_counts=True)
                if lang in held:
                    k0, n0 = held[lang]
                    both = np.concatenate((k0, k))
                    order = np.argsort(both, kind="stable")
                    both, times = both[order], np.concatenate((n0, n))[order]
                    first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
                    k, n = both[first], np.add.reduceat(times, first)
                held[lang] = (k, n.astype(np.int64))
        if sum(len(k) for k, _ in held.values()) > most:
            yield from give()
    yield from give()


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted keys: distinct ones, sums of their values, how many there were of each."""
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(values, first), np.diff(np.append(first, len(keys)))


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


class KneserNey:
    """One language: for each order its sorted n-grams with discounted shares, its sorted contexts with what is left
    for the order below."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, alphabet: int):
        self.base = 1.0 / alphabet
        self.orders = []
        k, c = keys, counts.astype(np.float64)
        for order in (4, 3, 2, 1):
            n1, n2 = (c == 1).sum(), (c == 2).sum()
            d = n1 / (n1 + 2.0 * n2) if n1 and n2 else 0.5
            ctx, total, kinds = _sums(k >> np.uint64(16), c)
            at = np.searchsorted(ctx, k >> np.uint64(16))
            self.orders.append((order, k, np.maximum(c - d, 0) / total[at], ctx, d * kinds / total))
            if order > 1:  # the order below counts in how many contexts an n-gram occurs
                low = np.sort(k & np.uint64((1 << 16 * (order - 1)) - 1))
                k, c, _ = _sums(low, np.ones(len(low)))

    def logprob(self, keys: np.ndarray) -> np.ndarray:
        p, weight = np.zeros(len(keys)), np.ones(len(keys))
        for order, grams_, share, ctx, rest in self.orders:
            k = keys & np.uint64((1 << 16 * order) - 1) if order < 4 else keys
            at, hit = _find(grams_, k)
            p += weight * np.where(hit, share[at], 0)
            at, hit = _find(ctx, k >> np.uint64(16))
            weight = weight * np.where(hit, rest[at], 1)
        return np.log(p + weight * self.base)


class Identifier:
    """The models of all languages, and one sorted array of all their 4-grams with each language's log-probability."""

    def __init__(self, langs: list[str], models: list[KneserNey]):
        self.langs, self.models = langs, models
        self.keys = np.unique(np.concatenate([m.orders[0][1] for m in models])) if models else np.zeros(0, np.uint64)
        self.logs = np.stack([m.logprob(self.keys) for m in models], 1).astype(np.float32) if models else np.zeros((0, 0), np.float32)
        self.limit = np.full(len(langs), np.inf)

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Cross-entropy per symbol, by text and language; infinite for a text without symbols."""
        out = np.full((len(texts), len(self.langs)), np.inf)
        for first, some in parts(texts):
            keys, rows = grams(some)
            if not len(keys):
                continue
            at, hit = _find(self.keys, keys)
            logs = self.logs[at]
            if not hit.all():
                new, back = np.unique(keys[~hit], return_inverse=True)
                logs[~hit] = np.stack([m.logprob(new) for m in self.models], 1).astype(np.float32)[back]
            starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
            n = np.diff(np.append(starts, len(rows)))
            out[first + rows[starts]] = -np.add.reduceat(logs.astype(np.float64), starts, axis=0) / n[:, None]
        return out

    def identify(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection of each text. Ties: the smaller name."""
        h = self.entropies(texts)
        best = h.argmin(1)
        low = h[np.arange(len(h)), best]
        with np.errstate(invalid="ignore"):
            share = 1 / np.exp(-SHARP * (h - low[:, None])).sum(1)
            over = np.maximum(0, low - self.limit[best])
        score = np.where(np.isfinite(low), share * np.exp(-2 * over), 0.0)
        return [self.langs[i] for i in best], np.nan_to_num(np.clip(score, 0, 1)), ~(low <= self.limit[best])


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(i, k, text) to (i, k, gram, n)."""
    for b in batches:
        for first, some in parts(pc.fill_null(b.column(2), "").to_pylist()):
            keys, rows = grams(some)
            order = np.lexsort((keys, rows))
            keys, rows = keys[order], rows[order]
            at = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])))) if len(keys) else np.zeros(0, np.int64)
            n, row = np.diff(np.append(at, len(keys))), pa.array(first + rows[at])
            yield pa.RecordBatch.from_arrays([b.column(0).take(row), b.column(1).take(row), pa.array(keys[at].view(np.int64)), pa.array(n)], ["i", "k", "gram", "n"])


class Tables:
    """The models as tables: for each order the shares of its n-grams and what its contexts leave, as a map from language to
    value for each n-gram. The driver has the languages and a few figures of each."""

    def __init__(self, counts: DataFrame, langs: list[str]):
        """counts: lang, gram, n, written."""
        self.langs, self.limit, self.orders = langs, np.full(len(langs), np.inf), {}
        low = lambda order: F.col("gram") if order == 4 else F.col("gram").bitwiseAND(F.lit((1 << 16 * order) - 1))
        self.base = 1.0 / (counts.select(low(1).alias("s")).distinct().count() + 1)
        now = counts.select("lang", "gram", F.col("n").cast("double").alias("c"))
        for order in (4, 3, 2, 1):
            rare = now.groupBy("lang").agg(F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2"))
            rare = rare.select("lang", F.when((F.col("n1") > 0) & (F.col("n2") > 0), F.col("n1") / (F.col("n1") + 2.0 * F.col("n2"))).otherwise(F.lit(0.5)).alias("d"))
            ctx = F.shiftrightunsigned("gram", 16)
            total = now.groupBy("lang", ctx.alias("ctx")).agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds"))
            share = attach(attach(now.withColumn("ctx", ctx), total, ["lang", "ctx"], "inner"), rare, ["lang"], "inner").select("lang", "gram", (F.greatest(F.col("c") - F.col("d"), F.lit(0.0)) / F.col("total")).alias("v"))
            rest = attach(total, rare, ["lang"], "inner").select("lang", F.col("ctx").alias("gram"), (F.col("d") * F.col("kinds") / F.col("total")).alias("v"))
            pack = lambda df: df.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "v"))).alias("m"))  # noqa: E731  at most one entry a language
            self.orders[order] = (table(pack(share), f"language-shares-{order}"), table(pack(rest), f"language-contexts-{order}"))
            if order > 1:
                now = table(now.select("lang", low(order - 1).alias("gram")).groupBy("lang", "gram").agg(F.count(F.lit(1)).cast("double").alias("c")), f"language-counts-{order - 1}")

    def entropies(self, docs: DataFrame) -> DataFrame:
        """docs: i, k, text. Returns i, k, h: an array of the cross-entropy per symbol by language; rows of equal i and k are one."""
        own = table(docs.mapInArrow(lean(_grams), "i bigint, k bigint, gram bigint, n bigint"), "language-text-grams")
        names = F.array(*[F.lit(x) for x in self.langs])
        p = own.select("gram").distinct().withColumn("p", F.array_repeat(F.lit(self.base), len(self.langs)))
        for order in (1, 2, 3, 4):
            key = F.col("gram") if order == 4 else F.col("gram").bitwiseAND(F.lit((1 << 16 * order) - 1))
            shares, contexts = self.orders[order]
            p = attach(p.withColumn("key", key), shares.select(F.col("gram").alias("key"), F.col("m").alias("share")), ["key"])
            p = p.withColumn("key", F.shiftrightunsigned("key", 16))
            left = contexts.select(F.col("gram").alias("key"), F.col("m").alias("rest"))
            p = attach(p, F.broadcast(left) if order == 1 else left, ["key"])  # the only context of order 1 is the empty one
            both = F.zip_with(names, "p", lambda x, q: F.coalesce(F.element_at("share", x), F.lit(0.0)) + F.coalesce(F.element_at("rest", x), F.lit(1.0)) * q)
            p = p.select("gram", both.alias("p"))
        logs = table(p.select("gram", F.transform("p", F.ln).alias("logs")), "language-logs")
        joined = attach(own, logs, ["gram"], "inner")
        sums = joined.groupBy("i", "k").agg(F.sum("n").alias("n"), *[F.sum(F.col("n") * F.col("logs")[j]).alias(f"s{j}") for j in range(len(self.langs))])
        return sums.select("i", "k", F.array(*[-F.col(f"s{j}") / F.col("n") for j in range(len(self.langs))]).alias("h"))

    def identify(self, docs: DataFrame) -> DataFrame:
        """docs: i, k, text. Returns i, k, lang_pred, score, rejected."""
        h = self.entropies(docs).withColumn("low", F.array_min("h")).withColumn("at", F.array_position("h", F.col("low")).cast("int"))
        limit = F.element_at(F.array(*[F.lit(float(x)) for x in self.limit]), F.col("at"))
        total = F.aggregate("h", F.lit(0.0), lambda acc, x: acc + F.exp(-SHARP * (x - F.col("low"))))
        score = F.exp(-2 * F.greatest(F.lit(0.0), F.col("low") - limit)) / total
        return h.select("i", "k", F.element_at(F.array(*[F.lit(x) for x in self.langs]), F.col("at")).alias("lang_pred"), score.alias("score"), (F.col("low") > limit).alias("rejected"))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", model_grams: int = MODEL_GRAMS) -> Identifier | Tables:
    """Learns from the texts and languages of all rows that aren't held out. Rows without text or language teach
    nothing; without any row the identifier knows no language. All 4-grams are kept, rare ones too, so that discounts and
    continuation counts are those of all texts. The driver and each worker hold the models whole if they have `model_grams`
    n-grams at most; else they stay tables."""
    src = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"), F.col(doc_id).cast("bigint").alias("i"))
    train = src.where(~held_out(F.col("i")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = train.select("lang", "text").mapInArrow(lean(_count), "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = table(counts, "language-counts")
    sizes = {r["lang"]: r["m"] for r in counts.groupBy("lang").agg(F.count(F.lit(1)).alias("m")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Identifier([], [])
    if sum(sizes.values()) > model_grams:
        out = Tables(counts, langs)
        rows = train.select("i", row_key(F.col("text")).alias("k"), "lang", "text")
        place = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")).cast("int")
        h = attach(rows.select("i", "k", place.alias("at")), out.entropies(rows.select("i", "k", "text")), ["i", "k"], "inner")
        limits = h.groupBy("at").agg(F.percentile_approx(F.element_at("h", F.col("at")), SHARE, 1000).alias("h")).collect()
        for r in limits:
            out.limit[r["at"] - 1] = r["h"] + MARGIN
        return out
    tables = []
    for name in langs:  # a language at a time is on its way to the driver
        own = counts.where(F.col("lang") == name).select("gram", "n").toArrow()
        k, n = own.column("gram").to_numpy().view(np.uint64), own.column("n").to_numpy()
        order = np.argsort(k)
        tables.append((k[order], n[order]))
    alphabet = len(np.unique(np.concatenate([np.unique(k & np.uint64(0xFFFF)) for k, _ in tables]))) + 1
    models = [KneserNey(k, n, alphabet) for k, n in tables]
    out = Identifier(langs, models)
    sent = docs.sparkSession.sparkContext.broadcast(out)

    def own_entropy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, where = sent.value.entropies(b.column(1).to_pylist()), {x: i for i, x in enumerate(sent.value.langs)}
            h = h[np.arange(len(h)), [where[x] for x in b.column(0).to_pylist()]]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(h)], ["lang", "h"])

    limits = train.select("lang", "text").mapInArrow(lean(own_entropy), "lang string, h double").groupBy("lang").agg(F.percentile_approx("h", SHARE, 1000).alias("h")).collect()
    for r in limits:
        out.limit[langs.index(r["lang"])] = r["h"] + MARGIN
    return out


def identify(docs: DataFrame, identifier: Identifier | Tables, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score, rejected. Only the text enters a prediction.

    A text that is null or has no letter is "und" with score 0; so is every text if no language is known. A rejected
    text still names its nearest language, with a score that falls with the distance; ties go to the smaller name. Rows
    that repeat agree. Texts are read whole, in pieces of bounded length where they are many; one text must fit into a task.
    Other columns are not looked at, so their names can't clash. An empty table gives an empty result.
    """
    src = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if isinstance(identifier, Tables):
        rows = src.select(F.col("doc_id").alias("i"), row_key(F.col("text")).alias("k"), "text")
        found = attach(rows.select("i", "k"), identifier.identify(rows.where(lettered)), ["i", "k"])
        out = found.select(F.col("i").alias("doc_id"), F.coalesce("lang_pred", F.lit("und")).alias("lang_pred"), F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("rejected", F.lit(True)).alias("rejected"))
        return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
    sent = docs.sparkSession.sparkContext.broadcast(identifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, lettered = b.column(0), b.column(2).to_pylist()
            lang, score, off = ["und"] * len(ids), np.zeros(len(ids)), np.ones(len(ids), bool)
            at = [i for i, x in enumerate(lettered) if x]
            if at and sent.value.langs:
                names, s, r = sent.value.identify(b.column(1).take(pa.array(at)).to_pylist())
                for i, name in zip(at, names, strict=True):
                    lang[i] = name
                score[at], off[at] = s, r
            yield pa.RecordBatch.from_arrays([ids, pa.array(lang), pa.array(score), pa.array(off)], ["doc_id", "lang_pred", "score", "rejected"])

    out = src.select("doc_id", "text", lettered.alias("lettered")).mapInArrow(lean(run), "doc_id bigint, lang_pred string, score double, rejected boolean")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
