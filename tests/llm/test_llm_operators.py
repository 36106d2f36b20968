import collections
import gzip
import hashlib
import os
import random
import re
import sys
import textwrap
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from helpers import SCHEMA, corpus, words  # noqa: E402

from tickfuse.llm import anchors, components, decontamination, exact_dedup, language, license_scan, line_dedup, mixing, near_dup, quality, suffix_dedup, warc  # noqa: E402
from tickfuse.llm import words as wordlib  # noqa: E402

WS = re.compile(r"[\x20\x09-\x0D]")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(i):
    return (1 << 63) if i is None else i


# 1 ------------------------------------------------------------------------------------------------------------------


def test_warc_round_trip(spark):
    long = "x" * 150
    rows = [(3, "http://a/1", long), (1, "http://a/2", long), (2, None, "short"), (4, "u\r\nv", "short"), (5, "http://b", None), (6, "http://b", ""), (7, "é", "é" * 80), (8, "é", "é" * 80), (1, "again", long), (None, "n", long), (9, "x", "a\r\n\r\nWARC/1.1\r\n" * 30)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages).collect()), key=str)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        first = min((x for x, _, y in rows if (y or "") == (h or "") and x is not None), default=None) if len(b) >= 100 else i
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "response" if i == first else "revisit", None if i == first else first))
    assert got == sorted(want, key=str)
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_warc_index(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", str(i) * 300) for i in range(30)], "page_id bigint, url string, html string").repartition(4)
    folder = f"file://{tmp_path}/w"
    index = warc.write_archives(warc.assign_revisits(pages), folder)
    files = index.select("file").distinct()
    again = warc.index_archives(spark, folder, files)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, index.collect()))
    some = index.where("url in ('http://h/3', 'http://h/17')")
    assert sorted(bytes(r["payload"]).decode()[:2] for r in warc.read_records(some, folder).collect()) == ["17", "33"]
    assert list(warc.ranges([(0, 10), (12, 5), (100, 5)], gap=4)) == [(0, 17, [0, 1]), (100, 105, [2])]
    twice = spark.createDataFrame([(1, "http://a", "p" * 120), (1, "http://b", "p" * 120), (1, "http://a", "q" * 120), (2, "http://c", "p" * 120)], "page_id bigint, url string, html string")
    records = warc.assign_revisits(twice).collect()
    assert len({r["record_id"] for r in records}) == 4 and {r["refers_to"] for r in records if r["record_id"].startswith("urn:page:2")} <= {r["record_id"] for r in records}
    data = gzip.compress(b"a") + gzip.compress(b"bb")
    assert [c for _, _, c in warc.members(data)] == [b"a", b"bb"]


# 2 ------------------------------------------------------------------------------------------------------------------


def edit_in(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_myers_equals_dynamic_programme():
    rng = random.Random(1)
    for _ in range(150):
        a, b = "".join(rng.choice("abc") for _ in range(rng.randint(1, 80))), "".join(rng.choice("abc") for _ in range(rng.randint(0, 90)))
        masks = {}
        for i, c in enumerate(a):
            masks[c] = masks.get(c, 0) | 1 << i
        assert decontamination.myers(masks, len(a), b)[0] == edit_in(a, b)


def test_pigeonhole_misses_nothing():
    rng = random.Random(2)
    items = [(i, words(rng, 30)) for i in range(6)]
    m = decontamination.Matcher(items)
    for _ in range(60):
        i = rng.randrange(6)
        t = list(items[i][1])
        for _ in range(rng.randint(0, 16)):
            t[rng.randrange(len(t))] = rng.choice("abcdefgw ")
        text = words(rng, 20) + " " + "".join(t) + " " + words(rng, 20)
        norm, item = decontamination.normalise(text), decontamination.normalise(items[i][1])
        k, _ = decontamination.pieces(item)
        d = edit_in(item, norm)
        assert [h["edits"] for h in m.find(text) if h["item_id"] == i] == ([d] if d <= k else [])


@pytest.mark.parametrize("length", [24, 31, 60, 100, 345])
def test_budget_is_the_rate(length):
    """Against brute force, with the budget from RATE and copies at and around it."""
    rng = random.Random(length)
    item = decontamination.normalise(words(rng, 120))[:length].strip().ljust(length, "x")
    m, k = decontamination.Matcher([(1, item)]), int(decontamination.RATE * length)
    inside = 0
    for n in [*range(k + 3), *[k] * 20, *[k + 1] * 10]:
        t = list(item)
        for at in sorted(rng.sample(range(len(t)), n), reverse=True):
            t[at : at + 1] = rng.choice(["", "z", "yz"])
        text = words(rng, 8) + " " + "".join(t) + " " + words(rng, 8)
        d = edit_in(item, decontamination.normalise(text))
        assert [h["edits"] for h in m.find(text)] == ([d] if d <= k else [])
        inside += length // 12 - 1 < d <= k
    assert inside


def test_short_items_are_whole_words():
    m = decontamination.Matcher([(1, "Two plus two?"), (2, "cat"), (3, "!?")])
    found = lambda t: [h["item_id"] for h in m.find(t)]
    assert found("so two, plus TWO is") == [1] and found("two plus twos") == [] and found("cat") == [2]
    assert found("concat cats") == [] and found("concat, a cat.") == [2] and found("two plus tvo !?") == []


def test_decontamination_cases(spark, docs, empty, monkeypatch):
    items = spark.createDataFrame([(7, corpus()[0][1]), (8, "tiny"), (None, corpus()[1][1]), (9, None)], "item_id bigint, text string")
    got = decontamination.contamination(docs, items)
    assert got.count() == docs.count()
    want = {r[0] for r in corpus() if r[1] and (r[1].lower().replace("\n", " ").find(corpus()[0][1]) >= 0 or r[1].lower().replace("\n", " ").find(corpus()[1][1]) >= 0)}
    hit = {r["doc_id"] for r in got.where("contaminated").collect()}
    assert want <= hit
    kept = decontamination.clean(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - got.where("contaminated").count()
    assert decontamination.contamination(empty, items).count() == 0
    assert decontamination.contamination(docs, items.limit(0)).where("contaminated").count() == 0
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 300)
    blocks = decontamination.contamination(docs, items)
    assert sorted(map(str, (sorted(r["item_ids"], key=key) for r in blocks.collect()))) == sorted(map(str, (sorted(r["item_ids"], key=key) for r in got.collect())))


# 3 ------------------------------------------------------------------------------------------------------------------


def test_filters_merge_without_loss():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 1 << 50, 500, dtype=np.uint64) << np.uint64(14), rng.integers(0, 1 << 50, 400, dtype=np.uint64) << np.uint64(14)
    parts = []
    for x in (a, b, a):
        p, t = np.unique(x, return_counts=True)
        for block in np.unique(p >> np.uint64(60)):
            own = (p >> np.uint64(60)) == block
            f = exact_dedup.CountingQuotientFilter.of(p[own], t[own], 4)
            parts.append(exact_dedup.CountingQuotientFilter.unpack(f.pack()).entries(int(block), 4))
    p, t = exact_dedup.CountingQuotientFilter.merge([x for x, _ in parts], [y for _, y in parts])
    assert dict(zip(p.tolist(), t.tolist(), strict=True)) == dict(collections.Counter([*a.tolist(), *b.tolist(), *a.tolist()]))


def test_exact_duplicates(docs, empty):
    rows = [(r[0], WS.sub("", r[1] or ""), len(r[1] or "")) for r in corpus()]
    groups = collections.defaultdict(list)
    for i, n, c in rows:
        groups[n].append((-c, key(i), i))
    want = []
    for i, n, _ in rows:
        keep = min(groups[n])[2]
        want.append((i, keep, len(groups[n]), i == keep, hashlib.sha256(n.encode()).hexdigest()))
    assert sorted(map(str, map(tuple, exact_dedup.exact_duplicates(docs).collect()))) == sorted(map(str, want))
    assert exact_dedup.exact_duplicates(empty).collect() == []
    assert exact_dedup.keep_distinct(docs).columns == docs.columns


# 4 ------------------------------------------------------------------------------------------------------------------


def test_apportionment():
    def plain(votes, seats, most):
        got = [0] * len(votes)
        for _ in range(seats):
            i = max((i for i in range(len(votes)) if got[i] < most[i]), key=lambda i: (votes[i] / (2 * got[i] + 1), -i))
            got[i] += 1
        return got

    rng = random.Random(4)
    for _ in range(40):
        v, s = [float(rng.randint(1, 1000)) for _ in range(rng.randint(1, 9))], rng.randint(0, 120)
        m = [rng.randint(5, 60) for _ in v]
        s = min(s, sum(m))
        assert mixing.sainte_lague(v, s, m) == plain(v, s, m)
    assert mixing.sainte_lague([0.0, 0.0], 0) == [0, 0] and mixing.sainte_lague([0.0, 2.0], 3) == [0, 3]
    assert mixing.capped_targets([1, 100], [5, 2]) == [3.0, 98.0] and mixing.capped_targets([0, 0], [5, 2]) == [0.0, 0.0]


def test_mix(docs, empty):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    got = mixing.mix(docs).collect()
    assert sorted((key(r["doc_id"]), r["size"]) for r in got) == sorted((key(r[0]), size(r[1])) for r in corpus())
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    for s in ("s1", "s2", None):
        own = [r for r in got if r["source"] == s]
        total = sum(r["size"] for r in own)
        assert {r["source_size"] for r in own} == {total}
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, map(tuple, mixing.mix(docs.repartition(5)).collect())))
    assert mixing.mix(empty).collect() == [] and {r["taken"] for r in mixing.mix(docs.where("text is null")).collect()} == {0}


def test_small_sources_meet_their_targets(spark):
    """Sources of 40, 20 and 11,400 words: 120, 60 and 11,280 are wanted, which blocks of 64 words can't give."""
    rows = [(i, "w " * 10, s) for i, s in enumerate(["a"] * 4 + ["b"] * 2)] + [(100 + i, "w " * 57, "c") for i in range(200)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    for s, target in (("a", 120), ("b", 60), ("c", 11280)):
        own = [r for r in got if r["source"] == s]
        assert {r["target"] for r in own} == {target} and sum(r["taken"] for r in own) == target
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in own)


def test_taken_words_by_brute_force(spark):
    """The closed form against a walk over the words of a shard, for every quota of small shards."""
    block, rows, want = 4, [], []
    for words in (1, 3, 4, 9, 13, 20):
        full = words // block
        for quota in range(3 * words + 1):
            for phase in range(max(full, 1)):
                times = [quota // words] * words
                picks = min(quota % words // block, full)
                hit = [((j + 1) * picks + phase) // full > (j * picks + phase) // full for j in range(full)]
                for j in range(full):
                    for w in range(block * j, block * j + block):
                        times[w] += hit[j]
                rest = quota - sum(times)
                first = next((j for j in range(full) if not hit[j]), full)
                for w in range(block * first, block * first + rest):
                    times[w] += 1
                assert max(times) <= 3
                cuts = sorted({0, words, *(x % words for x in (1, 5, 6, 11))})
                for a, z in zip(cuts, cuts[1:]):
                    rows.append((words, quota, full, phase, a, z, z - a))
                    want.append(sum(times[a:z]))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, words bigint, quota bigint, full bigint, phase bigint, start bigint, stop bigint, size bigint")
    got = df.selectExpr("i", f"{mixing.taken_words(block)} AS taken").orderBy("i").collect()
    assert [r["taken"] for r in got] == want


# 5 ------------------------------------------------------------------------------------------------------------------


def test_quality(spark, docs, empty):
    rng = random.Random(5)
    rows = [(i, words(rng, 80) if i % 3 else " ".join(["spam!!"] * 60), 1 if i % 3 else 0) for i in range(300)]
    d = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    lab = spark.createDataFrame([(i, q, 0) for i, _, q in rows if i % 2] + [(1, None, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.fit(d, lab)
    got = {r["doc_id"]: r for r in quality.scores(d, model).collect()}
    out = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in got.items() if r["held_out"]} == set(out)
    assert sum(got[i]["predicted"] == q for i, _, q in rows) >= 297
    flipped = quality.fit(d, lab.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality"))))
    assert [r["score"] for r in quality.scores(d, flipped).orderBy("doc_id").collect()] == [got[i]["score"] for i, _, _ in rows]
    all_ = quality.scores(docs, model)
    assert all_.count() == docs.count() and all_.where("score < 0 or score > 1 or score is null").count() == 0
    assert quality.scores(empty, model).collect() == [] and quality.fit(d, lab.limit(0)) is None
    assert {r["score"] for r in quality.scores(docs, None).collect()} == {0.0, 1.0}
    for m in (model, None):
        assert quality.accept(docs, m).count() == quality.scores(docs, m).where("predicted = 1").count()
    assert quality.accept(docs, model).columns == docs.columns


def test_neighbours_are_exact(spark):
    rng = np.random.default_rng(1)
    docs_ = [(np.unique(rng.integers(0, 4096, 30)).astype(np.int32),) for _ in range(50)]
    m = quality.Model.fit([(b, np.ones(len(b), np.int32), rng.random(288).astype(np.float32)) for (b,) in docs_], rng.integers(0, 2, 50))
    texts = pa.array([words(random.Random(i), 40) for i in range(20)])
    z = quality.Model.unit(m.latent(texts))
    for i, s in enumerate(m.score(texts)):
        sims = z[i] @ m.vectors.T
        top = np.argsort(-sims, kind="stable")[: quality.NEIGHBOURS]
        w = np.maximum(sims[top], 1e-6).astype(np.float64)
        assert abs(s - (w * m.labels[top]).sum() / w.sum()) < 1e-5
    # Neighbours that tie share the last places, in whatever order they come.
    z = quality.Model.unit(m.latent(texts[:1]))
    for labels in ([1] * 8 + [0] * 24, [0] * 24 + [1] * 8):
        tied = quality.Model(m.idf, m.project, np.repeat(z, 32, 0), np.array(labels, np.float32))
        assert abs(tied.score(texts[:1])[0] - 0.25) < 1e-6


def test_terms_by_brute_force():
    """Words, byte shares and word shapes of texts, written out plainly."""
    texts = ["The CAT sat, sat on 3 mats & left", "", "a" * 40 + " x x x", "é 12 AB-c\tQ!", "one\nONE\x0bone"]
    seen = {}
    for first, rows, bucket, times, dense in quality.terms(pa.array(texts)):
        for r, b, t in zip(rows, bucket, times, strict=True):
            seen.setdefault(first + r, collections.Counter())[int(b)] += int(t)
        for r, d in enumerate(dense):
            seen[first + r, "dense"] = d
    for i, text in enumerate(texts):
        raw = [w for w in re.split(rb"[\x20\x09-\x0D]+", text.encode()) if w]
        flat = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(w) for w in raw]).astype(int)
        h = wordlib.hashes(flat, ends - [len(w) for w in raw], ends)[0] if raw else []
        assert seen.get(i, collections.Counter()) == collections.Counter(int(x % quality.BUCKETS) for x in h)
        hist, shapes = np.zeros(256), np.zeros(quality.SHAPES)
        for b in text.encode():
            hist[b] += 1
        for n, w in enumerate(raw):
            symbol = any(33 <= c < 127 and not chr(c).isalnum() and chr(c) not in ".,;:'\"()-?" for c in w)
            shapes[(n > 0 and w == raw[n - 1]) + 2 * (sum(65 <= c < 91 for c in w) > 1) + 4 * symbol + 8 * any(48 <= c < 58 for c in w) + 16 * (len(w) > 30)] += 1
        want = np.concatenate((np.sqrt(hist / max(hist.sum(), 1)) * quality.BLOCKS[1], np.sqrt(shapes / max(shapes.sum(), 1)) * quality.BLOCKS[2]))
        assert np.allclose(seen[i, "dense"], want, atol=1e-6)


def test_projection_spans_the_sample():
    """The latent vectors of few documents keep all of their inner products, as a full decomposition does."""
    rng = np.random.default_rng(3)
    docs_ = [(np.unique(rng.integers(0, 4096, 20)).astype(np.int32), rng.random(288).astype(np.float32)) for _ in range(24)]
    m = quality.Model.fit([(b, np.ones(len(b), np.int32), d) for b, d in docs_], np.zeros(24))
    a = np.zeros((24, 4096 + 288))
    for i, (b, d) in enumerate(docs_):
        w = m.idf[b]
        a[i, b], a[i, 4096:] = quality.BLOCKS[0] * w / np.sqrt((w * w).sum()), d
    a /= np.sqrt((a * a).sum(1, keepdims=True))
    assert np.allclose(m.vectors @ m.vectors.T, a @ a.T, atol=1e-3)


# 6 ------------------------------------------------------------------------------------------------------------------


def test_kneser_ney_sums_to_one():
    texts = ["the cat sat on the mat", "a cat and a hat"]
    k, n = np.unique(language.grams(texts)[0], return_counts=True)
    c = np.unique(k & np.uint64(0xFFFF))
    m = language.KneserNey(k, n, len(c) + 1)
    for ctx in np.unique(k >> np.uint64(16))[:20]:
        p = np.exp(m.logprob((ctx << np.uint64(16)) | c)).sum()
        assert 0.9 < p <= 1.0 + 1e-9  # the rest is for symbols that never occurred


def test_language(spark, docs, empty):
    rng = random.Random(6)
    alphabet = {"aa": "abcde", "bb": "vwxyzé"}
    rows = [(i, " ".join("".join(rng.choice(alphabet[g]) for _ in range(5)) for _ in range(30)), g) for i in range(200) for g in [["aa", "bb"][i % 2]]]
    d = spark.createDataFrame([*rows, (900, "123 456", "aa"), (901, None, "aa"), (902, "abc abd", None), (903, "", "aa"), (None, "abcde", "aa")], "doc_id bigint, text string, lang string")
    model = language.fit(d)
    got = {r["doc_id"]: r for r in language.identify(d, model).collect()}
    assert all(got[i]["lang_pred"] == g for i, _, g in rows)
    assert [got[i]["lang_pred"] for i in (900, 901, 903)] == ["und"] * 3 and got[902]["lang_pred"] == "aa"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    other = spark.createDataFrame([(1, "мир труд май " * 20)], "doc_id bigint, text string")
    r = language.identify(other, model).first()
    assert r["rejected"] and r["lang_pred"] in ("aa", "bb")
    assert language.identify(empty, model).collect() == []
    none = language.fit(empty)
    assert {r["lang_pred"] for r in language.identify(docs, none).collect()} == {"und"}
    # Models that are tables give the same, row by row.
    tables = language.fit(d, model_grams=0)
    assert isinstance(tables, language.Tables) and np.allclose(tables.limit, model.limit, atol=1e-6)
    again = language.identify(d.unionByName(other.withColumn("lang", F.lit("aa"))), tables).collect()
    want = [*got.values(), r]
    row = lambda x: (key(x["doc_id"]), x["held_out"], x["lang_pred"], round(x["score"], 5), x["rejected"])
    assert sorted(map(row, again)) == sorted(map(row, want))


def test_entropy_by_brute_force():
    """Interpolated Kneser-Ney written out with dictionaries, on held-out strings of two languages."""
    train = {"x": ["abca bcab cabc", "aab bba cca"], "y": ["xyzx yzxy", "zzy xxa"]}
    pad = lambda t: "###" + re.sub("[^a-z]+", " ", t)
    count = {g: collections.Counter(p[i - 3 : i + 1] for t in own for p in [pad(t)] for i in range(3, len(p))) for g, own in train.items()}
    symbols = len({k[-1] for c in count.values() for k in c}) + 1

    def orders(c):
        out = []
        while True:
            n1, n2 = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
            out.append((dict(c), n1 / (n1 + 2 * n2) if n1 and n2 else 0.5))
            if len(next(iter(c))) == 1:
                return out
            c = collections.Counter(k[1:] for k in c)

    def prob(levels, gram):
        if not levels:
            return 1 / symbols
        (c, d), low = levels[0], prob(levels[1:], gram[1:])
        same = [v for k, v in c.items() if k[:-1] == gram[:-1]]
        return low if not same else max(c.get(gram, 0) - d, 0) / sum(same) + d * len(same) / sum(same) * low

    tables = [np.unique(language.grams(own)[0], return_counts=True) for own in train.values()]
    model = language.Identifier(list(train), [language.KneserNey(k, n, symbols) for k, n in tables])
    texts = ["abc cab", "zyx xx", "aab", "qqq a"]
    for t, h in zip(texts, model.entropies(texts), strict=True):
        p = pad(t)
        for g, got in zip(train, h, strict=True):
            levels = orders(count[g])
            want = -np.mean([np.log(prob(levels, p[i - 3 : i + 1])) for i in range(3, len(p))])
            assert abs(want - got) < 1e-5


def test_all_grams_are_kept(spark):
    """More distinct 4-grams than 300,000, nearly all of them once."""
    rng = random.Random(8)
    rows = [(i, "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(8000)), "zh") for i in range(64)]
    model = language.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    k, n = np.unique(language.grams([t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2])[0], return_counts=True)
    want = language.KneserNey(k, n, len(np.unique(k & np.uint64(0xFFFF))) + 1)
    assert len(k) > 300_000
    for got, own in zip(model.models[0].orders, want.orders, strict=True):
        assert got[0] == own[0] and all(np.array_equal(x, y) for x, y in zip(got[1:], own[1:], strict=True))


def test_rare_languages_have_limits(spark):
    """One text of each of 20 languages beside 20,000 of another."""
    many = spark.range(20000).select(F.col("id").alias("doc_id"), F.concat(F.lit("abc bca "), F.col("id") % 7).alias("text"), F.lit("aa").alias("lang"))
    ids = [i for i in range(30000, 30100) if zlib.crc32(str(i).encode()) % 4 != 2][:20]
    rare = spark.createDataFrame([(i, "vwx yzw " * 4, f"r{i}") for i in ids], many.schema)
    model = language.fit(many.unionByName(rare))
    assert len(model.langs) == 21 and np.isfinite(model.limit).all()
    h = model.entropies(["vwx yzw " * 4])[0]
    assert all(abs(model.limit[j] - h[j] - language.MARGIN) < 1e-6 for j, x in enumerate(model.langs) if x != "aa")


# 7 ------------------------------------------------------------------------------------------------------------------


def cut_plainly(rows):
    first = {}
    for i, t in sorted({(key(i), (t or "").encode()) for i, t in rows}):
        for p in range(len(t) - 99):
            first.setdefault(t[p : p + 100], (i, p))
    out = []
    for i, t in rows:
        t = (t or "").encode()
        gone = [False] * len(t)
        for p in range(len(t) - 99):
            if first[t[p : p + 100]] < (key(i), p):
                gone[p : p + 100] = [True] * 100
        spans = sum(g and (n == 0 or not gone[n - 1]) for n, g in enumerate(gone))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("batch", ["7", "10000"])
def test_repeated_bytes(spark, docs, empty, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        ids = [(r[0], r[1]) for r in corpus() if r[0] is not None]
        got = suffix_dedup.repeated_bytes(docs.where("doc_id is not null"))
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, cut_plainly(ids)))
        assert suffix_dedup.repeated_bytes(docs).count() == docs.count()
        assert suffix_dedup.repeated_bytes(empty).collect() == []
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("runs_held", [1, 40])
def test_hot_bucket_in_parts(spark, runs_held):
    """A passage in 40 documents with other text beside it each time: one bucket of 40 names."""
    rng, passage = random.Random(9), words(random.Random(2), 60)
    rows = [(i, words(rng, 20, 5000) + passage + words(rng, 20, 5000)) for i in range(40)]
    rows += [(40, passage[:150] + "!" + passage[20:]), (41, passage + passage), rows[7]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(map(tuple, suffix_dedup.repeated_bytes(df, runs_held=runs_held).collect())) == sorted(cut_plainly(rows))
    src = df.select(F.col("doc_id").alias("doc"), F.lit(0).cast("bigint").alias("tag"), "text")
    hot = suffix_dedup.hot_anchors(src, 0.01, 1)  # salted, the same comes out
    assert 0 < len(hot) <= 100
    assert sorted(map(tuple, suffix_dedup.repeated_bytes(df, runs_held=runs_held, hot=hot).collect())) == sorted(cut_plainly(rows))


def test_near_copies_make_few_rows(spark, monkeypatch):
    """A hot bucket of near copies: its parts meet in blocks of windows, so a run makes a few rows and not one a window."""
    rng, base, made = random.Random(5), words(random.Random(1), 80, 5000).split(), {}

    def counted(df, name, real=suffix_dedup.table):
        got = real(df, name)
        made[name] = max(made.get(name, 0), got.count())
        return got

    rows = []
    for i in range(120):
        t = list(base)
        t[rng.randrange(len(t))] = f"n{rng.randrange(40)}"
        rows.append((i, " ".join(t)))
    rows += [(i, "ab" * i + rows[i - 120][1] + "x" * i) for i in range(120, 140)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    monkeypatch.setattr(suffix_dedup, "table", counted)
    assert sorted(map(tuple, suffix_dedup.repeated_bytes(df, runs_held=7).collect())) == sorted(cut_plainly(rows))
    assert 0 < made["suffix-windows"] < made["suffix-runs"] and 0 < made["suffix-blocks"] < made["suffix-runs"]


def test_repeated_ids_are_documents(spark):
    a, b = words(random.Random(1), 60, 10**6), words(random.Random(2), 60, 10**6)
    for ids in ((1, None, None), (1, 2, 2), (2, 2, 2), (None, None, None)):
        rows = list(zip(ids, (a, a, b), strict=True))
        got = suffix_dedup.repeated_bytes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        whole = {hashlib.sha256(t.encode()).hexdigest() for t in (a, b)}
        kept = sorted(r["kept_sha256"] for r in got)
        # b is nowhere else; a goes from the later of its documents, and from neither if both are one.
        assert hashlib.sha256(b.encode()).hexdigest() in kept and whole <= set(kept)
        assert sum(r["n_removed"] for r in got) == (0 if ids[0] == ids[1] else len(a))


def test_pieces_of_long_texts(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(i, words(rng, 400, 30) + ("z" * 300) + words(random.Random(1), 100)) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, suffix_dedup.repeated_bytes(df).collect())) == sorted(cut_plainly(rows))
    buf = np.frombuffer(rows[0][1].encode(), np.uint8)
    off = np.array([0, len(buf)])
    whole = anchors.runs(off, buf)
    monkeypatch.setattr(anchors, "PIECE", 200)
    assert whole["n"].sum() == len(buf) - 99
    assert [p for p in anchors.pieces(off, 200)][0] == (0, 0, 299)


# 8 ------------------------------------------------------------------------------------------------------------------


def test_near_duplicates(spark, docs, empty, monkeypatch):
    rows = [(r[0], r[1]) for r in corpus() if r[0] is not None]
    sets = []
    for i, t in rows:
        w = WS.split((t or "").lower())
        w = [x for x in w if x]
        sets.append((i, frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])))
    links, root = collections.Counter(), {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            (i, x), (j, y) = sets[a], sets[b]
            if x and y and len(x & y) >= 0.8 * len(x | y):
                links[a] += 1
                links[b] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    want = sorted((i, find(i), links[n]) for n, (i, _) in enumerate(rows))
    plain = docs.where("doc_id is not null")
    for least in (128, 2):
        monkeypatch.setattr(near_dup, "LEAST", least)
        assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in near_dup.near_duplicates(plain).collect()) == want
    assert near_dup.near_duplicates(docs).count() == docs.count()
    assert near_dup.near_duplicates(empty).collect() == []
    kept = near_dup.keep_one(plain)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {c for _, c, _ in want}


def test_hot_site_in_blocks(spark, monkeypatch):
    """60 near copies of one text: every pair is a link, counted once though the pairs share many bands."""
    rng = random.Random(12)
    base = words(rng, 400, 10**6).split()
    rows = []
    for i in range(60):
        t = list(base)
        t[rng.randrange(400)] = f"new{i}"
        rows.append((i, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for parts, least in ((6, 2), (60, 1)):
        monkeypatch.setattr(near_dup, "PARTS", parts)
        monkeypatch.setattr(near_dup, "LEAST", least)
        assert {(r["class_id"], r["n_links"]) for r in near_dup.near_duplicates(df).collect()} == {(0, 59)}


def test_identity_is_no_polynomial(spark):
    """A Thue-Morse word and its complement, and texts of such words: polynomials modulo 2**64 take them for equal."""
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    a, b = "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
    rows = [(1, a), (2, b), (3, " ".join(["up", "down"][x] for x in bits)), (4, " ".join(["down", "up"][x] for x in bits)), (5, a + " x y"), (6, b + " x y")]
    got = {r["doc_id"]: r["copies"] for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == dict.fromkeys(range(1, 7), 1)
    buf = np.frombuffer((a + b).encode(), np.uint8)
    x, y = wordlib.hashes(buf, np.array([0, 2048, 0, 2048]), np.array([2048, 4096, 100, 2148]))
    assert len(set(x.tolist())) == 4 and len(set(y.tolist())) == 4


def test_repeated_ids_lose_nothing(spark):
    rng = random.Random(13)
    one, two = words(rng, 50), words(rng, 50)
    schema = "doc_id bigint, text string, i string, k map<string,int>, source string"
    rows = [(5, one), (5, two), (7, two.upper()), (8, "other text that stays here"), (8, "other text that stays here"), (None, one), (None, "no id at all in this"), (None, "no id at all in this"), (9, None), (9, None)]
    df = spark.createDataFrame([(i, t, "x", {"a": n}, "s") for n, (i, t) in enumerate(rows)], schema).repartition(2)
    got = sorted((key(r["doc_id"]), r["class_id"], r["copies"]) for r in near_dup.near_duplicates(df.where("doc_id is not null")).collect())
    assert got == [(5, 5, 1), (5, 5, 2), (7, 5, 2), (8, 8, 2), (8, 8, 2), (9, 9, 1), (9, 9, 1)]
    kept = near_dup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(5, one), (5, two), (8, rows[3][1]), (None, rows[6][1]), (9, None), (9, None)], key=str)


def test_keep_distinct_by_rows(spark):
    rows = [(1, "x y"), (2, "xy"), (2, "unique text"), (3, "unique  text"), (2, "unique text"), (4, None), (4, ""), (None, "x  y"), (None, "z"), (None, " z")]
    kept = exact_dedup.keep_distinct(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = [(r[0], r[1]) for r in kept.collect()]
    assert sorted((WS.sub("", t or "") for _, t in got)) == ["", "uniquetext", "xy", "z"]
    assert (None, "x  y") in got and (3, "unique  text") in got and (None, " z") in got
    alike = [(1, "same"), (1, "same"), (5, "other"), (5, "same "), (5, "sa me")]
    got = [(r[0], r[1]) for r in exact_dedup.keep_distinct(spark.createDataFrame(alike, "doc_id bigint, text string")).collect()]
    assert sorted(i for i, _ in got) == [5, 5] and (5, "other") in got
    with pytest.raises(Exception, match="remainders"):
        exact_dedup.exact_duplicates(kept, block_bits=3).collect()
    assert [exact_dedup.bits_for(n) for n in (0, 10**6, 10**9, 10**11)] == [6, 6, 14, 21]


def test_overlaps_both_ways():
    rng = np.random.default_rng(3)
    a = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(12)]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(12), np.arange(12), indexing="ij"))
    assert near_dup.overlaps(a, a, i, j).tolist() == [len(set(a[x].tolist()) & set(a[y].tolist())) for x, y in zip(i, j, strict=True)]
    assert 1 - (1 - 0.8**8) ** near_dup.bands_for() >= near_dup.RECALL


def test_components(spark):
    e = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (7, 7), (200, 200)] + [(300, k) for k in range(301, 330)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(e, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[102] == 100 and got[200] == 200 and got[329] == 300
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


# 9 ------------------------------------------------------------------------------------------------------------------


def test_lines(docs, empty):
    rows = corpus()
    bare = lambda s: s.strip(" \t\n\v\f\r")
    hosts, seen = collections.Counter(r[3] for r in rows), collections.Counter()
    for r in rows:
        for x in {bare(s) for s in (r[1] or "").split("\n")} - {""} if r[1] is not None else ():
            seen[(r[3], x)] += 1
    bad = {k for k, c in seen.items() if c >= 3 and c > 0.1 * hosts[k[0]]}
    want = []
    for r in rows:
        own = (r[1] or "").split("\n")
        left = [s for s in own if not bare(s) or (r[3], bare(s)) not in bad]
        n = sum(bool(bare(s)) for s in own)
        want.append((r[0], None if r[1] is None else "\n".join(left), n, n - sum(bool(bare(s)) for s in left)))
    out = line_dedup.drop_boilerplate(docs, "doc_id", "source", "text", 0.1, 3)
    assert sorted(map(str, ((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect()))) == sorted(map(str, want))
    assert any(w[3] for w in want)
    assert line_dedup.clean_documents(docs).columns == docs.columns and line_dedup.clean_documents(docs).count() == docs.count()
    assert line_dedup.clean_documents(empty).collect() == []
    plan = line_dedup.clean_documents(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_small_hosts(spark):
    """A footer on all 4 pages of a host goes, a line of one page stays; so do all lines of copies."""
    rows = [(i, "h", f"own {i}\nfooter") for i in range(4)] + [(10 + i, "g", "copied text\nof two lines") for i in range(6)] + [(20, "one", "alone"), (21, None, "x"), (22, None, "x\ny")]
    out = line_dedup.drop_boilerplate(spark.createDataFrame(rows, "page_id bigint, host string, text string"), "page_id", "host", "text", by_text=True)
    got = {r["page_id"]: r["text"] for r in out.collect()}
    assert got == {**{i: f"own {i}" for i in range(4)}, **{10 + i: "copied text\nof two lines" for i in range(6)}, 20: "alone", 21: "", 22: "y"}


def test_copies_make_no_boilerplate(spark):
    """40 copies, in upper case and other white space too, are one text; a line of 12 other texts is boilerplate."""
    doc = "first line of it\nsecond line of it"
    rows = [(i, doc if i % 2 else doc.upper().replace("\n", " \n\n"), "s", 1) for i in range(40)]
    rows += [(100 + i, f"home | about\nown text {i}", "s", 1) for i in range(12)]
    out = line_dedup.clean_documents(spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars int").repartition(3))
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()) == [(i, t, len(t)) for i, t, _, _ in rows[:40]] + [(100 + i, f"own text {i}", len(f"own text {i}")) for i in range(12)]


# 10 -----------------------------------------------------------------------------------------------------------------


def test_licenses(spark, docs, empty):
    rows = [(1, "intro\nReleased under the MIT License.\nend"), (2, "Licensed under CC BY-NC 4.0. Licensed under the Apache License, Version 2.0."), (3, "This mentions the mit license only"), (4, None), (5, ""), (6, "\n".join(license_scan.SENTENCES[k][0] for k in ("RS", "RC", "RB", "RN")).replace("*", "Example Corp and\nothers")), (7, "\n".join(license_scan.SENTENCES[k][0] for k in ("RS", "RC", "RB"))), (7, "MIT  LICENSE!")]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert [(r["doc_id"], r["licenses"]) for r in got] == [(1, "MIT"), (2, "Apache-2.0,CC-BY-NC-4.0"), (3, ""), (4, ""), (5, ""), (6, "BSD-3-Clause"), (7, "BSD-2-Clause"), (7, "MIT")]
    assert license_scan.scan(docs).count() == docs.count() and license_scan.scan(empty).collect() == []


def test_wrapped_licenses(spark):
    wrap = lambda s, n, mark="": "\n".join(mark + x for x in textwrap.wrap(s, n))
    own = {k: x[0].replace("*", "the copyright holder") for k, x in license_scan.SENTENCES.items()}
    bsd = [own[k] for k in ("RS", "RC", "RB", "RN")]
    gpl = wrap(own["GF"], 70) + "\n\n" + wrap(own["GW"] + "  See the GNU General Public License for more details.", 70)
    rows = [
        (1, "Copyright (c) 2020, X\n\n" + wrap(bsd[0], 72) + "\n\n" + "\n\n".join(f"{i}. " + wrap(x, 60) for i, x in enumerate(bsd[1:], 1))),
        (2, gpl),
        (3, wrap(own["PG"], 78) + "\n\n" + wrap(own["PC"], 40)),
        (4, wrap(own["AP"] + " " + own["AU"] + " " + own["AD"], 50, "# ")),
        (5, wrap(bsd[0], 40, " * ").replace("without", "with")),
        (6, own["GF"].replace(" it under", "\n\nit under")),
        (7, "Released under\nthe MIT License.\r\nRedistribution and use|;\nMIT;License|"),
    ]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert [(r["doc_id"], r["licenses"]) for r in got] == [(1, "BSD-3-Clause"), (2, "GPL-3.0"), (3, "MIT"), (4, "Apache-2.0"), (5, ""), (6, ""), (7, "MIT")]
    assert [r["sentence_ids"] for r in got][:4] == ["RS RC RB RN", "GF GW", "PG PC", "AP AU AD"] and got[6]["sentence_ids"] == "MI MI"


FULL = {
    "BSD-2-Clause": """Copyright (c) 2020, Someone

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

(b) Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT""",
    "MIT": """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL""",
    "GPL-2.0": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "LGPL-2.1": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0',
}


def test_full_licenses_wrapped(spark):
    """Published texts at 72 and 40 columns, plain and behind comment marks, by the operator and by its SQL."""
    import duckdb

    from tickfuse.llm import license_sql

    rows, want = [], []
    for name, body in FULL.items():
        for width in (72, 40):
            for mark in ("", "# ", " * ", "// "):
                text = "\n".join(mark + line for p in body.split("\n\n") for line in [*textwrap.wrap(p, width), ""])
                rows.append((len(rows), text))
                want.append(name)
    for spdx in ("MPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "EPL-2.0", "Zlib", "CC0-1.0", "BSL-1.0"):
        rows.append((len(rows), f"x\n// SPDX-License-Identifier: {spdx}\ny"))
        want.append(spdx)
    rows.append((len(rows), "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\nCopyright"))
    want.append("GPL-3.0")
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).orderBy("doc_id").collect()
    assert [r["licenses"] for r in got] == want
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    assert sorted(con.sql(license_sql.scan_sql()).fetchall()) == [tuple(r) for r in got]


def test_license_tables():
    from tickfuse.llm import license_sql

    assert all(re.search(license_scan.PROBE, s.lower()) for own in license_scan.SENTENCES.values() for s in own)
    assert {(k, s.replace(license_scan.STAR, " * ")) for s, k in license_scan.known().items()} == set(license_sql.PHRASES)
    assert license_scan.RULES == license_sql.ORDER


# shared -------------------------------------------------------------------------------------------------------------


def test_word_hashes():
    col = pa.array(["ab cd ab", "", None, "  cd ", "ab"])
    for size in (1, 4, 1 << 20):
        seen = []
        for first, off, buf in wordlib.chunks(col, size):
            s, e, r = wordlib.words(off, buf)
            h = wordlib.spans(wordlib.prefix(buf), s, e)
            seen += list(zip((first + r).tolist(), h.tolist(), strict=True))
        assert [i for i, _ in seen] == [0, 0, 0, 3, 4]
        h = [x for _, x in seen]
        assert h[0] == h[2] == h[4] and h[1] == h[3] and h[0] != h[1]
