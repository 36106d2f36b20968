"""WARC archives: written with an index, read back by coalesced byte ranges.

Archives hold one gzip member per record. The index has offset, length, URL and digest of each record; readers take
the records that they want from the index, sort them by place, and fetch neighbours in one ranged read. An archive
counts only through its index: a task that is run again writes another file, and the index of the attempt that Spark
committed names the file that is valid.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach, open_fs, shared_path, table

#: Equal payloads of at least so many bytes are stored once.
REVISIT_BYTES = 100
#: Bytes between two records that one read may skip over, and bytes of a read at most (a longer record is one read).
GAP, RANGE = 64 << 10, 8 << 20
#: Records and bytes of an archive at most.
RECORDS, ARCHIVE = 50_000, 256 << 20
INDEX = "record_id string, file string, offset bigint, length bigint, url string, digest string, record_type string"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(record_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """The bytes of one record, before compression. A revisit has HTTP headers but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    target = "".join(c for c in url or "" if c not in "\r\n")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id}>", f"WARC-Target-URI: {target}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}"]
    if refers_to:
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Header fields (lower case), HTTP headers and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        fields[k.strip().lower().decode()] = v.strip().decode()
    block = rest[: int(fields["content-length"])]
    _, _, payload = block.partition(b"\r\n\r\n")
    return fields | {"payload": payload}


def _writer(folder: str):
    """Batches of (record_id, url, payload, digest, refers_to) to archives; yields index rows once an archive is closed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        fs.create_dir(root, recursive=True)
        out, rows, at, name = None, [], 0, ""

        def close() -> pa.RecordBatch:
            out.close()
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["record_id", "file", "offset", "length", "url", "digest", "record_type"])

        for b in batches:
            for rid, url, payload, digest, refers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    name, rows, at = f"{uuid.uuid4().hex}.warc.gz", [], 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                data = gzip.compress(record(rid, url, payload or b"", digest, refers), 6, mtime=0)
                out.write(data)
                rows.append((rid, name, at, len(data), url, digest, "revisit" if refers else "response"))
                at += len(data)
                if len(rows) >= RECORDS or at >= ARCHIVE:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return run


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """records: record_id, url, payload (binary), digest, refers_to. Writes the archives, then their index as a table."""
    rows = records.select("record_id", "url", "payload", "digest", "refers_to").mapInArrow(_writer(folder), INDEX)
    return table(rows, "warc-index")


def members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of the gzip members in data."""
    at = 0
    while at < len(data):
        z = zlib.decompressobj(31)
        content = z.decompress(data[at:])
        length = len(data) - at - len(z.unused_data)
        yield at, length, content
        at += length


def scan_archive(fs: pafs.FileSystem, path: str, step: int = 1 << 20) -> Iterator[tuple[int, int, dict]]:
    """Walks an archive that has no index: offset, length and parsed record of each member, in steps of memory."""
    with fs.open_input_stream(path, compression=None) as f:
        at, held, z, content, used = 0, b"", zlib.decompressobj(31), [], 0
        while True:
            held = held or f.read(step)
            if not held:
                return
            content.append(z.decompress(held))
            used += len(held) - len(z.unused_data)
            held = z.unused_data
            if z.eof:
                yield at, used, parse(b"".join(content))
                at, z, content, used = at + used, zlib.decompressobj(31), [], 0


def index_archives(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """The index of archives that came without one. files: one string column, names below folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        for b in batches:
            for name in b.column(0).to_pylist():
                rows = [(r["warc-record-id"].strip("<>"), name, o, n, r.get("warc-target-uri"), r["warc-payload-digest"].removeprefix("sha256:"), r["warc-type"]) for o, n, r in scan_archive(fs, f"{root}/{name}")]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["record_id", "file", "offset", "length", "url", "digest", "record_type"])

    return files.repartition(max(1, spark.sparkContext.defaultParallelism)).mapInArrow(run, INDEX)


def ranges(places: list[tuple[int, int]], gap: int = GAP, most: int = RANGE) -> Iterator[tuple[int, int, list[int]]]:
    """Sorted (offset, length) pairs as reads: start, end and the numbers of the records in each."""
    start, end, own = 0, -1, []
    for i, (o, n) in enumerate(places):
        if own and (o - end > gap or o + n - start > most):
            yield start, end, own
            own = []
        if not own:
            start, end = o, o
        own.append(i)
        end = max(end, o + n)
    if own:
        yield start, end, own


def _reader(folder: str):
    """Batches of (file, offset, length), sorted; yields what the records themselves say."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        for b in batches:
            files, offsets, lengths = (c.to_pylist() for c in b.columns)
            a = 0
            while a < len(files):
                z = a
                while z < len(files) and files[z] == files[a]:
                    z += 1
                with fs.open_input_file(f"{root}/{files[a]}") as f:
                    for start, end, own in ranges(list(zip(offsets[a:z], lengths[a:z], strict=True))):
                        data = f.read_at(end - start, start)
                        out = []
                        for i in own:
                            o = offsets[a + i] - start
                            r = parse(gzip.decompress(data[o : o + lengths[a + i]]))
                            stated, refers = r["warc-payload-digest"].removeprefix("sha256:"), r.get("warc-refers-to")
                            if refers is None and hashlib.sha256(r["payload"]).hexdigest() != stated:
                                raise ValueError(f"digest of {r['warc-record-id']} in {files[a]} at {offsets[a + i]}")
                            out.append((r["warc-record-id"].strip("<>"), r["warc-type"], refers and refers.strip("<>"), stated, r["payload"] if refers is None else None))
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.string(), pa.string(), pa.string(), pa.string(), pa.binary()), strict=True)], ["record_id", "record_type", "refers_to", "payload_digest", "payload"])
                a = z

    return run


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that index selects: record_id, record_type, refers_to, payload_digest, payload (null for revisits).
    Records that lie near each other in an archive go to one task and are fetched by few reads; the number of tasks follows
    from the bytes to be read, as the index itself is too small to tell."""
    total = index.agg(F.sum("length")).first()[0] or 0
    places = index.select("file", "offset", "length").withColumn("near", F.expr(f"offset div {RANGE}"))
    dealt = places.repartition(max(1, -(-int(total) // RANGE)), "file", "near").sortWithinPartitions("file", "offset").select("file", "offset", "length")
    return dealt.mapInArrow(_reader(folder), "record_id string, record_type string, refers_to string, payload_digest string, payload binary")


def assign_revisits(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """Records for write_archives: of equal payloads of at least `least` bytes, that with the smallest id is kept. A record's
    name has its id and a hash of its URL and payload, so that rows which repeat an id have records of their own."""
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("tag", F.lower(F.hex(F.xxhash64("url", "digest"))))
    # Only digests move here. The table of repeated ones is written first, so that its size is known: payloads stay in place
    # if it is small enough to be broadcast, and meet it by digest if not.
    first = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "tag")))
    again = rows.where(F.length("payload") >= least).groupBy("digest").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    again = table(again.select("digest", F.col("first.page_id").alias("first"), F.concat(F.lit("urn:page:"), F.col("first.page_id").cast("string"), F.lit(":"), F.col("first.tag")).alias("origin")), "warc-repeated")
    rows = attach(rows, again, ["digest"])
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(":"), F.col("tag"))
    return rows.select(name.alias("record_id"), "url", "payload", "digest", F.when(other, F.col("origin")).alias("refers_to"))


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes pages to archives, reads every record back and resolves revisits. One row per row of pages: page_id,
    payload_bytes, payload_digest, record_type, refers_to.

    A null html is an empty payload, a null url an empty target, a null id a record named "none" that is never referred
    to. Rows that repeat an id and its payload are all responses; rows alike in URL too share a record name. A payload must
    fit into a task, as must a record. Other columns are not looked at. An empty table gives no archive and an empty result.
    """
    spark = pages.sparkSession
    folder = shared_path(spark, "warc")
    index = write_archives(assign_revisits(pages, page_id, url, html), folder)
    back = read_records(index, folder)
    back = table(back.withColumn("payload_bytes", F.length("payload").cast("bigint")).drop("payload"), "warc-read")
    responses = back.where("record_type = 'response'").select("payload_digest", F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias("__bytes"))
    sizes = responses.join(back.where("record_type = 'revisit'").select("refers_to").distinct(), "refers_to", "left_semi").distinct()
    full = attach(back, sizes, ["refers_to", "payload_digest"])
    number = lambda c: F.expr(f"try_cast(split_part({c}, ':', 3) as bigint)")
    return full.select(number("record_id").alias("page_id"), F.coalesce("payload_bytes", "__bytes").alias("payload_bytes"), "payload_digest", "record_type", number("refers_to").alias("refers_to"))
