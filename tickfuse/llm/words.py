"""Words and hashes of texts, computed over whole Arrow columns with numpy."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once (a longer text is a chunk of its own).
CHUNK = 512 << 10
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Two tables of byte values, so that two prefix sums give two hashes.
_TABLES = [np.random.default_rng(s).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for s in (77, 78)]
#: Bytes of a word that are hashed by numpy; the rest of a longer one goes to hashlib.
LONG = 128
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_POWERS: dict[str, np.ndarray] = {}
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads low entropy over all of them."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK + (1 << 16))
        up, down = np.full(size, _ODD), np.full(size, np.uint64(pow(int(_ODD), -1, 1 << 64)))
        up[0] = down[0] = 1
        _POWERS["up"], _POWERS["down"] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def prefix(buf: np.ndarray, table: int = 0) -> np.ndarray:
    """prefix[e] - prefix[s], times base**s, is a hash of buf[s:e] that doesn't depend on the place. For short spans only:
    over 1024 bytes there are texts that every such hash modulo 2**64 takes for equal."""
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_TABLES[table][buf] * powers(len(buf) + 1)[1][: len(buf)], out=out[1:])
    return out


def spans(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans, from their prefix sums; the length is part of the hash."""
    return mix((p[end] - p[start]) * powers(len(p))[0][start] + (end - start).astype(np.uint64))


def chunks(column: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cuts a string column (null: empty) into chunks of whole texts: first row, offsets, bytes."""
    column = column.cast(pa.large_binary())
    off = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        z = max(a + 1, int(np.searchsorted(off, off[a] + most, "right")) - 1)
        yield a, off[a : z + 1] - off[a], data[off[a] : off[z]]
        a = z


def words(off: np.ndarray, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes that are not white space) of a chunk, and the row of each."""
    inside = ~_SPACE[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True  # a text's end cuts a word
    before = np.concatenate(([False], inside[:-1])) if len(buf) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate((inside[1:], [False])) if len(buf) else inside
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    rows = np.searchsorted(off, starts, "right") - 1
    return starts, ends, rows


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each span: 8 bytes at a time, each mixed in before the next, so that no choice of
    bytes makes terms cancel as they do in a polynomial."""
    eight = np.ndarray(len(buf) + 1, "<u8", np.concatenate((buf, np.zeros(8, np.uint8))), strides=(1,))
    size = (ends - starts).astype(np.uint64)
    a, b = mix(size + np.uint64(0x243F6A8885A308D3)), mix(size ^ np.uint64(0x13198A2E03707344))
    at, pos = np.flatnonzero(ends - starts <= LONG), starts
    done = 0
    while len(at):
        left = ends[at] - pos[at] - done
        block = eight[pos[at] + done] & _KEEP[np.minimum(left, 8)]
        a[at] = mix(a[at] ^ block)
        b[at] = mix(b[at] + block * _ODD)
        at, done = at[left > 8], done + 8
    for i in np.flatnonzero(ends - starts > LONG).tolist():
        pair = np.frombuffer(hashlib.blake2b(buf[starts[i] : ends[i]].tobytes(), digest_size=16).digest(), "<u8")
        a[i], b[i] = pair
    return a, b


def sequences(first: np.ndarray, second: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """128 bits of each row's sequence of words, from both hashes of its words: cut[i] to cut[i + 1] are those of row i."""
    both = np.ascontiguousarray(np.stack((first, second), 1))
    out = [hashlib.blake2b(both[x:y], digest_size=16).digest() for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
    return np.frombuffer(b"".join(out), "<i8").reshape(-1, 2)
