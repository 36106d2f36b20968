"""Content-defined sampling of byte strings: the anchors that equal windows share.

Of each window of WINDOW bytes the anchor is the start of the K-byte string of the least hash in it, the leftmost of
equals. It is a function of the window's content, so equal windows have equal anchors at equal offsets, which is what a
difference cover gives suffixes by position (a synchronizing set, Kempa and Kociumaka 2019).
"""

from __future__ import annotations

import numpy as np

from .words import mix, prefix, spans

WINDOW, K = 100, 32
#: Windows of a text that are worked on at once; the piece before it ends WINDOW - 1 bytes into it.
PIECE = 1 << 20


def pieces(off: np.ndarray, most: int = PIECE) -> list[tuple[int, int, int]]:
    """Cuts texts (offsets) into (row, first byte, end) such that every window of a text lies in one piece."""
    out = []
    for row, (a, z) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
        while z - a > most + WINDOW - 1:
            out.append((row, a, a + most + WINDOW - 1))
            a += most
        if z - a >= WINDOW:
            out.append((row, a, z))
    return out


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of x[i : i + width], by doubling."""
    size, out = 1, x
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def runs(off: np.ndarray, buf: np.ndarray) -> dict[str, np.ndarray]:
    """Maximal runs of windows with the same anchor: row, start (first window, in the text), n (windows), anchor (hash of
    its K bytes), span and span2 (two hashes of all bytes of the run and the anchor's place in it)."""
    cols: dict[str, list[np.ndarray]] = {c: [] for c in ("row", "start", "n", "anchor", "span", "span2")}
    parts, i = pieces(off), 0
    while i < len(parts):
        j, size = i, 0
        while j < len(parts) and (j == i or size + parts[j][2] - parts[j][1] <= PIECE):
            size += parts[j][2] - parts[j][1]
            j += 1
        own = parts[i:j]
        i = j
        text = np.concatenate([buf[a:z] for _, a, z in own]) if len(own) > 1 else buf[own[0][1] : own[0][2]]
        lengths = np.array([z - a for _, a, z in own])
        ends = np.cumsum(lengths)
        p = prefix(text)
        places = np.arange(len(text) - K + 1)
        grams = spans(p, places, places + K)
        key = (mix(grams) & ~np.uint64((1 << 24) - 1)) | places.astype(np.uint64)
        best = (sliding_least(key, WINDOW - K + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
        owner = np.repeat(np.arange(len(own)), lengths)[: len(best)]
        good = np.arange(len(best)) + WINDOW <= ends[owner]
        new = np.ones(len(best), bool)
        new[1:] = (best[1:] != best[:-1]) | (owner[1:] != owner[:-1]) | ~good[:-1]
        first = np.flatnonzero(new & good)
        stop = np.flatnonzero(good & np.append(new[1:] | ~good[1:], True)) + 1
        at = best[first]
        begin = np.array([a - off[r] for r, a, _ in own]) - (ends - lengths)
        cols["row"].append(np.array([r for r, _, _ in own])[owner[first]])
        cols["start"].append(first + begin[owner[first]])
        cols["n"].append(stop - first)
        cols["anchor"].append(grams[at])
        for c, sums in (("span", p), ("span2", prefix(text, 1))):
            cols[c].append(mix(spans(sums, first, stop + WINDOW - 1) ^ (at - first).astype(np.uint64)))
    return {c: np.concatenate(x) if x else np.zeros(0, np.int64 if c in ("row", "start", "n") else np.uint64) for c, x in cols.items()}
