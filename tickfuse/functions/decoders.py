"""Decoders of packets, by detector type.

The decoders of real detectors are not public. The one here reads a layout of this library's own, and is what a decoder looks
like: a function of the configuration that gives a function from batches of packets to batches of singles.

Plain layout: two unused bytes, the packet's time as 48 bits big-endian (100 fs), then records of 8 bytes, little-endian:
crystal u16, time after the packet's u16, energy f32.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd

from ..schemas import R2SConfig

HEADER, RECORD = 8, np.dtype([("crystal", "<u2"), ("dt", "<u2"), ("energy", "<f4")])
SINGLES = "segment_id bigint, clock_ms bigint, channel int, crystal int, time_100fs bigint, energy float"

Batches = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


class Decoder(Protocol):
    """segment_id, clock_ms, channel, payload in; the columns of SINGLES out."""

    def __call__(self, config: R2SConfig) -> Batches: ...


def without_cross_talk(s: pd.DataFrame, window: int) -> pd.DataFrame:
    """Of a packet's singles on neighbouring crystals within `window` of each other only the stronger stays (the earlier of equals)."""
    s = s.sort_values(["packet", "crystal", "time_100fs"], kind="stable")
    p, c, t, e = (s[x].to_numpy() for x in ("packet", "crystal", "time_100fs", "energy"))
    near = (p[1:] == p[:-1]) & (c[1:] - c[:-1] == 1) & (np.abs(t[1:] - t[:-1]) <= window)
    weak = np.zeros(len(s), bool)
    weak[1:] |= near & (e[1:] < e[:-1])
    weak[:-1] |= near & (e[:-1] < e[1:])
    weak[1:] |= near & (e[1:] == e[:-1])
    return s[~weak].sort_values(["packet", "time_100fs", "crystal"], kind="stable")


def plain(config: R2SConfig) -> Batches:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            good = [p is not None and len(p) >= HEADER for p in b["payload"]]
            b = b[good]
            counts = np.array([(len(p) - HEADER) // RECORD.itemsize for p in b["payload"]], np.int64)
            body = b"".join(bytes(p[HEADER : HEADER + n * RECORD.itemsize]) for p, n in zip(b["payload"], counts, strict=True))
            r, at = np.frombuffer(body, RECORD), np.repeat(np.arange(len(b)), counts)
            t0 = np.array([int.from_bytes(p[2:8], "big") for p in b["payload"]], np.int64)
            s = pd.DataFrame({"packet": at, "segment_id": b["segment_id"].to_numpy()[at], "clock_ms": b["clock_ms"].to_numpy()[at], "channel": b["channel"].to_numpy()[at], "crystal": r["crystal"].astype(np.int32), "time_100fs": t0[at] + r["dt"] + config.time_shift, "energy": r["energy"]})
            if config.cross_talk_enabled:
                s = without_cross_talk(s, config.time_window)
            yield s[s["crystal"] < config.crystals_per_channel].drop(columns="packet")

    return run


def encode_plain(t0: int, records: list[tuple[int, int, float]]) -> bytes:
    return bytes(2) + t0.to_bytes(6, "big") + np.array(records, RECORD).tobytes()


DECODERS: dict[str, Decoder] = {"plain": plain}
