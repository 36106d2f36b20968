"""Clock offsets of clients on a live stream: one fold per client, kept as state over micro-batches."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.folds import mean_towards_zero

STATE = "offsets array<bigint>, times array<bigint>, drift_ppm double, latency_ms double, syncs bigint"
RESULT = "client bigint, seq bigint, avg_offset bigint, drift_ppm double, confidence double, latency_ms double, syncs bigint"


def streaming_offsets(samples: DataFrame, last: int = 100, gate: int = 50_000_000, least: int = 10) -> DataFrame:
    """A stream of (client, seq, time_ns, offset_ns, delay_ms) to one row per sample, with the client's state after it.

    An offset that is `gate` or more from the mean of the last accepted ones is not accepted; drift is given from `least`
    accepted ones on, else null. The latency average starts at 0. Samples of a micro-batch are taken by seq, and
    micro-batches as they come, so a client's state is of bounded size however long the stream. A null in a sample's
    client, seq, time or offset drops it; a null delay counts as 0.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else ([], [], None, 0.0, 0)
        offsets, times = deque(held[0], last), deque(held[1], last)
        drift, latency, syncs = held[2:]
        rows = []
        for s in pd.concat(list(frames)).sort_values(["seq", "time_ns", "offset_ns"]).itertuples():
            if not offsets or abs(s.offset_ns - mean_towards_zero(offsets)) < gate:
                offsets.append(int(s.offset_ns))
                times.append(int(s.time_ns))
                if len(offsets) >= least and times[-1] > times[0]:
                    drift = (offsets[-1] - offsets[0]) / (times[-1] - times[0]) * 1e6
            latency, syncs = 0.7 * latency + 0.3 * s.delay_ms, syncs + 1
            rows.append((key[0], s.seq, mean_towards_zero(offsets), drift, min(len(offsets) / 10, 1.0), latency, syncs))
        state.update((list(offsets), list(times), drift, latency, syncs))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")]).astype({"drift_ppm": float})

    clean = samples.select("client", "seq", "time_ns", "offset_ns", "delay_ms").dropna(subset=["client", "seq", "time_ns", "offset_ns"]).fillna(0.0, ["delay_ms"])
    return clean.groupBy("client").applyInPandasWithState(run, RESULT, STATE, "append", GroupStateTimeout.NoTimeout)
