"""Clustering of a stream of picks, window by window, with what one window hands to the next carried as state.

A window is clustered when the watermark has passed its end. Its clusters are
then merged into those of the window before, which leave the state as finished
members; the others wait for the window after. What a region's windows need is
all that its state holds: the picks that are not yet in a closed window, and
one window's clusters with the picks that they have used.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tremor.operators.clusters import fold_links, share
from tremor.operators.density import PickTimes, hdbscan_picks

MEMBERS = "region string, cluster_id long, pick_ord long"
PICKS = "pick_ord long, us long, station_id string, phase_type string, latitude double, longitude double, eventid string"
CLUSTERS = "cluster_id long, pick_ord long, eventid string"
#: A cluster's id is its window's number times this, plus its label.
WIDTH = 100_000


def merged_windows(before: list[tuple], after: list[tuple], window: int, least: int, width: int = WIDTH) -> tuple[list[tuple], list[tuple]]:
    """Members of the window before, grown by the clusters of ``window`` that go into them, and the members of those that don't.

    Rows are ``(cluster_id, pick_ord, eventid)``.
    """

    def grouped(rows):
        out: dict[int, list[tuple]] = {}
        for r in rows:
            out.setdefault(r[0], []).append(r)
        return out

    old, new = grouped(before), grouped(after)
    picks = lambda rows: [r[1] for r in rows]
    ids = lambda rows: {r[2] for r in rows} - {None}
    # Only clusters with a pick or an event id in common are compared.
    holds: dict[Any, set[int]] = {}
    for c, rows in old.items():
        for x in {("p", p) for p in picks(rows)} | {("e", e) for e in ids(rows)}:
            holds.setdefault(x, set()).add(c)
    links = []
    for c2, rows in new.items():
        near = set().union(*(holds.get(x, set()) for x in {("p", p) for p in picks(rows)} | {("e", e) for e in ids(rows)}))
        links += [(window - 1, c1, window, c2) for c1 in near if share(picks(old[c1]), picks(rows), least) or ids(old[c1]) & ids(rows)]
    by_event: dict[Any, list[int]] = {}
    for c2, rows in new.items():
        for e in ids(rows):
            by_event.setdefault(e, []).append(c2)
    links += [(window, a, window, b) for cs in by_event.values() for a in cs for b in cs if a < b]
    into = fold_links(links)
    finished = {(c, p) for c, p, _ in before} | {(into[c], p) for c, p, _ in after if c in into}
    return sorted(finished), [r for r in after if r[0] not in into]


class WindowClusters(StatefulProcessor):
    """The state of one region; times in microseconds."""

    def __init__(self, start: int, size: int, overlap: int, velocity: float, min_size: int, epsilon: float, least: int):
        self.start, self.size, self.overlap = start, size, overlap
        self.velocity, self.min_size, self.epsilon, self.least = velocity, min_size, epsilon, least

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", PICKS)
        self.before = handle.getListState("before", CLUSTERS)

    def _closes(self, window: int) -> int:
        """Milliseconds at which a window is over."""
        return -(-(self.start + (window + 1) * self.size) // 1000)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        windows: set[int] = set()
        for pdf in rows:
            kept = []
            for r in pdf.itertuples(index=False):
                us, x = int(r.us), int(r.us) - self.start
                own = range(max(x // self.size, 0), (x + self.overlap) // self.size + 1) if x >= 0 else ()
                still = [w for w in own if self._closes(w) > passed]  # of closed windows a pick is never seen
                if still:
                    windows.update(still)
                    kept.append((int(r.pick_ord), us, r.station_id, r.phase_type, float(r.latitude), float(r.longitude), r.eventid if isinstance(r.eventid, str) else None))
            if kept:
                self.waiting.appendList(kept)
        for w in windows | {w + 1 for w in windows}:  # the window after lets go of the clusters, with picks or without
            self.handle.registerTimer(self._closes(w))
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        window = (expiredTimerInfo.getExpiryTimeInMs() * 1000 - self.start) // self.size - 1
        begin, end = self.start + window * self.size - self.overlap, self.start + (window + 1) * self.size
        waiting = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        after = self._clustered([r for r in waiting if begin <= r[1] < end], window)
        before = [tuple(r) for r in self.before.get()] if self.before.exists() else []
        stale = [r for r in before if r[0] // WIDTH != window - 1]
        finished, rest = merged_windows([r for r in before if r[0] // WIDTH == window - 1], after, window, self.least)
        finished = sorted(set(finished) | {(c, p) for c, p, _ in stale})
        keep = [r for r in waiting if r[1] >= end - self.overlap]
        for state, values in ((self.waiting, keep), (self.before, rest)):
            state.put(values) if values else state.clear()
        if finished:
            yield pd.DataFrame({"region": [key[0]] * len(finished), "cluster_id": [c for c, _ in finished], "pick_ord": [p for _, p in finished]})

    def _clustered(self, rows: list[tuple], window: int) -> list[tuple]:
        rows = sorted(rows, key=lambda r: (r[1], r[2], r[3], r[0]))
        if len(rows) < self.min_size:
            return []
        column = lambda k: np.array([r[k] for r in rows])
        labels, _ = hdbscan_picks(PickTimes(column(1), column(4), column(5), self.velocity), self.min_size, self.epsilon)
        return [(int(window * WIDTH + k), r[0], r[6]) for k, r in zip(labels, rows, strict=True) if k >= 0]

    def close(self) -> None:
        pass


def cluster_stream(stream: DataFrame, start_us: int, seconds: float = 900.0, overlap: float = 60.0, velocity: float = 5.0, min_size: int = 8, epsilon: float = 0.0, least: int = 6, delay: str = "60 seconds", region: str | None = None) -> DataFrame:
    """``region, cluster_id, pick_ord`` of finished clusters, from a stream of located picks (``phase_time`` a timestamp).

    Windows are counted from ``start_us`` on, as :func:`windows.assign` does
    with that start. A column ``region`` parts the picks into states of their
    own; without it there is one. Needs the RocksDB state store.
    """
    key = F.coalesce(F.col(region).cast("string"), F.lit("")) if region else F.lit("")
    rows = stream.withWatermark("phase_time", delay).select("phase_time", key.alias("region"), "pick_ord", F.unix_micros("phase_time").alias("us"), "station_id", "phase_type", "latitude", "longitude", "eventid")
    made = WindowClusters(start_us, round(seconds * 1e6), round(overlap * 1e6), velocity, min_size, epsilon, least)
    return rows.groupBy("region").transformWithStateInPandas(made, MEMBERS, "Append", "EventTime")
