"""Stateful stream operators: exact duplicates, scores of closed windows, alert cooldown.

State is one row per key and has an end: an event-time timer removes it once the watermark says that it can change
nothing any more. Rows behind the watermark are left out by Spark, so `lateness` is how long a job waits for them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import MapType, StructType

from ..functions.timing import DAY, to_ts
from ..operators.alerts import COOLDOWN
from ..operators.anomaly import SIGMAS, WINDOW_HISTORY
from ..operators.dedup import DEDUP_TTL

LATENESS = "24 hours"
IDLE = 90 * DAY  # as long as windows are kept
TIME = "_event_time"
KEY, BUCKET = "dedup_key", "dedup_bucket"  # without a leading underscore: rows reach Python as named tuples
BUCKETS = 1024  # of jobs over many keys
SHIFT = 100 * 365 * DAY  # a stream's watermark begins at 1970, and what is not after it is late: times count from a century earlier

SCORED = "tenant_id string, event_type string, window_start bigint, count bigint, z_score double, is_anomaly boolean"


def _stateful(rows: DataFrame, keys: list[str], ts: str, lateness: str, processor: StatefulProcessor, out: StructType | str) -> DataFrame:
    timed = rows.withColumn(TIME, to_ts(F.col(ts) + SHIFT)).withWatermark(TIME, lateness)
    return timed.groupBy(*keys).transformWithStateInPandas(processor, outputStructType=out, outputMode="append", timeMode="EventTime")


class Expiring(StatefulProcessor):
    """Keeps one value per key until the watermark passes the time that goes with it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.layout)

    def keep(self, value: tuple, until: int) -> None:
        """`until` is the last field of the value, so a timer can tell whether it is still the one that counts."""
        self.state.update((*value, until))
        self.handle.registerTimer(until + SHIFT)

    def kept(self) -> tuple | None:
        return tuple(self.state.get()) if self.state.exists() else None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self.kept()
        if known is not None and known[-1] + SHIFT <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


class DuplicateGate(Expiring):
    """Lets an arrival through if no accepted one of its key is less than a period before or after it."""

    layout = "taken array<bigint>, until bigint"

    def __init__(self, ts: str, seq: str, ttl_ms: int, columns: list[str]):
        self.ts, self.seq, self.ttl_ms, self.columns = ts, seq, ttl_ms, columns

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values([self.ts, self.seq], ignore_index=True)
        known = self.kept()
        before = list(known[0]) if known else []
        keep, own, last = [], [], None
        for i, at in enumerate(frame[self.ts].tolist()):
            if (last is None or at - last >= self.ttl_ms) and all(abs(at - b) >= self.ttl_ms for b in before):
                keep.append(i)
                own.append(at)
                last = at
        if own:
            # what can still block a row that is not behind the watermark
            oldest = timerValues.getCurrentWatermarkInMs() - SHIFT - self.ttl_ms
            taken = sorted(t for t in before + own if t > oldest)
            if taken:
                self.keep((taken,), taken[-1] + self.ttl_ms)
        yield frame.loc[keep, self.columns]


class BucketGate(DuplicateGate):
    """The same for all keys of a bucket at once: one call and one state row for the bucket, which holds each key's times."""

    layout = "taken map<string,array<bigint>>, until bigint"

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values([self.ts, self.seq], ignore_index=True)
        known = self.kept()
        before = dict(known[0]) if known else {}
        keep, own = [], {}
        for i, (k, at) in enumerate(zip(frame[KEY].tolist(), frame[self.ts].tolist(), strict=True)):
            mine = own.get(k)
            if (mine is None or at - mine[-1] >= self.ttl_ms) and all(abs(at - b) >= self.ttl_ms for b in before.get(k, ())):
                keep.append(i)
                own.setdefault(k, []).append(at)
        oldest = timerValues.getCurrentWatermarkInMs() - SHIFT - self.ttl_ms
        times = {k: sorted(int(t) for t in (*before.get(k, ()), *own.get(k, ())) if t > oldest) for k in {**before, **own}}
        taken = {k: t for k, t in times.items() if t}
        if taken and taken != {k: list(t) for k, t in before.items()}:
            self.keep((taken,), max(t[-1] for t in taken.values()) + self.ttl_ms)
        yield frame.loc[keep, self.columns]


def drop_duplicates_exact(
    events: DataFrame, keys: list[str], ts: str = "timestamp", seq: str = "seq", ttl_ms: int = DEDUP_TTL, lateness: str = LATENESS, buckets: int | None = None
) -> DataFrame:
    """Accepted arrivals of a stream: a key is free again `ttl_ms` after (and before) its accepted ones; copies do not extend that.

    A key's state is the few accepted times that lie less than a period behind the watermark; it goes when the watermark
    has passed the last of them by a period. A task holds the rows of one key of one micro-batch.

    Each call into Python for a key and its state costs milliseconds, whatever it does. With `buckets`, keys are dealt by
    hash into that many, which share a call, a state row and a timer; a task then holds the rows of one bucket of one
    micro-batch. The number must stay the same for the life of a checkpoint.
    """
    # Maps travel as JSON text: a Python worker would give them back as lists of pairs.
    maps = {f.name: f.dataType for f in events.schema if isinstance(f.dataType, MapType)}
    slim = events.withColumns({c: F.to_json(c) for c in maps})
    if buckets is None:
        accepted = _stateful(slim, keys, ts, lateness, DuplicateGate(ts, seq, ttl_ms, slim.columns), slim.schema)
    else:
        dealt = slim.withColumns({KEY: F.to_json(F.struct(*keys)), BUCKET: F.pmod(F.xxhash64(*keys), F.lit(buckets))})
        accepted = _stateful(dealt, [BUCKET], ts, lateness, BucketGate(ts, seq, ttl_ms, slim.columns), slim.schema)
    return accepted.withColumns({c: F.from_json(c, kind) for c, kind in maps.items()})


class HistoryScorer(Expiring):
    """Keeps the last counts of a (tenant, type) and scores each new one against them."""

    layout = "counts array<bigint>, until bigint"

    def __init__(self, history: int, min_history: int, sigmas: float, idle_ms: int = IDLE):
        self.history, self.min_history, self.sigmas, self.idle_ms = history, min_history, sigmas, idle_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.kept()
        past = list(known[0]) if known else []
        frame = pd.concat(list(rows)).sort_values("window_start", ignore_index=True)
        scores: list[float] = []
        for x in frame["count"].tolist():
            scores.append(self._score(past, x))
            past = (past + [x])[-self.history :]
        newest = int(frame["window_start"].iloc[-1])
        self.keep((past,), max(newest + self.idle_ms, known[-1] if known else 0))
        frame["z_score"] = scores
        frame["is_anomaly"] = frame["z_score"] > self.sigmas
        yield frame[["tenant_id", "event_type", "window_start", "count", "z_score", "is_anomaly"]]

    def _score(self, past: list[int], x: int) -> float:
        """The batch formula, on exact whole numbers."""
        n, total = len(past), sum(past)
        spread = n * sum(v * v for v in past) - total * total
        if n < self.min_history or spread == 0:
            return 0.0
        return abs(n * x - total) / math.sqrt(spread)


def score_windows(
    windows: DataFrame, history: int = WINDOW_HISTORY, min_history: int = 10, sigmas: float = SIGMAS, lateness: str = LATENESS, idle_ms: int = IDLE
) -> DataFrame:
    """Z-scores of a stream of closed windows (tenant_id, event_type, window_start, count).

    With history=10 this is the short ring of the running check. Windows of a key must arrive in
    time order between micro-batches, which closed windows do. A key without windows for `idle_ms` starts anew.
    """
    slim = windows.select("tenant_id", "event_type", "window_start", "count")
    return _stateful(slim, ["tenant_id", "event_type"], "window_start", lateness, HistoryScorer(history, min_history, sigmas, idle_ms), SCORED)


class CooldownGate(Expiring):
    """Remembers when a rule last fired and lets a candidate through once the pause is over."""

    layout = "last_fired bigint, until bigint"

    def __init__(self, cooldown_ms: int, columns: list[str]):
        self.cooldown_ms, self.columns = cooldown_ms, columns

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.kept()
        before = last = known[0] if known else None
        frame = pd.concat(list(rows)).sort_values(["fired_at", "tenant_id"], ignore_index=True)
        keep = []
        for at in frame["fired_at"].tolist():
            fires = last is None or at - last >= self.cooldown_ms
            last = at if fires else last
            keep.append(fires)
        if last != before:
            self.keep((last,), last + self.cooldown_ms)
        yield frame.loc[keep, self.columns]


def apply_cooldown(candidates: DataFrame, cooldown_ms: int = COOLDOWN, per_tenant: bool = False, lateness: str = LATENESS) -> DataFrame:
    """Candidates of a stream that fire; time is event time.

    A rule's state goes once the watermark has passed the end of its cooldown: any later candidate fires without it.
    """
    keys = ["rule_id", "tenant_id"] if per_tenant else ["rule_id"]
    return _stateful(candidates, keys, "fired_at", lateness, CooldownGate(cooldown_ms, candidates.columns), candidates.schema)
