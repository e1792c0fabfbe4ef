"""Keyed state for the features of a stream, by entity."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..contract import ACTIONS, COUNTERPART, DAY, WINDOWS

SNAPSHOT = "entity_type string, entity_id string, as_of_time bigint, features map<string,double>"
_TOTALS = "count bigint, value double, first bigint, last bigint, days bigint, scenes bigint, others bigint, " + ", ".join(
    [*[f"recent_{n} bigint" for n in WINDOWS], *[f"{a} bigint" for a in ACTIONS]]
)


class _Times:
    """Counts of events by time, in one row of state for each day, read and written only where a batch needs them."""

    def __init__(self, state) -> None:
        self.state, self.days, self.dirty = state, {}, set()

    def day(self, day: int) -> dict[int, int]:
        if day not in self.days:
            row = self.state.getValue((day,)) if self.state.containsKey((day,)) else None
            self.days[day] = dict(zip(*row, strict=True)) if row else {}
        return self.days[day]

    def add(self, t: int) -> None:
        counts = self.day(t // DAY)
        counts[t] = counts.get(t, 0) + 1
        self.dirty.add(t // DAY)

    def between(self, low: int, high: int) -> int:
        """Events at ``low <= t < high``."""
        return sum(n for d in range(low // DAY, -(-high // DAY)) for t, n in self.day(d).items() if low <= t < high) if low < high else 0

    def drop(self, low: int, high: int) -> None:
        """Forget the days that lie wholly in ``low <= t < high``, of which the first may begin earlier."""
        for d in range(low // DAY, high // DAY):
            self.day(d).clear()
            self.dirty.add(d)

    def store(self) -> None:
        for d in self.dirty:
            if self.days[d]:
                self.state.updateValue((d,), (list(self.days[d]), list(self.days[d].values())))
            elif self.state.containsKey((d,)):
                self.state.removeKey((d,))


class FeatureProcessor(StatefulProcessor):
    """Totals in a value state; distinct values in map states, a row for each; counts by time in a map state, a row for each day.

    The totals hold the rolling counts as of the latest event.  As it advances, only the days that a window's lower bound passes
    are read, and days older than the longest window are removed.  Emits a snapshot after each
    batch of a key, or after each update if ``every`` is set.
    """

    def __init__(self, every: bool = False) -> None:
        self.every = every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", _TOTALS)
        self.days = handle.getMapState("days", "day bigint", "seen boolean")
        self.scenes = handle.getMapState("scenes", "scene string", "seen boolean")
        self.others = handle.getMapState("others", "other string", "seen boolean")
        self.times = handle.getMapState("times", "day bigint", "times array<bigint>, counts array<bigint>")

    @staticmethod
    def _new(state, keys) -> int:
        """How many of the values are new to the state, which then has them."""
        new = [k for k in keys if not state.containsKey((k,))]
        for k in new:
            state.updateValue((k,), (True,))
        return len(new)

    def _advance(self, old: tuple, part: pd.DataFrame, times: _Times) -> tuple:
        """The totals after some updates."""
        count, value, first, last, days, scenes, others, *rest = old
        recent, acts = rest[: len(WINDOWS)], rest[len(WINDOWS) :]
        t = part["event_time"].astype("int64")
        at = max(last, int(t.max()))
        for k, n in enumerate(WINDOWS):
            recent[k] += int((t >= at - n * DAY).sum()) - times.between(last - n * DAY, min(at - n * DAY, last + 1))
        oldest = at - max(WINDOWS) * DAY
        times.drop(last - max(WINDOWS) * DAY, min(oldest, last + 1))
        for x in t[t >= oldest].tolist():
            times.add(x)
        kinds = part["event_type"].value_counts()
        return (
            count + len(part),
            sum(part["value"].tolist(), value),
            int(t.min()) if first is None else min(first, int(t.min())),
            at,
            days + self._new(self.days, {x // DAY if x >= 0 else -(-x // DAY) for x in t.tolist()}),
            scenes + self._new(self.scenes, set(part["scene"].dropna())),
            others + self._new(self.others, set(part["counterpart_id"].dropna())),
            *recent,
            *[n + int(kinds.get(a, 0)) for n, a in zip(acts, ACTIONS, strict=True)],
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        kind, name = key
        totals = self.totals.get() if self.totals.exists() else None
        totals = tuple(totals or (0, 0.0, None, 0, 0, 0, 0, *[0] * (len(WINDOWS) + len(ACTIONS))))
        times, out = _Times(self.times), []
        for part in rows:
            for some in (part.iloc[k : k + 1] for k in range(len(part))) if self.every else (part,):
                if len(some):
                    totals = self._advance(totals, some, times)
                    if self.every:
                        out.append(totals)
        times.store()
        self.totals.update(totals)
        out = out if self.every else [totals]
        yield pd.DataFrame(
            {
                "entity_type": [kind] * len(out),
                "entity_id": [name] * len(out),
                "as_of_time": [x[3] for x in out],
                "features": [self._features(kind, *x) for x in out],
            }
        )

    @staticmethod
    def _features(kind, count, value, first, last, days, scenes, others, *rest) -> dict[str, float]:
        recent, acts = rest[: len(WINDOWS)], rest[len(WINDOWS) :]
        clicks, exposes = acts[0], acts[1]
        found = {
            "event_count": count,
            "event_value_sum": value,
            "event_value_mean": value / count,
            "event_active_days": days,
            "event_unique_scene_count": scenes,
            COUNTERPART[kind]: others,
            "event_first_time": first,
            "event_last_time": last,
            "event_recency_seconds": 0,
            **{f"event_count_{n}d": c for n, c in zip(WINDOWS, recent, strict=True)},
            **{f"event_{a}_count": n for a, n in zip(ACTIONS, acts, strict=True)},
            "event_click_rate": clicks / (clicks + exposes) if clicks + exposes else 0,
        }
        return {k: float(v) for k, v in found.items()}


def stream_features(updates: DataFrame, every: bool = False) -> DataFrame:
    """Stream of snapshots from a stream of updates.  Late events are never dropped."""
    return updates.groupBy("entity_type", "entity_id").transformWithStateInPandas(
        FeatureProcessor(every), outputStructType=SNAPSHOT, outputMode="Update", timeMode="None"
    )
