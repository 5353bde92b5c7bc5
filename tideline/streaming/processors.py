"""Keyed state machines for streams.

A processor sees one key's rows of a micro-batch as Arrow batches. It puts them
in order by time and sequence before it touches its state, because arrival order
inside a micro-batch is not defined. The rows of one key held at a time are thus
bounded by the source's rate limit (``maxOffsetsPerTrigger``,
``maxFilesPerTrigger``), which a stream with hot keys should set. Results that
do not need one output per input use plain streaming aggregates instead, see
:mod:`tideline.streaming.streams`.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def _ordered(batches: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    parts = list(batches)
    rows = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]
    return rows.sort_values(by, kind="stable", ignore_index=True)


def _frame(rows: list[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    """One output batch, or none when there are no rows."""
    if rows:
        yield pd.DataFrame(rows, columns=columns, dtype=object)


def _load(state, default):
    found = state.get() if state.exists() else None
    return found[0] if found is not None else default


class RunningStats(StatefulProcessor):
    """Count, sum and average so far, at every row."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("stats", "n long, total double")

    def handleInputRows(self, key, rows, timerValues):
        out = _ordered(rows, ["seq"])
        n, total = self.state.get() if self.state.exists() else (0, 0.0)
        counts = n + pd.RangeIndex(1, len(out) + 1).to_series(index=out.index)
        sums = total + out["value"].fillna(0.0).cumsum()
        self.state.update((int(counts.iloc[-1]), float(sums.iloc[-1])))
        yield pd.DataFrame(
            {"key": out["key"], "seq": out["seq"], "count": counts, "sum": sums, "avg": sums / counts}
        )

    def close(self) -> None:
        pass


class RecentValues(StatefulProcessor):
    """The last ``n`` values at every row, oldest first."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getListState("recent", "value double")

    def handleInputRows(self, key, rows, timerValues):
        out = _ordered(rows, ["seq"])
        recent = [v for (v,) in self.state.get()] if self.state.exists() else []
        values = recent + out["value"].tolist()
        start = len(recent)
        lists = [values[max(0, i - self.n + 1) : i + 1] for i in range(start, len(values))]
        self.state.put([(v,) for v in values[-self.n :]])
        yield pd.DataFrame({"key": out["key"], "seq": out["seq"], "recent": lists})

    def close(self) -> None:
        pass


class ThresholdAlerts(StatefulProcessor):
    """Rows above the latest threshold of their key that came before them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("threshold", "threshold double")

    def handleInputRows(self, key, rows, timerValues):
        threshold = _load(self.state, None)
        before = threshold
        found = []
        for row in _ordered(rows, ["seq"]).itertuples(index=False):
            if row.is_config:
                threshold = row.value
                found.append((row.key, row.seq, row.value, threshold, "config"))
            elif threshold is not None and row.value > threshold:
                found.append((row.key, row.seq, row.value, threshold, "alert"))
        if threshold is not None and threshold != before:
            self.state.update((float(threshold),))
        yield from _frame(found, ["key", "seq", "value", "threshold", "kind"])

    def close(self) -> None:
        pass


class RepeatedEvents(StatefulProcessor):
    """``times`` matching events in less than ``within_us``, overlapping matches included.

    Only the times of the last ``times - 1`` matching events are kept.
    """

    def __init__(self, times: int, within_us: int):
        self.times, self.within_us = times, within_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getListState("starts", "us long, seq long")

    def handleInputRows(self, key, rows, timerValues):
        starts = [tuple(r) for r in self.state.get()] if self.state.exists() else []
        found = []
        for row in _ordered(rows, ["us", "seq"]).itertuples(index=False):
            starts.append((row.us, row.seq))
            if len(starts) >= self.times:
                us, seq = starts[-self.times]
                if row.us - us < self.within_us:
                    found.append((row.key, seq, us, row.us))
            starts = starts[-(self.times - 1) :] if self.times > 1 else []
        self.state.put([(int(us), int(seq)) for us, seq in starts])
        yield from _frame(found, ["key", "seq", "start_us", "end_us"])

    def close(self) -> None:
        pass


class Inactivity(StatefulProcessor):
    """Alerts when a key had no row for ``timeout_ms`` of processing time."""

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("deadline", "at long")

    def handleInputRows(self, key, rows, timerValues):
        for _ in rows:
            pass
        previous = _load(self.state, None)
        if previous is not None:
            self.handle.deleteTimer(previous)
        deadline = timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms
        self.handle.registerTimer(deadline)
        self.state.update((deadline,))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if _load(self.state, None) == expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
            yield from _frame([(key[0], expiredTimerInfo.getExpiryTimeInMs())], ["key", "timeout_at_ms"])

    def close(self) -> None:
        pass


class OrderTimeouts(StatefulProcessor):
    """Order messages and timeouts; see :func:`tideline.operators.patterns.order_timeouts`.

    Deadlines that lie before a row are settled before the row is, so a late
    micro-batch boundary cannot disarm a timer that was already due. The engine's
    timers settle what no further row does.
    """

    def __init__(self, timeout_us: int):
        self.timeout_us = timeout_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.paid = handle.getValueState("paid", "paid boolean")
        self.armed = handle.getListState("armed", "due long, seq long")
        self.latest = handle.getValueState("latest", "due long")

    def _settle(self, armed, paid, key, until):
        """Deadlines before ``until`` leave; unpaid ones are reported."""
        due = [a for a in armed if a[0] < until]
        fired = [(key, seq, at, "TIMEOUT") for at, seq in due if paid is False]
        return [a for a in armed if a[0] >= until], fired

    def handleInputRows(self, key, rows, timerValues):
        paid, latest = _load(self.paid, None), _load(self.latest, None)
        armed = sorted(tuple(r) for r in self.armed.get()) if self.armed.exists() else []
        found = []
        for row in _ordered(rows, ["us", "seq"]).itertuples(index=False):
            armed, fired = self._settle(armed, paid, row.key, row.us)
            found += fired
            if row.action == "create":
                latest, paid = int(row.us + self.timeout_us), False
                armed.append((latest, int(row.seq)))
                self.handle.registerTimer(-(-latest // 1000))
                found.append((row.key, row.seq, row.us, "created"))
            elif row.action in ("pay", "cancel"):
                armed = [a for a in armed if a[0] != latest]
                paid = True if row.action == "pay" else paid
                found.append((row.key, row.seq, row.us, "paid" if row.action == "pay" else "cancelled"))
        self._save(armed, paid, latest)
        yield from _frame(found, ["key", "seq", "us", "status"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        paid = _load(self.paid, None)
        armed = sorted(tuple(r) for r in self.armed.get()) if self.armed.exists() else []
        until = expiredTimerInfo.getExpiryTimeInMs() * 1000 + 1
        armed, fired = self._settle(armed, paid, key[0], until)
        self._save(armed, paid, _load(self.latest, None))
        yield from _frame(fired, ["key", "seq", "us", "status"])

    def _save(self, armed, paid, latest) -> None:
        if armed:
            self.armed.put(armed)
        else:
            self.armed.clear()
        if paid is not None:
            self.paid.update((paid,))
        if latest is not None:
            self.latest.update((latest,))

    def close(self) -> None:
        pass


class TtlCounter(StatefulProcessor):
    """Counts a key's rows; the count is forgotten after ``ttl_ms`` without one."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("count", "n long", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        out = _ordered(rows, ["seq"])
        n = _load(self.state, 0)
        counts = [n + i for i in range(1, len(out) + 1)]
        self.state.update((counts[-1],))
        yield pd.DataFrame({"key": out["key"], "seq": out["seq"], "session_count": counts})

    def close(self) -> None:
        pass


class LateMarker(StatefulProcessor):
    """Marks rows whose window was over at the watermark of their micro-batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues):
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        for batch in rows:
            yield pd.DataFrame(
                {"seq": batch["seq"], "us": batch["us"], "value": batch["value"], "is_late": batch["end_us"] <= watermark}
            )

    def close(self) -> None:
        pass


class AsOfJoin(StatefulProcessor):
    """Facts with the version of their key that was current at their time, once the watermark has passed them.

    State are a key's facts that still wait and its versions from the one current at the watermark on.
    """

    def __init__(self, strict: bool):
        self.strict = strict

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.versions = handle.getListState("versions", "us long, tie long, version string")
        self.facts = handle.getListState("facts", "us long, tie long, fact string")

    def handleInputRows(self, key, rows, timerValues):
        facts, versions = [], []
        for batch in rows:
            for row in batch.itertuples(index=False):
                (facts if row.is_fact else versions).append((int(row.us), int(row.tie), row.body))
        if versions:
            self.versions.appendList(versions)
        if facts:
            self.facts.appendList(facts)
        for us in {-(-us // 1000) for us, _, _ in facts} | ({-(-max(versions)[0] // 1000)} if versions else set()):
            self.handle.registerTimer(us)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = expiredTimerInfo.getExpiryTimeInMs() * 1000
        facts = sorted(tuple(f) for f in self.facts.get()) if self.facts.exists() else []
        versions = sorted(tuple(v) for v in self.versions.get()) if self.versions.exists() else []
        due = [f for f in facts if f[0] <= passed]
        at = [v[0] if self.strict else v[0] - 1 for v in versions]  # a fact later than this sees the version
        found = []
        for us, tie, fact in due:
            n = bisect_left(at, us)
            if n:
                found.append((key[0], fact, versions[n - 1][2]))
        self._put(self.facts, facts[len(due) :])
        self._put(self.versions, versions[max(0, bisect_left(at, passed) - 1) :])
        yield from _frame(found, ["key", "fact", "version"])

    @staticmethod
    def _put(state, rows) -> None:
        if rows:
            state.put(rows)
        else:
            state.clear()

    def close(self) -> None:
        pass


class LastImage(StatefulProcessor):
    """A key's net change of each micro-batch: its former image leaves, its new one comes. Older changes have no effect."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("image", "seq long, image string")

    def handleInputRows(self, key, rows, timerValues):
        seq, before = self.state.get() if self.state.exists() else (None, None)
        last = None
        for batch in rows:
            n = batch["seq"].to_numpy().argmax()
            if last is None or batch["seq"].iloc[n] > last[0]:
                last = (int(batch["seq"].iloc[n]), batch["image"].iloc[n])
        if seq is not None and last[0] <= seq:
            return
        after = None if last[1] is None or last[1] != last[1] else str(last[1])
        self.state.update((last[0], after))
        if after != before:
            yield from _frame([(i, s) for i, s in ((before, -1), (after, 1)) if i is not None], ["image", "sign"])

    def close(self) -> None:
        pass


class SignedCount(StatefulProcessor):
    """Rows of a group after its signed changes; a group that has none left is forgotten."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("n", "n long")

    def handleInputRows(self, key, rows, timerValues):
        before = _load(self.state, 0)
        n = before + int(sum(int(batch["sign"].sum()) for batch in rows))
        if n:
            self.state.update((n,))
        elif before:
            self.state.clear()
        if n != before:
            yield from _frame([(key[0], n)], ["image", "n"])

    def close(self) -> None:
        pass


class SaltTop(StatefulProcessor):
    """The ``n`` largest sums of a part of a window's keys, whenever they change.

    All sums of the part are state, so that a sum that falls makes room for the next one. The list itself is state
    too: as long as no listed sum falls, only the keys of the micro-batch can enter it.
    """

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getMapState("sums", "key string", "total double")
        self.top = handle.getListState("top", "key string, total double")

    def handleInputRows(self, key, rows, timerValues):
        added: dict[str, float] = {}
        for batch in rows:
            for k, v in batch.groupby("key")["value"].sum().items():
                added[k] = added.get(k, 0.0) + float(v)
        top = {k: t for k, t in self.top.get()} if self.top.exists() else {}
        fell = False
        for k, v in added.items():
            total = v + (self.sums.getValue((k,))[0] if self.sums.containsKey((k,)) else 0.0)
            self.sums.updateValue((k,), (total,))
            fell |= k in top and total < top[k]
            added[k] = total
        known = {k[0]: t[0] for k, t in self.sums.iterator()} if fell else {**top, **added}
        best = sorted(known.items(), key=lambda x: (-x[1], x[0]))[: self.n]
        if dict(best) != top:
            self.top.put(best)
            listed = [[k, t] for k, t in best]
            yield pd.DataFrame({"window_us": [key[0]], "salt": [key[1]], "top": [json.dumps(listed)]})

    def close(self) -> None:
        pass


class WindowTop(StatefulProcessor):
    """A window's ``n`` largest sums from the lists of its parts, numbered anew whenever they change."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.parts = handle.getMapState("parts", "salt long", "top string")
        self.state = handle.getValueState("last", "version long, top string")

    def handleInputRows(self, key, rows, timerValues):
        for batch in rows:
            for salt, top in zip(batch["salt"], batch["top"]):
                self.parts.updateValue((int(salt),), (top,))
        listed = [(k, t) for _, (top,) in self.parts.iterator() for k, t in json.loads(top)]
        best = sorted(listed, key=lambda x: (-x[1], x[0]))[: self.n]
        version, last = self.state.get() if self.state.exists() else (0, "")
        text = json.dumps(best)
        if text != last:
            self.state.update((version + 1, text))
            found = [(key[0], version + 1, rank + 1, k, t) for rank, (k, t) in enumerate(best)]
            yield from _frame(found, ["window_us", "version", "rank", "key", "total"])

    def close(self) -> None:
        pass


class SequenceMatches(StatefulProcessor):
    """Sequences of steps; ``hits`` says which steps an event fits, ``strict`` which must follow at once.

    ``waiting`` holds the starts that have come to each step; matches at one step go on together.
    """

    def __init__(self, strict: list[bool], within_us: int):
        self.strict, self.within_us = strict, within_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getListState("waiting", "step int, us long, seq long")

    def handleInputRows(self, key, rows, timerValues):
        waiting: list[list] = [[] for _ in self.strict]
        for step, us, seq in self.state.get() if self.state.exists() else ():
            waiting[step].append((us, seq))
        found, last = [], len(self.strict) - 1
        for row in _ordered(rows, ["us", "seq"]).itertuples(index=False):
            for n in range(last, 0, -1):
                if row.hits >> n & 1:
                    if n == last:
                        found += [(row.key, seq, us, row.us) for us, seq in waiting[n] if row.us - us < self.within_us]
                    else:
                        waiting[n + 1] += [w for w in waiting[n] if row.us - w[0] < self.within_us]
                    waiting[n] = []
                elif self.strict[n]:
                    waiting[n] = []
            if row.hits & 1:
                waiting[1].append((int(row.us), int(row.seq)))
        kept = [(n, int(us), int(seq)) for n, starts in enumerate(waiting) for us, seq in starts]
        if kept:
            self.state.put(kept)
        else:
            self.state.clear()
        yield from _frame(found, ["key", "seq", "start_us", "end_us"])

    def close(self) -> None:
        pass


class GlobalSessions(StatefulProcessor):
    """Sessions over all rows, from cells of one gap each; a session ends when no cell that could go on with it can come.

    A cell comes once the watermark has passed its end, so the cells before the watermark are all there.
    """

    def __init__(self, gap_us: int):
        self.gap_us = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cells = handle.getListState("cells", "first long, last long, n long, total double")

    def handleInputRows(self, key, rows, timerValues):
        cells = [tuple(map(int, r[:3])) + (float(r[3]),) for b in rows for r in b[["first", "last", "n", "total"]].itertuples(index=False)]
        self.cells.appendList(cells)
        for first, last, *_ in cells:
            # The cell in which the session could go on at the latest is over one gap after that.
            self.handle.registerTimer(-(-(last + 2 * self.gap_us) // 1000))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        over = expiredTimerInfo.getExpiryTimeInMs() * 1000
        cells = sorted(tuple(c) for c in self.cells.get()) if self.cells.exists() else []
        sessions: list[list] = []
        for first, last, n, total in cells:
            if sessions and first <= sessions[-1][1] + self.gap_us:
                session = sessions[-1]
                session[1:] = [max(session[1], last), session[2] + n, session[3] + total]
            else:
                sessions.append([first, last, n, total])
        closed = [s for s in sessions if s[1] + 2 * self.gap_us <= over]
        rest = [tuple(s) for s in sessions if s[1] + 2 * self.gap_us > over]
        if rest:
            self.cells.put(rest)  # merged, so state does not grow with a long session
        else:
            self.cells.clear()
        yield from _frame([(f, l + self.gap_us, n, t) for f, l, n, t in closed], ["start_us", "end_us", "n", "total"])

    def close(self) -> None:
        pass
