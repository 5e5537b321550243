"""Stateful processors: the per-key rules that built-in streaming operators cannot express.

Each is one small state machine over the rows of a key, run by ``transformWithState`` on the
RocksDB store. Rows are consumed as they come; what is held back per key is bounded by days or
by the look-ahead, never by the number of rows, except for a device's very first micro-batch.
Python state is kept where the earliest row of a micro-batch must win: the built-in duplicate operators take any.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, timedelta

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SETTLE_MS = 2_000   # fixed value: a detail is emitted this long after its first version
DAY_MS = 86_400_000
NOBODY = "\u0000"


class FirstDay(StatefulProcessor):
    """Adds ``first_day``, the day a device counts as first seen, to each of its logs.

    Input: ``ts, offset, day, day_before, is_new, log, dirty_text``. Output: ``log, dirty_text, day, first_day``.
    Keys that begin with ``NOBODY`` are no device: their rows pass as they are.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._first = handle.getValueState("first_day", "day string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if key[0].startswith(NOBODY):
            for r in rows:
                yield Row(log=r.log, dirty_text=r.dirty_text, day=r.day, first_day=None)
            return
        if not self._first.exists():
            rows = list(rows)  # the earliest log of a new device decides for all of them
            first = min(rows, key=lambda r: (r.ts, r.offset))
            self._first.update((first.day if first.is_new == "1" else first.day_before,))
        (first_day,) = self._first.get()
        for r in rows:
            yield Row(log=r.log, dirty_text=r.dirty_text, day=r.day, first_day=first_day)

    def close(self) -> None:
        pass


class DayFirst(StatefulProcessor):
    """The first row of each key and day, with the key's previous active day.

    Input: ``time, offset, day, carry``. Output: ``key, day, time, prev_day, is_first, carry``. A day that
    comes after a later one counts as well, within ``late_days`` of the latest; its previous day is the latest
    before it that was seen. With ``forget_ms`` a key is forgotten that long (in event time)
    after its last first row; such jobs do not use ``prev_day``.
    """

    def __init__(self, forget_ms: int | None = None, late_days: int = 30):
        self._forget, self._late_days = forget_ms, late_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("days", "days string, until long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        firsts = {}
        for r in rows:
            held = firsts.get(r.day)
            if held is None or (r.time, r.offset) < (held.time, held.offset):
                firsts[r.day] = r
        seen = self._last.get()[0].split(",") if self._last.exists() else []
        for day in sorted(firsts):
            if day in seen or seen and date.fromisoformat(day) < _days_before(seen[-1], self._late_days):
                continue
            r = firsts[day]
            prev = max((d for d in seen if d < day), default=None)
            yield Row(key=key[0], day=day, time=r.time, prev_day=prev, is_first=1, carry=r.carry)
            until = 0
            if self._forget:
                until = r.ts + self._forget
                self._handle.registerTimer(until)
            seen = sorted([*seen, day])
            oldest = _days_before(seen[-1], self._late_days)
            # The latest of the older days stays, as the previous day of one that comes late.
            older = [d for d in seen if date.fromisoformat(d) < oldest]
            seen = older[-1:] + seen[len(older):]
            self._last.update((",".join(seen), max(until, self._last.get()[1] if self._last.exists() else 0)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self._last.exists() and self._last.get()[1] <= expiredTimerInfo.getExpiryTimeInMs():
            self._last.clear()
        return iter(())

    def close(self) -> None:
        pass


def _days_before(day: str, n: int) -> date:
    return date.fromisoformat(day) - timedelta(days=n)


class Jump(StatefulProcessor):
    """Session starts not followed by a page of the same session within the limit.

    The key is a device and a slice of time. Input: ``ts, offset, is_start, own, value``; rows that are not ``own`` belong
    to the next slice and are only looked at. Output: ``value, ts``. A start is judged once the
    watermark has passed the end of its limit; until then the rows around it are kept.
    """

    def __init__(self, within_ms: int):
        self._within = within_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._rows = handle.getListState("rows", "ts long, offset long, is_start boolean, own boolean, value string")
        self._judged = handle.getValueState("judged", "until long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        due = set()
        for r in rows:
            self._rows.appendValue((r.ts, r.offset, r.is_start, r.own, r.value if r.is_start and r.own else None))
            due.add(r.ts + self._within)  # rows that are no start are let go in time, too
        for at in due:
            self._handle.registerTimer(at)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """The first timer of a micro-batch judges all starts that are due; the others find nothing to do."""
        at = expiredTimerInfo.getExpiryTimeInMs()
        if self._judged.exists() and at <= self._judged.get()[0]:
            return
        until = max(at, timerValues.getCurrentWatermarkInMs())
        self._judged.update((until,))
        held = sorted((tuple(r) for r in self._rows.get()), key=lambda r: r[:2])
        for (ts, _, is_start, own, value), nxt in zip(held, [*held[1:], None]):
            if is_start and own and ts + self._within <= until and (
                nxt is None or nxt[0] - ts >= self._within or nxt[2]
            ):
                yield Row(value=value, ts=ts)
        keep = [r for r in held if r[0] + self._within > until]
        if keep:
            self._rows.put(keep)
        else:
            self._rows.clear()

    def close(self) -> None:
        pass


class FirstOfBurst(StatefulProcessor):
    """The first row of a key, and each that comes more than ``gap_ms`` after the copy before it.

    Input: ``time, ts, carry``. Output: ``time, carry``. Every copy renews the time to wait. A key is forgotten
    when the watermark has passed that time.
    """

    def __init__(self, gap_ms: int):
        self._gap = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", "ts long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self._last.get()[0] if self._last.exists() else None
        before = last
        for r in sorted(rows, key=lambda r: r.ts):
            if last is None or r.ts - last > self._gap:
                yield Row(time=r.time, carry=r.carry)
            last = r.ts if last is None else max(last, r.ts)
        if last != before:
            self._last.update((last,))
            self._handle.registerTimer(last + self._gap + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self._last.exists() and self._last.get()[0] + self._gap < expiredTimerInfo.getExpiryTimeInMs():
            self._last.clear()
        return iter(())

    def close(self) -> None:
        pass


class KeepLast(StatefulProcessor):
    """The version with the greatest time per key, emitted once after a settling period.

    Input: ``ts, tie, value``. Output: ``value``. The key stays known for ``remember_ms`` so that a
    later copy is not emitted again.
    """

    def __init__(self, settle_ms: int = SETTLE_MS, remember_ms: int | None = 3 * DAY_MS):
        self._settle, self._remember = settle_ms, remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._best = handle.getValueState("best", "ts long, tie string, value string", self._remember)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self._best.exists()
        best = self._best.get() if known else None
        if not known:
            now = timerValues.getCurrentProcessingTimeInMs()
            self._handle.registerTimer(now + self._settle)
        changed = False
        for r in rows:
            if best is None or (r.ts, r.tie) >= (best[0], best[1]):
                best, changed = (r.ts, r.tie, r.value), True
        if changed:
            self._best.update(best)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self._best.exists():
            yield Row(value=self._best.get()[2])

    def close(self) -> None:
        pass
