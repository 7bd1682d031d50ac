"""Per-key logic of the stateful operators.

A processor sees the rows of one key that arrived in one micro-batch, in no
particular order, and applies its rule in event order.  Rows come with
``_place``, the values they are ordered by, and ``_row``, the row itself as
JSON text that no processor looks into.  Where the rule allows it the rows are
read once and only one row per calendar day is held, so a key with very many
rows does not fill the worker's memory.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import date

import pandas as pd
from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

DAY_MS = 24 * 60 * 60 * 1000

PLAIN = Row("_row")
MARKED = Row("_row", "unique_user", "new_user")
RETURNED = Row("_row", "uu", "back")
JUDGED = Row("_row", "_keep")


def _rank(place: str) -> tuple:
    """JSON array of order values to something that sorts, NULLs first."""
    return tuple((value is not None, value) for value in json.loads(place))


def _held(state) -> dict:
    """What a bucket holds of each of its keys."""
    value = state.get()
    return json.loads(value[0]) if value is not None else {}


class _Keyed(StatefulProcessor):
    def close(self) -> None:
        pass


class _Daily(_Keyed):
    """Keeps the last day seen; ``_day`` is ISO text, so days compare as text."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "day STRING", self.ttl_ms)

    def _last_day(self) -> str | None:
        return self.last.get()[0] if self.last.exists() else None


def _earliest_per_day(rows: Iterator[Row]) -> tuple[dict[str, Row], Iterator[Row]]:
    """First row of each day, filled while the returned iterator over all others is read."""
    first: dict[str, tuple] = {}
    found: dict[str, Row] = {}

    def others() -> Iterator[Row]:
        for row in rows:
            day, rank = row["_day"], _rank(row["_place"])
            if day not in found:
                found[day], first[day] = row, rank
            elif rank < first[day]:
                row, found[day], first[day] = found[day], row, rank
                yield row
            else:
                yield row

    return found, others()


class FirstOfDay(_Daily):
    """Passes a row when its day differs from the last one passed."""

    def __init__(self, ttl_ms: int | None = DAY_MS):
        super().__init__(ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        found, others = _earliest_per_day(rows)
        for _ in others:
            pass
        last = self._last_day()
        for day in sorted(found):
            if day != last:
                last = day
                yield PLAIN(found[day]["_row"])
        if last is not None:
            self._remember(last)

    def _remember(self, day: str) -> None:
        # written only when it changes: the time to live counts from the last pass
        if day != self._last_day():
            self.last.update((day,))


class MarkUnique(_Daily):
    """Marks the first row of a new day as a unique user, the first row ever as a new one."""

    def __init__(self, only_unique: bool):
        super().__init__()
        self.only_unique = only_unique

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        found, others = _earliest_per_day(rows)
        for row in others:
            if not self.only_unique:
                yield MARKED(row["_row"], 0, 0)
        last = self._last_day()
        for day in sorted(found):
            if day != last:
                yield MARKED(found[day]["_row"], 1, int(last is None))
                last = day
            elif not self.only_unique:
                yield MARKED(found[day]["_row"], 0, 0)
        self.last.update((last,))


class ReturningUsers(_Daily):
    """One row per new login day, marked when the user was away long enough."""

    def __init__(self, gap_days: int):
        super().__init__()
        self.gap_days = gap_days

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        found, others = _earliest_per_day(rows)
        for _ in others:
            pass
        last = self._last_day()
        for day in sorted(found):
            if day == last:
                continue
            away = (date.fromisoformat(day) - date.fromisoformat(last)).days if last else 0
            yield RETURNED(found[day]["_row"], 1, int(away >= self.gap_days))
            last = day
        self.last.update((last,))


class RepairIsNew(_Daily):
    """Tells on which rows the new-visitor mark may stay: those of the device's first day.

    Rows arrive with ``_claims`` (marked new) and ``_before`` (the day before
    their own).  Of a device without state only the marked rows of the earliest
    day so far are held, until its first row of the batch is known; marks of
    later days cannot stay and are settled at once.
    """

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        settled = self._last_day()
        first, rank, waiting = None, None, []
        for row in rows:
            if settled is not None or not row["_claims"]:
                yield JUDGED(row["_row"], bool(row["_claims"] and row["_day"] == settled))
            elif not waiting or row["_day"] == waiting[0]["_day"]:
                waiting.append(row)
            elif row["_day"] > waiting[0]["_day"]:
                yield JUDGED(row["_row"], False)
            else:
                yield from (JUDGED(held["_row"], False) for held in waiting)
                waiting = [row]
            if settled is None:
                own = _rank(row["_place"])
                if first is None or own < rank:
                    first, rank = row, own
        if settled is None and first is not None:
            settled = first["_day"] if first["_claims"] else first["_before"]
            self.last.update((settled,))
            for row in waiting:
                yield JUDGED(row["_row"], row["_day"] == settled)


class FirstWins(_Keyed):
    """Passes the first row of each key (``_id``) of a bucket; every later one prolongs the memory of it.

    A bucket's memory is read and written once a batch: until when each of its
    keys is known.  It is gone when the last of them is.  Rows come and go in
    frames of many.
    """

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "keys STRING", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        known = {name: until for name, until in _held(self.seen).items() if until > now}
        first: dict[str, tuple] = {}
        arrived: set[str] = set()
        for frame in rows:
            # names with an underscore in front do not reach a frame, their order does
            _, places, texts, names = (frame[column] for column in frame.columns)
            arrived.update(names)
            for name, place, text in zip(names, places, texts):
                if name not in known and (name not in first or _rank(place) < _rank(first[name][0])):
                    first[name] = place, text
        known.update(dict.fromkeys(arrived, now + self.ttl_ms))
        self.seen.update((json.dumps(known, ensure_ascii=False),))
        if first:
            yield pd.DataFrame({"_row": [text for _, text in first.values()]})


class LatestWins(_Keyed):
    """Holds the greatest row of each key (``_id``) of a bucket and passes it ``wait_ms`` after the first one came.

    Keys of a bucket that came in one batch share a timer.
    """

    def __init__(self, wait_ms: int):
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", "keys STRING")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        due = timerValues.getCurrentProcessingTimeInMs() + self.wait_ms
        held = _held(self.best)
        ranks: dict[str, tuple] = {}
        before = len(held)
        for row in rows:
            name, place = row["_id"], row["_place"]
            own, best = _rank(place), held.get(name)
            if best is not None and name not in ranks:
                ranks[name] = _rank(best[1])
            if best is None or own >= ranks[name]:
                held[name], ranks[name] = [best[0] if best else due, place, row["_row"]], own
        if len(held) > before:
            self.handle.registerTimer(due)
        self.best.update((json.dumps(held, ensure_ascii=False),))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        held = _held(self.best)
        waiting = {name: best for name, best in held.items() if best[0] > now}
        if waiting:
            self.best.update((json.dumps(waiting, ensure_ascii=False),))
        else:
            self.best.clear()
        for due, _, text in held.values():
            if due <= now:
                yield PLAIN(text)


class FollowedBy(_Keyed):
    """Judges start events by the next event of their key (``_id``), in event-time order, for a bucket of keys.

    Rows wait until the watermark has passed them, because only then is their
    order final; rows of one millisecond wait together.  ``_row`` is NULL for
    rows that are no start events.  The open start event is kept until the next
    row or until its time is up.

    A bucket's memory is read and written once a batch: the open start event
    and the waiting rows of each of its keys.  It has one timer, for the time
    at which something is due next; all that the watermark has passed by then
    is judged at once.  A start event that a timer has opened is timed out by a
    later batch.
    """

    def __init__(self, limit_ms: int):
        self.limit_ms = limit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "due BIGINT, keys STRING")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        due, keys = self._read()
        for row in rows:
            _, waiting = keys.setdefault(row["_id"], (None, []))
            waiting.append([row["_at"], row["_place"], row["_follows"], row["_row"]])
        settled, coming = self._judge(keys, timerValues.getCurrentWatermarkInMs())
        if coming != due:
            if due is not None:
                self.handle.deleteTimer(due)
            if coming is not None:
                self.handle.registerTimer(coming)
        return (PLAIN(text) for text in settled)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        due, keys = self._read()
        if due != expiredTimerInfo.getExpiryTimeInMs():
            return iter(())
        settled, coming = self._judge(keys, timerValues.getCurrentWatermarkInMs())
        if coming is not None:
            self.handle.registerTimer(coming)
        return (PLAIN(text) for text in settled)

    def _read(self) -> tuple[int | None, dict]:
        value = self.held.get()
        return (value[0], json.loads(value[1])) if value is not None else (None, {})

    def _judge(self, keys: dict, mark: int) -> tuple[list[str], int | None]:
        """Start events settled by rows before ``mark``, and when something is due next; keeps all that is open."""
        settled: list[str] = []
        left: dict[str, tuple] = {}
        times: list[int] = []
        for name, (start, waiting) in keys.items():
            passed = [row for row in waiting if row[0] < mark]
            for at, _, follows, text in sorted(passed, key=lambda row: (row[0], _rank(row[1]))):
                if start is not None and (follows or at - start[0] >= self.limit_ms):
                    settled.append(start[1])
                start = (at, text) if text is not None else None
            if start is not None and not passed and start[0] + self.limit_ms < mark:
                settled.append(start[1])
                start = None
            later = [row for row in waiting if row[0] >= mark]
            if start is not None or later:
                left[name] = start, later
                times += [row[0] for row in later]
            if start is not None:
                times.append(start[0] + self.limit_ms)
        if left:
            coming = min(times)
            self.held.update((coming, json.dumps(left, ensure_ascii=False)))
            return settled, coming
        self.held.clear()
        return settled, None
