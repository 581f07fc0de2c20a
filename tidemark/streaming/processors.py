"""Keyed state and timers on streams, for what streaming aggregations and joins cannot express.

Every function takes a streaming DataFrame with a key column, ``seq`` (arrival order), ``ts`` (epoch
milliseconds) and, where timers are involved, a watermarked timestamp ``et``; it returns a streaming
DataFrame. Batch twins with the same results live in ``tidemark.operators``.

State is kept per key in RocksDB. Rows of one key and micro-batch are sorted before use, so the memory a
task needs is bounded by the micro-batch size, not by the history of a key.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark import durations
from tidemark.operators.changelog import INSERT, UPDATE_AFTER, UPDATE_BEFORE
from tidemark.operators.ordered import Run
from tidemark.operators.states import MAP_START


def _millis(duration: timedelta) -> int:
    return durations.micros(duration) // 1000


def _schema(df: DataFrame, key: str, *fields: tuple[str, str]) -> T.StructType:
    rest = T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in fields))
    return T.StructType([T.StructField(key, df.schema[key].dataType), *rest.fields])


def _run(
    df: DataFrame, keys: str | list[str], processor: Processor, schema: T.StructType, time_mode: str
) -> DataFrame:
    processor.row = Row(*schema.fieldNames())
    keys = [keys] if isinstance(keys, str) else keys
    return df.groupBy(*keys).transformWithState(processor, schema, "append", time_mode)


class Processor(StatefulProcessor):
    """A processor that builds its output with ``self.row(...)``, in schema order."""

    row: Row


class Arrivals(Processor):
    """Handles one row at a time, in arrival order."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for row in sorted(rows, key=lambda r: r.seq):
            yield from self.on_row(key, row, timerValues)

    def on_row(self, key, row, times) -> Iterable[Row]:
        raise NotImplementedError


class InOrder(Processor):
    """Holds rows back until the watermark passes them, then handles them in event-time order.

    ``on_event`` sees every row in order, ``on_time`` every due time. A timer set in ``on_event`` for a time
    the watermark has already passed comes after all rows that were waiting, so ``on_event`` must itself
    settle what was due before its row.
    """

    #: columns of a row that are kept while it waits
    columns: tuple[tuple[str, str], ...] = ()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        fields = ", ".join(f"{name} {kind}" for name, kind in (("seq", "bigint"), *self.columns))
        # the rows of one instant are numbered; `instants` holds how many there are
        self.instants = handle.getMapState("instants", "ts bigint", "n bigint")
        self.waiting = handle.getMapState("waiting", "ts bigint, number bigint", fields)
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for row in rows:
            instant = (row.ts,)
            n = self.instants.getValue(instant)[0] if self.instants.containsKey(instant) else 0
            self.waiting.updateValue((row.ts, n), (row.seq, *[row[name] for name, _ in self.columns]))
            self.instants.updateValue(instant, (n + 1,))
            if n == 0:
                self.handle.registerTimer(row.ts)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        if self.instants.containsKey((now,)):
            slots = [(now, number) for number in range(self.instants.getValue((now,))[0])]
            events = sorted(tuple(self.waiting.getValue(slot)) for slot in slots)
            for slot in slots:
                self.waiting.removeKey(slot)
            self.instants.removeKey((now,))
            for event in events:
                yield from self.on_event(key, now, *event)
        yield from self.on_time(key, now)

    def on_event(self, key, ts, seq, *values) -> Iterable[Row]:
        return ()

    def on_time(self, key, now) -> Iterable[Row]:
        return ()


# --- counts and values in arrival order --------------------------------------------------------------


class _CountChangelog(Arrivals):
    def init(self, handle):
        self.count = handle.getValueState("count", "n bigint")

    def on_row(self, key, row, times):
        n = self.count.get()[0] if self.count.exists() else 0
        self.count.update((n + 1,))
        if n == 0:
            return [self.row(*key, row.seq, 0, INSERT, 1)]
        return [self.row(*key, row.seq, 0, UPDATE_BEFORE, n), self.row(*key, row.seq, 1, UPDATE_AFTER, n + 1)]


def count_changelog(df: DataFrame, key: str) -> DataFrame:
    """Insert / retract rows of a grouped count."""
    schema = _schema(df, key, ("seq", "long"), ("part", "int"), ("op", "string"), ("cnt", "long"))
    return _run(df, key, _CountChangelog(), schema, "None")


class _CountWindow(Arrivals):
    def __init__(self, every: int):
        self.every = every

    def init(self, handle):
        self.group = handle.getValueState("group", "number bigint, n bigint, total bigint")

    def on_row(self, key, row, times):
        number, n, total = self.group.get() if self.group.exists() else (0, 0, 0)
        n, total = n + 1, total + row.ts
        if n < self.every:
            self.group.update((number, n, total))
            return []
        self.group.update((number + 1, 0, 0))
        return [self.row(*key, number, total // n)]


def count_window_average(df: DataFrame, key: str, every: int = 5) -> DataFrame:
    """Average time of each full run of ``every`` rows; state restarts after each."""
    return _run(df, key, _CountWindow(every), _schema(df, key, ("group_no", "long"), ("avg_ts", "long")), "None")


class _StateTour(Arrivals):
    def init(self, handle):
        self.value = handle.getValueState("value", "url string")
        self.list = handle.getListState("list", "url string")
        self.size = handle.getValueState("size", "n bigint")
        self.map = handle.getMapState("map", "name string", "n bigint")
        self.reducing = handle.getValueState("reducing", "url string, ts bigint")
        self.aggregating = handle.getValueState("aggregating", "n bigint")

    def on_row(self, key, row, times):
        previous = self.value.get()[0] if self.value.exists() else None
        self.value.update((row.url,))
        self.list.appendValue((row.url,))
        size = (self.size.get()[0] if self.size.exists() else 0) + 1
        self.size.update((size,))
        name = (str(key[0]),)
        counter = self.map.getValue(name)[0] + 1 if self.map.containsKey(name) else MAP_START
        self.map.updateValue(name, (counter,))
        first = self.reducing.get()[0] if self.reducing.exists() else row.url
        self.reducing.update((first, row.ts))
        n = (self.aggregating.get()[0] if self.aggregating.exists() else 0) + 1
        self.aggregating.update((n,))
        return [self.row(*key, row.seq, previous, size, counter, first, row.ts, f"count: {n}")]


def keyed_state_tour(df: DataFrame, key: str) -> DataFrame:
    """Value, list, map, reducing and aggregating state side by side. Needs a ``url`` column."""
    fields = (
        ("seq", "long"),
        ("value_url", "string"),
        ("list_size", "long"),
        ("map_value", "long"),
        ("reduced_url", "string"),
        ("reduced_ts", "long"),
        ("aggregate", "string"),
    )
    return _run(df, key, _StateTour(), _schema(df, key, *fields), "None")


class _ExpiringCount(Arrivals):
    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle):
        self.count = handle.getValueState("count", "n bigint", ttlDurationMs=self.ttl_ms)

    def on_row(self, key, row, times):
        n = (self.count.get()[0] if self.count.exists() else 0) + 1
        self.count.update((n,))
        return [self.row(*key, row.seq, n)]


def expiring_count(df: DataFrame, key: str, ttl: timedelta = timedelta(hours=1)) -> DataFrame:
    """Running count whose state expires ``ttl`` after its last write.

    Expiry follows the processing-time clock; such a query must be stopped explicitly.
    """
    return _run(df, key, _ExpiringCount(_millis(ttl)), _schema(df, key, ("seq", "long"), ("cnt", "long")), "ProcessingTime")


class _PreviousAction(Arrivals):
    def init(self, handle):
        self.previous = handle.getValueState("previous", "action string")

    def on_row(self, key, row, times):
        before = self.previous.get()[0] if self.previous.exists() else None
        self.previous.update((row.action,))
        return [] if before is None else [self.row(*key, row.seq, before, row.action)]


def action_pairs(df: DataFrame, key: str) -> DataFrame:
    """Each action next to the user's previous one. Needs an ``action`` column."""
    schema = _schema(df, key, ("seq", "long"), ("action1", "string"), ("action2", "string"))
    return _run(df, key, _PreviousAction(), schema, "None")


class _WatermarkProbe(Arrivals):
    def on_row(self, key, row, times):
        return [self.row(*key, row.seq, row.ts, times.getCurrentWatermarkInMs())]

    def init(self, handle):
        pass


def annotate_watermark(df: DataFrame, key: str) -> DataFrame:
    """Each row with the watermark its micro-batch started with."""
    schema = _schema(df, key, ("seq", "long"), ("ts", "long"), ("watermark_ms", "long"))
    return _run(df, key, _WatermarkProbe(), schema, "EventTime")


# --- timers ------------------------------------------------------------------------------------------


class _Timers(Arrivals):
    def __init__(self, delay_ms: int, event_time: bool):
        self.delay_ms, self.event_time = delay_ms, event_time

    def init(self, handle):
        self.handle = handle

    def on_row(self, key, row, times):
        base = row.ts if self.event_time else times.getCurrentProcessingTimeInMs()
        self.handle.registerTimer(base + self.delay_ms)
        return [self.row(*key, base, "arrival")]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield self.row(*key, expiredTimerInfo.getExpiryTimeInMs(), "fire")


def timers(df: DataFrame, key: str, delay: timedelta = timedelta(seconds=10), event_time: bool = True) -> DataFrame:
    """Arrivals, and one fire per key and due time ``delay`` later (event or processing time)."""
    processor = _Timers(_millis(delay), event_time)
    schema = _schema(df, key, ("at", "long"), ("kind", "string"))
    return _run(df, key, processor, schema, "EventTime" if event_time else "ProcessingTime")


class _PeriodicCount(InOrder):
    def __init__(self, period_ms: int):
        self.period_ms = period_ms

    def open(self, handle):
        self.count = handle.getValueState("count", "n bigint")
        self.due = handle.getValueState("due", "ts bigint")

    def on_event(self, key, ts, seq):
        reports = self.on_time(key, ts - 1)
        self.count.update(((self.count.get()[0] if self.count.exists() else 0) + 1,))
        if not self.due.exists():
            self.due.update((ts + self.period_ms,))
            self.handle.registerTimer(ts + self.period_ms)
        return reports

    def on_time(self, key, now):
        if self.due.exists() and self.due.get()[0] <= now:
            due = self.due.get()[0]
            self.due.clear()
            return [self.row(*key, due, self.count.get()[0])]
        return []


def periodic_count(df: DataFrame, key: str, period: timedelta = timedelta(seconds=10)) -> DataFrame:
    """Rows so far per key, ``period`` after an anchor row; the next row after a report anchors anew."""
    schema = _schema(df, key, ("fire_ts", "long"), ("cnt", "long"))
    return _run(df, key, _PeriodicCount(_millis(period)), schema, "EventTime")


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


#: What a frame's values (NULLs left out) are reduced to; ``count`` is 0 without any, the others NULL.
_OVER = {"count": len, "sum": sum, "max": max, "min": min, "avg": lambda values: sum(values) / len(values)}


class _LastOf(InOrder):
    def __init__(self, preceding: int, columns: list[tuple[str, str]], aggregates: list[tuple[str, int]]):
        self.preceding, self.aggregates, self.columns = preceding, aggregates, tuple(columns)

    def open(self, handle):
        self.recent = handle.getListState("recent", ", ".join(f"{name} {kind}" for name, kind in self.columns))

    def on_event(self, key, ts, seq, *values):
        frame = [*(tuple(r) for r in self.recent.get()), values] if self.recent.exists() else [values]
        if self.preceding:
            self.recent.put(frame[-self.preceding :])
        out = []
        for kind, place in self.aggregates:
            known = [row[place] for row in frame if row[place] is not None]
            out.append(_OVER[kind](known) if known or kind == "count" else None)
        return [self.row(*key, seq, *out)]


def over_last(df: DataFrame, key: str, aggregates: dict[str, tuple[str, str]], preceding: int = 3) -> DataFrame:
    """Aggregates of any columns over the current and the ``preceding`` rows of a key, in time order.

    ``aggregates`` are ``name=(count | sum | max | min | avg, column)``. The ring of the last rows is typed by ``df``. Batch
    twin: windows of ``operators.over`` over the same rows.
    """
    columns = list(dict.fromkeys(column for _, column in aggregates.values()))
    types = {"count": lambda c: "bigint", "avg": lambda c: "double", "sum": lambda c: _sum_kind(_kind(df, c))}
    fields = [(name, types.get(kind, lambda c: _kind(df, c))(column)) for name, (kind, column) in aggregates.items()]
    held = [(f"v{i}", _kind(df, c)) for i, c in enumerate(columns)]
    named = df.withColumns({f"v{i}": F.col(c) for i, c in enumerate(columns)})
    processor = _LastOf(preceding, held, [(kind, columns.index(column)) for kind, column in aggregates.values()])
    return _run(named, key, processor, _schema(df, key, ("seq", "long"), *fields), "EventTime")


def _sum_kind(kind: str) -> str:
    return "bigint" if kind in ("tinyint", "smallint", "int", "bigint") else "double" if kind in ("float", "double") else kind


class _Reduce(Arrivals):
    def __init__(self, kinds: list[str], fields: str):
        self.kinds, self.fields = kinds, fields

    def init(self, handle):
        self.state = handle.getValueState("reduced", self.fields)

    def on_row(self, key, row, times):
        state = tuple(self.state.get()) if self.state.exists() else None
        out = []
        for i, kind in enumerate(self.kinds):
            new, old = row[f"v{i}"], None if state is None else state[i]
            if kind == "count":
                out.append((old or 0) + 1)
            elif kind == "last" or (kind == "first" and state is None):
                out.append(new)
            elif kind == "first" or new is None:
                out.append(old)
            elif old is None:
                out.append(new)
            else:
                out.append(old + new if kind == "sum" else max(old, new) if kind == "max" else min(old, new))
        self.state.update(tuple(out))
        return [self.row(*key, row.seq, *out)]


def running_reduce(df: DataFrame, key: str, values: dict[str, Run]) -> DataFrame:
    """After each row, its key's rows so far reduced by an associative function per output column.

    ``values`` name them as :class:`Run`, as for ``operators.keyed.running_reduce``; the state is typed by their columns.
    """
    columns = {f"v{i}": F.lit(1).cast("long") if run.kind == "count" else run.value for i, run in enumerate(values.values())}
    lifted = df.select("*", *[c.alias(n) for n, c in columns.items()])
    kinds = [_kind(lifted, name) for name in columns]
    kinds = [_sum_kind(kind) if run.kind == "sum" else kind for run, kind in zip(values.values(), kinds, strict=True)]
    if any(not run.inclusive for run in values.values()):
        raise ValueError("a stream reduces the current row too")
    fields = ", ".join(f"s{i} {kind}" for i, kind in enumerate(kinds))
    schema = _schema(df, key, ("seq", "long"), *zip(values, kinds, strict=True))
    return _run(lifted, key, _Reduce([run.kind for run in values.values()], fields), schema, "None")


class _GapCount(InOrder):
    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def open(self, handle):
        self.count = handle.getValueState("count", "last bigint, n bigint")

    def on_event(self, key, ts, seq):
        last, n = self.count.get() if self.count.exists() else (None, 0)
        n = 1 if last is not None and ts >= last + self.ttl_ms else n + 1
        self.count.update((ts, n))
        self.handle.registerTimer(ts + self.ttl_ms)
        return [self.row(*key, seq, n)]

    def on_time(self, key, now):
        if self.count.exists() and self.count.get()[0] + self.ttl_ms <= now:
            self.count.clear()
        return ()


def expiring_count_by_event_time(df: DataFrame, key: str, ttl: timedelta = timedelta(hours=1)) -> DataFrame:
    """Running count whose state is gone ``ttl`` of event time after its last write; batch twin ``states.expiring_count``."""
    return _run(df, key, _GapCount(_millis(ttl)), _schema(df, key, ("seq", "long"), ("cnt", "long")), "EventTime")


class _LastRows(InOrder):
    def __init__(self, preceding: int):
        self.preceding = preceding

    def open(self, handle):
        self.recent = handle.getListState("recent", "ts bigint")

    def on_event(self, key, ts, seq):
        window = [r[0] for r in self.recent.get()] + [ts] if self.recent.exists() else [ts]
        self.recent.put([(t,) for t in window[-self.preceding :]])
        return [self.row(*key, seq, sum(window) / len(window), len(window), max(window))]


def last_rows(df: DataFrame, key: str, preceding: int = 3) -> DataFrame:
    """Average, count and maximum of ``ts`` over the current and the ``preceding`` rows, in time order."""
    schema = _schema(df, key, ("seq", "long"), ("avg_ts", "double"), ("cnt", "long"), ("max_ts", "long"))
    return _run(df, key, _LastRows(preceding), schema, "EventTime")


# --- patterns and two-stream state -------------------------------------------------------------------


class _Consecutive(InOrder):
    columns = (("hit", "boolean"),)

    def __init__(self, times: int):
        self.times = times

    def open(self, handle):
        self.hits = handle.getListState("hits", "ts bigint")

    def on_event(self, key, ts, seq, hit):
        if not hit:
            self.hits.clear()
            return ()
        found = [r[0] for r in self.hits.get()] + [ts] if self.hits.exists() else [ts]
        self.hits.put([(t,) for t in found[-(self.times - 1) :]])
        return [self.row(*key, *found)] if len(found) == self.times else ()


def consecutive(df: DataFrame, key: str, condition, times: int = 3) -> DataFrame:
    """``times`` directly consecutive rows that meet ``condition``; at least two."""
    if times < 2:
        raise ValueError("a run needs at least two rows")
    marked = df.withColumn("hit", F.coalesce(condition, F.lit(False)))
    schema = _schema(df, key, *[(f"ts_{i}", "long") for i in range(1, times + 1)])
    return _run(marked, key, _Consecutive(times), schema, "EventTime")


class _Steps(InOrder):
    def __init__(self, times: int, within_ms: int | None):
        self.times, self.within_ms = times, within_ms
        self.columns = tuple((f"met_{i}", "boolean") for i in range(times))

    def open(self, handle):
        self.partial = handle.getListState("partial", ", ".join(f"ts_{i} bigint" for i in range(1, self.times)))

    def on_event(self, key, ts, seq, *met):
        partial = [[t for t in row if t is not None] for row in self.partial.get()] if self.partial.exists() else []
        going, found = [], []
        for begun in [*partial, []]:
            in_time = not begun or self.within_ms is None or ts - begun[0] < self.within_ms
            if met[len(begun)] and in_time:
                whole = [*begun, ts]
                (found if len(whole) == self.times else going).append(whole)
        if going:
            self.partial.put([(*begun, *[None] * (self.times - 1 - len(begun))) for begun in going])
        elif partial:
            self.partial.clear()
        return [self.row(*key, *whole) for whole in found]


def steps(df: DataFrame, key: str, conditions, within: timedelta | None = None) -> DataFrame:
    """Directly consecutive rows that meet ``conditions`` one after another, the last strictly within the limit.

    The state is an automaton's: at most one partial match for each number of steps done, as every row either carries a
    match on or ends it. At least two conditions. Batch twin ``operators.patterns.steps``.
    """
    if len(conditions) < 2:
        raise ValueError("a pattern needs at least two steps")
    marked = df.withColumns({f"met_{i}": F.coalesce(c, F.lit(False)) for i, c in enumerate(conditions)})
    times = len(conditions)
    schema = _schema(df, key, *[(f"ts_{i}", "long") for i in range(1, times + 1)])
    return _run(marked, key, _Steps(times, None if within is None else _millis(within)), schema, "EventTime")


class _FollowedBy(InOrder):
    columns = (("step", "int"),)

    def __init__(self, within_ms: int):
        self.within_ms = within_ms

    def open(self, handle):
        self.started = handle.getListState("started", "ts bigint")

    def on_event(self, key, ts, seq, step):
        open_ = [r[0] for r in self.started.get()] if self.started.exists() else []
        if step == 1:
            self.started.appendValue((ts,))
            self.handle.registerTimer(ts + self.within_ms)
            return ()
        self.started.clear()
        in_time = [first for first in open_ if ts - first < self.within_ms]
        # a start that is due right now has missed the limit, which is strict
        missed = [first for first in open_ if ts - first >= self.within_ms]
        return [self.row(*key, first, ts, "paid") for first in in_time] + [self.row(*key, first, None, "timeout") for first in missed]

    def on_time(self, key, now):
        if not self.started.exists():
            return ()
        open_ = [r[0] for r in self.started.get()]
        due = [first for first in open_ if first + self.within_ms <= now]
        if due:
            left = [(first,) for first in open_ if first + self.within_ms > now]
            self.started.put(left) if left else self.started.clear()
        return [self.row(*key, first, None, "timeout") for first in due]


def followed_by(df: DataFrame, key: str, first, second, within: timedelta = timedelta(minutes=15)) -> DataFrame:
    """``first`` then (with anything in between) ``second`` within the limit, or a timeout row."""
    steps = df.where(first | second).withColumn("step", F.when(first, 1).otherwise(2))
    schema = _schema(df, key, ("first_ts", "long"), ("second_ts", "long"), ("status", "string"))
    return _run(steps, key, _FollowedBy(_millis(within)), schema, "EventTime")


class _Reconcile(InOrder):
    columns = (("side", "string"),)

    def __init__(self, wait_ms: int):
        self.wait_ms = wait_ms

    def open(self, handle):
        self.apps = handle.getMapState("apps", "seq bigint", "ts bigint, matched boolean")

    def on_event(self, key, ts, seq, side):
        if side == "app":
            self.apps.updateValue((seq,), (ts, False))
            self.handle.registerTimer(ts + self.wait_ms)
            return ()
        partners = [(s[0], v[0]) for s, v in self.apps.iterator() if v[0] >= ts - self.wait_ms]
        for app_seq, app_ts in partners:
            self.apps.updateValue((app_seq,), (app_ts, True))
        if not partners:
            return [self.row(*key, None, ts, "app_missing")]
        return [self.row(*key, app_ts, ts, "success") for _, app_ts in partners]

    def on_time(self, key, now):
        done = [(s, v) for s, v in self.apps.iterator() if v[0] + self.wait_ms <= now]
        for slot, _ in done:
            self.apps.removeKey(slot)
        return [self.row(*key, v[0], None, "platform_missing") for _, v in done if not v[1]]


def reconcile(df: DataFrame, key: str, wait: timedelta = timedelta(seconds=5)) -> DataFrame:
    """Match ``side = 'app'`` rows with later ``'platform'`` rows of the key; report what is missing.

    The two streams come as one, tagged by ``side``; at equal times app rows must have the smaller ``seq``.
    """
    schema = _schema(df, key, ("app_ts", "long"), ("platform_ts", "long"), ("status", "string"))
    return _run(df, key, _Reconcile(_millis(wait)), schema, "EventTime")


class _CoGroup(Processor):
    def __init__(self, size_ms: int):
        self.size_ms = size_ms

    def init(self, handle):
        self.handle = handle
        self.members = {side: handle.getListState(side, "value bigint") for side in ("left", "right")}

    def handleInputRows(self, key, rows, timerValues):
        for row in sorted(rows, key=lambda r: r.seq):
            self.members[row.side].appendValue((row.value,))
        self.handle.registerTimer(key[1] + self.size_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        for side, state in self.members.items():
            if state.exists():
                for position, (value,) in enumerate(state.get()):
                    yield self.row(key[0], key[1], key[1] + self.size_ms, side, position, value)
                state.clear()


def window_cogroup(df: DataFrame, key: str, size: timedelta = timedelta(seconds=5)) -> DataFrame:
    """Both sides' ``value`` per key and window, a row per member in arrival order.

    The two streams come as one, with ``side`` left or right.
    """
    size_ms = _millis(size)
    started = df.withColumn("window_start", F.col("ts") - F.pmod("ts", F.lit(size_ms)))
    members = (("side", "string"), ("position", "long"), ("value", "long"))
    schema = _schema(df, key, ("window_start", "long"), ("window_end", "long"), *members)
    return _run(started, [key, "window_start"], _CoGroup(size_ms), schema, "EventTime")
