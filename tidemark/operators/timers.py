"""What timer-driven operators produce over a finished history: timer fires and periodic counts (batch)."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark import durations
from tidemark.operators.ordered import Run, hot_keys, max_rows_per_slice, running, same, written


def event_time_timers(df: DataFrame, key: str, ts: str, delay: timedelta = timedelta(seconds=10)) -> DataFrame:
    """Every arrival, and one fire per key and due time ``ts + delay``."""
    arrivals = df.select(key, F.col(ts).alias("at"), F.lit("arrival").alias("kind"))
    fires = df.select(key, (F.col(ts) + durations.literal(delay)).alias("at"), F.lit("fire").alias("kind")).distinct()
    return arrivals.unionByName(fires)


def periodic_count(df: DataFrame, key: str, ts: str = "timestamp", period: timedelta = timedelta(seconds=10)) -> DataFrame:
    """Rows per key so far, reported ``period`` after an anchor row. ``ts`` is in epoch milliseconds.

    The first anchor is the key's first row; the next one is the first row after a report. A report at
    ``fire_ts`` counts all rows with ``ts <= fire_ts``. Rows without a time start nothing and are in no count; rows with a
    NULL key are a group of their own.

    Every anchor depends on the report before it. What is looked at are *ticks*: rows counted per key and millisecond,
    with map-side combine and spread over all tasks. A key of at most ``spark.tidemark.maxRowsPerSlice`` ticks is walked
    by one task in time order (:func:`_walked`); of a key with more, all ticks find their successors at once, and which of
    them are anchors follows by doubling (:func:`_doubled`), so no task holds the key.
    """
    timed = df.where(F.col(ts).isNotNull())
    ticks = timed.groupBy(key, F.col(ts).alias("tick")).agg(F.count(F.lit(1)).alias("n"))
    width, limit = durations.micros(period) // 1000, max_rows_per_slice(df.sparkSession)
    if hot_keys(timed.select(key), [key], limit) is None:  # no more ticks than rows
        return _walked(ticks, key, width)
    ticks = written(ticks, "ticks")
    hot = hot_keys(ticks, [key], limit)
    if hot is None:
        return _walked(ticks, key, width)
    known = same([key], [f"_cut_{key}"])
    cold = _walked(ticks.join(hot, known, "left_anti"), key, width)
    return cold.unionByName(_doubled(ticks.join(hot, known, "left_semi"), key, width))


def _doubled(ticks: DataFrame, key: str, width: int) -> DataFrame:
    """Reports of keys that are too large for a task.

    A tick's report is due ``width`` after it; what it would count, and the first tick behind it (its successor), are
    running values over ticks and due times in one order, cut into slices. Anchors are what successors lead to from the
    first tick: after k rounds the first 2^k anchors are known and every tick points 2^k successors ahead, so the rounds
    are the logarithm of the longest chain, each a join on (key, tick) that spreads a key over all tasks.
    """
    points = ticks.select(key, F.col("tick").alias("at"), F.lit(0).alias("kind"), "tick", "n")
    due = ticks.select(key, (F.col("tick") + width).alias("at"), F.lit(1).alias("kind"), "tick", F.lit(None).cast("long").alias("n"))
    order = ["at", "kind"]  # a tick at the due time is counted
    merged = written(points.unionByName(due), "due-times")
    counted = running(merged, [key], order, {"cnt": Run("sum", F.col("n"))})
    ahead = Run("min", F.when(F.col("kind") == 0, F.col("at")))
    linked = running(counted, [key], order, {"next": ahead}, reverse=True, sizing=merged)
    links = written(linked.where(F.col("kind") == 1).select(key, "tick", F.col("at").alias("fire_ts"), "cnt", "next"), "successors")

    first = written(links.groupBy(key).agg(F.min("tick").alias("tick")), "anchors")
    anchors = [first]
    pointers = links.where(F.col("next").isNotNull()).select(F.col(key).alias("_key"), F.col("tick").alias("_tick"), "next")
    while True:
        known = reduce(DataFrame.unionByName, anchors)
        more = written(known.join(pointers, same([key, "tick"], ["_key", "_tick"])).select(key, F.col("next").alias("tick")), "anchors")
        if more.isEmpty():
            break
        anchors.append(more)
        behind = pointers.select(F.col("_key").alias("_k"), F.col("_tick").alias("_t"), F.col("next").alias("_n"))
        doubled = pointers.join(behind, same(["_key", "next"], ["_k", "_t"])).select("_key", "_tick", F.col("_n").alias("next"))
        pointers = written(doubled, "pointers")
    chosen = reduce(DataFrame.unionByName, anchors).select(F.col(key).alias("_key"), F.col("tick").alias("_tick"))
    return links.join(chosen, same([key, "tick"], ["_key", "_tick"]), "left_semi").select(key, "fire_ts", "cnt")


def _walked(ticks: DataFrame, key: str, width: int) -> DataFrame:
    """Reports of keys whose sorted ticks a task streams in Arrow batches, from anchor to anchor by binary search.

    It holds one pending report and one count.
    """
    schema = T.StructType([ticks.schema[key], T.StructField("fire_ts", T.LongType()), T.StructField("cnt", T.LongType())])

    def alike(one: object, other: object) -> bool:
        return one == other or (one != one and other != other)  # NaN is one key

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, started, total, due, kind = None, False, 0, None, None
        for batch in batches:
            kind = batch.schema.field(key).type
            coded = pc.dictionary_encode(batch.column(key), null_encoding="encode")
            codes, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
            at, counts = batch.column("tick").to_numpy(), batch.column("n").to_numpy()
            borders = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1), len(codes)] if len(codes) else [0]
            reports = []
            for low, high in zip(borders[:-1], borders[1:], strict=True):
                name = names[codes[low]]
                if not started or not alike(name, current):
                    if due is not None:
                        reports.append((current, due, total))
                    current, started, total, due = name, True, 0, None
                run, seen = at[low:high], np.cumsum(counts[low:high])
                position = 0
                while position < len(run):
                    if due is None:
                        due = int(run[position]) + width
                    position = int(np.searchsorted(run, due, side="right"))
                    if position < len(run):
                        reports.append((current, due, total + int(seen[position - 1] if position else 0)))
                        due = None
                total += int(seen[-1])
            if reports:
                yield told(reports, kind)
        if due is not None:
            yield told([(current, due, total)], kind)

    def told(reports: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        columns = zip(*reports, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (kind, pa.int64(), pa.int64()), strict=True)], schema.fieldNames())

    return ticks.repartition(key).sortWithinPartitions(key, "tick").mapInArrow(walk, schema)
