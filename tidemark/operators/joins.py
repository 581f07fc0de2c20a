"""Two-stream operators: window, interval, co-group and unbounded joins, reconciliation, union, split."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark import durations
from tidemark.operators.ordered import Run, position, floor_div, running


def window_join(
    left: DataFrame,
    right: DataFrame,
    key: tuple[str, str],
    ts: tuple[str, str],
    size: timedelta = timedelta(seconds=5),
) -> DataFrame:
    """Pairs with equal key in the same tumbling window. Column names of the two sides must differ."""

    def windowed(side: DataFrame, time: str, name: str) -> DataFrame:
        with_window = side.withColumn(name, F.window(time, durations.text(size)))
        # a stream may carry one watermarked column; from here on it is the window
        return with_window.withColumn(time, F.col(time) + durations.literal(timedelta(0))) if side.isStreaming else with_window

    lw, rw = windowed(left, ts[0], "_lw"), windowed(right, ts[1], "_rw")
    joined = lw.join(rw, (F.col(key[0]) == F.col(key[1])) & (F.col("_lw") == F.col("_rw")))
    return joined.select(
        F.col("_lw").start.alias("window_start"), F.col("_lw").end.alias("window_end"), *left.columns, *right.columns
    )


def _sided(left: DataFrame, right: DataFrame, columns: Sequence[str], ts: str, size: timedelta) -> DataFrame:
    tagged = left.select(*columns, F.lit("left").alias("side")).unionByName(right.select(*columns, F.lit("right").alias("side")))
    return tagged.withColumn("_w", F.window(ts, durations.text(size))).select(
        *columns, "side", F.col("_w").start.alias("window_start"), F.col("_w").end.alias("window_end")
    )


def window_cogroup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ts: str,
    order: Sequence[str],
    value: str,
    size: timedelta = timedelta(seconds=5),
) -> DataFrame:
    """Both sides' values per key and tumbling window: a row per member, ``side`` and ``position`` from 0 in ``order``.

    ``left`` and ``right`` share ``key``, ``ts``, ``order`` and ``value`` columns. Groups have this shape at every size;
    :func:`window_cogroup_counts` tells how many members each side has, also where a side is empty.
    """
    columns = list(dict.fromkeys([key, ts, *order, value]))
    group = [key, "window_start", "window_end", "side"]
    numbered = running(_sided(left, right, columns, ts, size), group, order, {"_row": Run("count")})
    return numbered.select(*group, (F.col("_row") - 1).alias("position"), F.col(value).alias("value"))


def window_cogroup_counts(left: DataFrame, right: DataFrame, key: str, ts: str, size: timedelta = timedelta(seconds=5)) -> DataFrame:
    """Members of both sides per key and tumbling window."""
    sides = {f"{side}_rows": F.count(F.when(F.col("side") == side, 1)) for side in ("left", "right")}
    grouped = _sided(left, right, [key, ts], ts, size).groupBy(key, "window_start", "window_end")
    return grouped.agg(*[count.alias(name) for name, count in sides.items()])


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: tuple[str, str],
    ts: tuple[str, str],
    lower: timedelta = timedelta(seconds=-5),
    upper: timedelta = timedelta(seconds=10),
    how: str = "inner",
) -> DataFrame:
    """Equal key and ``right.ts`` within ``[left.ts + lower, left.ts + upper]``, both ends included.

    ``how`` is inner, left or full. Column names of the two sides must differ. In batch the time range becomes
    an equality on buckets as wide as the interval: a right row has one bucket, a left row at most two, and a
    hot key spreads over its buckets. Rows without a partner are found by anti-joins on the same buckets, so
    repeated rows stay repeated; a null key or time has no partner. On streams the plain range condition lets
    Spark bound the join state.
    """
    in_range = (F.col(ts[1]) >= F.col(ts[0]) + durations.literal(lower)) & (
        F.col(ts[1]) <= F.col(ts[0]) + durations.literal(upper)
    )
    same_key = F.col(key[0]) == F.col(key[1])
    if left.isStreaming or right.isStreaming:
        return left.join(right, same_key & in_range, how)

    width = max(durations.micros(upper - lower), 1)
    at, right_at = position(left, ts[0]), position(right, ts[1])

    def spread(side: DataFrame, earliest: Column, latest: Column, name: str) -> DataFrame:
        return side.withColumn(name, F.explode(F.sequence(floor_div(earliest, width), floor_div(latest, width))))

    reached = spread(left, at + durations.micros(lower), at + durations.micros(upper), "_lb")
    placed = right.withColumn("_rb", floor_div(right_at, width))
    met = same_key & (F.col("_lb") == F.col("_rb")) & in_range
    columns = [*left.columns, *right.columns]
    joined = reached.join(placed, met, "inner").select(*columns)
    if how == "inner":
        return joined
    sought = spread(right, right_at - durations.micros(upper), right_at - durations.micros(lower), "_rb")
    lonely = left.withColumn("_lb", floor_div(at, width)).join(sought, met, "left_anti").drop("_lb")
    parts = [joined, lonely]
    if how == "full":
        parts.append(placed.join(reached, met, "left_anti").drop("_rb"))
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts).select(*columns)


def reconcile(
    app: DataFrame,
    platform: DataFrame,
    key: tuple[str, str],
    ts: tuple[str, str],
    wait: timedelta = timedelta(seconds=5),
) -> DataFrame:
    """Match app rows with platform rows that follow within ``wait``; report what is missing.

    ``status`` is ``success``, ``platform_missing`` or ``app_missing``; a row with a NULL key or time has no partner.
    """
    columns = [*app.columns, *platform.columns]
    sides = app.withColumn("_app", F.lit(True)), platform.withColumn("_platform", F.lit(True))
    joined = interval_join(*sides, key, ts, timedelta(0), wait, "full")
    status = (
        F.when(F.col("_platform").isNull(), "platform_missing").when(F.col("_app").isNull(), "app_missing").otherwise("success")
    )
    return joined.select(*columns, status.alias("status"))


def unbounded_join(left: DataFrame, right: DataFrame, key: tuple[str, str], how: str = "inner") -> DataFrame:
    """Equi-join over everything either side ever sends.

    As a stream-stream join its state grows for ever; with watermarks on both sides prefer
    :func:`interval_join`.
    """
    return left.join(right, F.col(key[0]) == F.col(key[1]), how)


def connect_map(left: DataFrame, right: DataFrame, left_text: Column, right_text: Column, out: str = "value") -> DataFrame:
    """Two differently typed inputs, each mapped to the same text column."""
    return left.select(left_text.alias(out)).unionByName(right.select(right_text.alias(out)))


def union_streams(*frames: DataFrame) -> DataFrame:
    """Inputs of one type as one; the combined watermark is the smallest of theirs."""
    return reduce(DataFrame.unionByName, frames)


def union_watermark(
    frames: Sequence[DataFrame], arrival: Sequence[str], ts: str = "ts", delay: timedelta = timedelta(0), out: str = "watermark"
) -> DataFrame:
    """The union of ``frames`` with the input each row came from (``lane``) and the watermark it meets.

    Each input's own watermark is its largest earlier event time in ``arrival`` order minus ``delay``; theirs together
    is the smallest, and NULL until every input has sent an event time. Rows without one hold nothing back. The prefix
    maxima of all inputs are taken in one ordered scan, cut into slices where it is long.
    """
    lanes = [frame.withColumn("lane", F.lit(i)) for i, frame in enumerate(frames)]
    merged = reduce(DataFrame.unionByName, lanes)
    names = [f"_seen_{i}" for i in range(len(lanes))]
    runs = {name: Run("max", F.when(F.col("lane") == i, F.col(ts)), inclusive=False) for i, name in enumerate(names)}
    seen = running(merged, [], [*arrival, "lane"], runs)
    all_sent = reduce(Column.__and__, (F.col(name).isNotNull() for name in names))
    smallest = F.least(*names) if len(names) > 1 else F.col(names[0])
    if isinstance(merged.schema[ts].dataType, T.LongType):
        smallest = smallest - F.lit(durations.micros(delay) // 1000).cast("long")
    else:
        smallest = smallest - durations.literal(delay)
    return seen.withColumn(out, F.when(all_sent, smallest)).drop(*names)


def route(df: DataFrame, routes: dict[str, Column], main: str = "main", out: str = "route") -> DataFrame:
    """Name the side output each row belongs to; the first matching condition wins."""
    chosen = F.lit(main)
    for name, condition in reversed(routes.items()):
        chosen = F.when(condition, name).otherwise(chosen)
    return df.withColumn(out, chosen)


def split(df: DataFrame, routes: dict[str, Column], main: str = "main") -> dict[str, DataFrame]:
    """One DataFrame per side output, plus the main one."""
    routed = route(df, routes, main, "_route")
    return {name: routed.where(F.col("_route") == name).drop("_route") for name in [*routes, main]}
