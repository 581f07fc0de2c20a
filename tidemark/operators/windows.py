"""Event-time windows: tumbling, sliding, cumulative, and count-triggered groups.

Windows are half-open ``[start, end)`` and aligned to the epoch. The same functions serve batch and
streaming DataFrames (append mode, with a watermark on ``ts``). In batch, overlapping windows are built
from *panes*: rows are first reduced to one row per key and pane, and only those are copied into the
windows that cover them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from math import gcd

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark import durations
from tidemark.operators.ordered import floor_div, number_rows

WINDOW = "_window"


def _flatten(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != WINDOW]
    return df.select(F.col(WINDOW).start.alias("window_start"), F.col(WINDOW).end.alias("window_end"), *rest)


def tumble_count(
    df: DataFrame, ts: str, size: timedelta = timedelta(seconds=10), keys: Sequence[str] = ("user",), out: str = "cnt"
) -> DataFrame:
    """Rows per key and tumbling window."""
    window = F.window(ts, durations.text(size)).alias(WINDOW)
    return _flatten(df.groupBy(window, *keys).agg(F.count(F.lit(1)).alias(out)))


def url_view_count(df: DataFrame, ts: str, size: timedelta = timedelta(seconds=10), url: str = "url") -> DataFrame:
    return tumble_count(df, ts, size, [url])


def hop_count(
    df: DataFrame,
    ts: str,
    slide: timedelta = timedelta(seconds=5),
    size: timedelta = timedelta(seconds=10),
    keys: Sequence[str] = ("user",),
    out: str = "cnt",
) -> DataFrame:
    """Rows per key and sliding window."""
    if df.isStreaming:
        window = F.window(ts, durations.text(size), durations.text(slide)).alias(WINDOW)
        return _flatten(df.groupBy(window, *keys).agg(F.count(F.lit(1)).alias(out)))
    panes = _panes(df, ts, slide, size, keys)
    return _spread_hop(panes, slide, size).groupBy("window_start", "window_end", *keys).agg(F.sum("_n").alias(out))


def _panes(df: DataFrame, ts: str, slide: timedelta, size: timedelta, keys: Sequence[str]) -> DataFrame:
    """Row counts per key and pane; a pane never straddles a window border."""
    pane = timedelta(microseconds=gcd(durations.micros(slide), durations.micros(size)))
    return df.groupBy(F.window(ts, durations.text(pane)).alias(WINDOW), *keys).agg(F.count(F.lit(1)).alias("_n"))


def _spread_hop(panes: DataFrame, slide: timedelta, size: timedelta) -> DataFrame:
    """Copy panes into the sliding windows that cover them."""
    start = F.col(WINDOW).start
    windows = F.window(start, durations.text(size), durations.text(slide)).alias("_hop")
    rest = [c for c in panes.columns if c != WINDOW]
    return panes.select(windows, *rest).select(
        F.col("_hop").start.alias("window_start"), F.col("_hop").end.alias("window_end"), *rest
    )


def cumulate_count(
    df: DataFrame,
    ts: str,
    step: timedelta = timedelta(seconds=5),
    size: timedelta = timedelta(seconds=10),
    keys: Sequence[str] = ("user",),
    out: str = "cnt",
) -> DataFrame:
    """Rows per key and cumulative window ``[s, s+step), [s, s+2*step), ... [s, s+size)``."""
    if df.isStreaming:
        window = F.window(ts, durations.text(size)).alias(WINDOW)
        rows = df.select(window, F.col(ts).alias("_ts"), *keys).withColumn("window_end", _ends(WINDOW, "_ts", step))
        grouped = rows.groupBy(WINDOW, "window_end", *keys).agg(F.count(F.lit(1)).alias(out))
        return grouped.select(F.col(WINDOW).start.alias("window_start"), "window_end", *keys, out)
    # the window's sum up to each pane holds until the next pane that has rows: panes travel once, ends are made behind
    panes = _panes(df, ts, step, size, keys).select(
        F.window(F.col(WINDOW).start, durations.text(size)).alias("_whole"), F.col(WINDOW).start.alias("_ts"), *keys, "_n"
    )
    panes = panes.select(F.col("_whole").start.alias("window_start"), F.col("_whole").end.alias("_end"), "_ts", *keys, "_n")
    steps = Window.partitionBy("window_start", *keys).orderBy("_ts")
    summed = panes.select(
        "window_start",
        "_end",
        *keys,
        F.sum("_n").over(steps.rowsBetween(Window.unboundedPreceding, 0)).alias(out),
        "_ts",
        F.coalesce(F.lead("_ts").over(steps), F.col("_end")).alias("_until"),
    )
    # a pane's own steps alone: from the first end behind it to the last one that the next pane does not begin behind
    width = durations.micros(step)
    start, at, until = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("window_start", "_ts", "_until"))
    first, last = floor_div(at - start, width) + 1, floor_div(until - start, width)
    ends = F.transform(F.sequence(first, last), lambda k: F.col("window_start") + k * durations.literal(step))
    return summed.where(first <= last).select("window_start", F.explode(ends).alias("window_end"), *keys, out)


def _ends(window: str, ts: str, step: timedelta) -> Column:
    """One row per cumulative window end after ``ts``."""
    start, end = F.col(window).start, F.col(window).end
    ends = F.sequence(start + durations.literal(step), end, durations.literal(step))
    return F.explode(F.filter(ends, lambda e: e > F.col(ts)))


def pv_uv(
    df: DataFrame,
    ts: str,
    size: timedelta = timedelta(seconds=10),
    slide: timedelta | None = None,
    user: str = "user",
) -> DataFrame:
    """Page views, distinct users and their whole-number ratio (as a double) per window.

    Counting per (window, user) first keeps the distinct step parallel and free of per-window sets; the
    same two aggregations chain on a stream.
    """
    slide = slide or size
    if df.isStreaming or slide == size:
        window = F.window(ts, durations.text(size), durations.text(slide)).alias(WINDOW)
        per_user = df.groupBy(window, user).agg(F.count(F.lit(1)).alias("_n"))
        per_window = _flatten(per_user.groupBy(WINDOW).agg(F.sum("_n").alias("pv"), F.count(F.lit(1)).alias("uv")))
    else:
        per_user = _spread_hop(_panes(df, ts, slide, size, [user]), slide, size)
        per_user = per_user.groupBy("window_start", "window_end", user).agg(F.sum("_n").alias("_n"))
        per_window = per_user.groupBy("window_start", "window_end").agg(
            F.sum("_n").alias("pv"), F.count(F.lit(1)).alias("uv")
        )
    return per_window.withColumn("ratio", F.call_function("div", F.col("pv"), F.col("uv")).cast("double"))


def window_uv(df: DataFrame, ts: str, size: timedelta = timedelta(seconds=10), user: str = "user") -> DataFrame:
    """Distinct users per tumbling window."""
    return pv_uv(df, ts, size, user=user).select("window_start", "window_end", "uv")


def count_window_average(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "timestamp", every: int = 5, out: str = "avg_ts"
) -> DataFrame:
    """Whole-number average of ``value`` over each full run of ``every`` rows per key."""
    numbered = number_rows(df.select(*dict.fromkeys([*keys, *order, value])), keys, order, "_row")
    return (
        numbered.groupBy(*keys, floor_div(F.col("_row") - 1, every).alias("group_no"))
        .agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") == every)
        .select(*keys, "group_no", F.call_function("div", F.col("_sum"), F.col("_n")).alias(out))
    )


def as_event_time(df: DataFrame, ts: str, out: str = "et") -> DataFrame:
    """A ``TIMESTAMP`` column from epoch milliseconds or a naive timestamp (read as UTC)."""
    if isinstance(df.schema[ts].dataType, T.LongType):
        return df.withColumn(out, F.timestamp_millis(ts))
    return df.withColumn(out, F.col(ts).cast("timestamp"))
