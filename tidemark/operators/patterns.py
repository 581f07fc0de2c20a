"""Sequence patterns per key over a finished event history (batch).

The streaming counterparts, which wait for the watermark before matching, are in
``tidemark.streaming.processors``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import durations
from tidemark.operators.joins import interval_join
from tidemark.operators.ordered import Run, over_rows, running


def consecutive(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], condition: Column, times: int = 3, ts: str = "ts"
) -> DataFrame:
    """Runs of ``times`` directly consecutive rows that all meet ``condition``; runs may overlap.

    One row per match with the event times ``ts_1 .. ts_n``.
    """
    marked = df.select(*dict.fromkeys([*keys, *order, ts]), F.coalesce(condition, F.lit(False)).cast("int").alias("_hit"))

    def expressions(window):
        hits = F.sum("_hit").over(window.rowsBetween(1 - times, 0))
        times_back = {f"ts_{times - back}": F.lag(ts, back).over(window) for back in range(times - 1, 0, -1)}
        return {"_hits": hits, **times_back}

    matched = over_rows(marked, keys, order, times - 1, expressions).where(F.col("_hits") == times)
    return matched.select(*keys, *[f"ts_{i}" for i in range(1, times)], F.col(ts).alias(f"ts_{times}"))


def steps(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    conditions: Sequence[Column],
    within: timedelta | None = None,
    ts: str = "ts",
) -> DataFrame:
    """Directly consecutive rows of a key that meet ``conditions`` one after another; matches may overlap.

    With ``within``, the last row comes strictly less than that after the first. One row per match with the event
    times ``ts_1 .. ts_n``.
    """
    times = len(conditions)
    met = [F.coalesce(c, F.lit(False)).alias(f"_met_{i}") for i, c in enumerate(conditions)]
    marked = df.select(*dict.fromkeys([*keys, *order, ts]), *met)

    def expressions(window):
        hits = [F.lag(f"_met_{i}", times - 1 - i).over(window) if i < times - 1 else F.col(f"_met_{i}") for i in range(times)]
        times_back = {f"ts_{times - back}": F.lag(ts, back).over(window) for back in range(times - 1, 0, -1)}
        return {"_all": reduce(Column.__and__, hits), **times_back}

    matched = over_rows(marked, keys, order, times - 1, expressions).where("_all")
    found = matched.select(*keys, *[f"ts_{i}" for i in range(1, times)], F.col(ts).alias(f"ts_{times}"))
    return found if within is None else found.where(F.col(f"ts_{times}") < F.col("ts_1") + _amount(df, ts, within))


def alert_text(matches: DataFrame, key: str, times: int = 3) -> DataFrame:
    """The matches as alert lines."""
    stamps = F.concat_ws(", ", *[F.col(f"ts_{i}").cast("string") for i in range(1, times + 1)])
    return matches.select(F.concat(F.col(key).cast("string"), F.lit(f" failed {times} times in a row: "), stamps).alias("alert"))


def followed_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    first: Column,
    second: Column,
    within: timedelta = timedelta(minutes=15),
    ts: str = "ts",
) -> DataFrame:
    """Each ``first`` row with the next ``second`` row of its key, other rows in between allowed.

    ``status`` is ``paid`` when the second row comes strictly within the limit, else ``timeout``; rows
    still open when the input ends time out as well.
    """
    steps = df.where(first | second).select(
        *dict.fromkeys([*keys, *order, ts]), first.alias("_is_first"), F.when(second, F.col(ts)).alias("_second_ts")
    )
    following = running(steps, keys, order, {"_next": Run("min", F.col("_second_ts"), inclusive=False)}, reverse=True)
    in_time = F.col("_next") < F.col(ts) + _amount(df, ts, within)
    return following.where("_is_first").select(
        *keys,
        F.col(ts).alias("first_ts"),
        F.when(in_time, F.col("_next")).alias("second_ts"),
        F.when(in_time, "paid").otherwise("timeout").alias("status"),
    )


def _amount(df: DataFrame, ts: str, duration: timedelta) -> Column:
    """``duration`` in the unit of the time column: an interval, or milliseconds for numbers."""
    if df.schema[ts].dataType.typeName() == "long":
        return F.lit(durations.micros(duration) // 1000).cast("long")
    return durations.literal(duration)


def combinations(
    df: DataFrame,
    key: str,
    ts: str,
    seq: str,
    condition: Column,
    within: timedelta,
    times: int = 3,
) -> DataFrame:
    """All ordered choices of ``times`` matching rows of a key whose ends lie strictly within ``within``.

    The result is combinatorial by definition, so the time limit is mandatory. Each further row is found
    by a time-bucketed interval join, never by pairing a whole key with itself.
    """
    hits = df.where(condition)

    def side(number: int) -> DataFrame:
        return hits.select(F.col(key).alias(f"_k{number}"), F.col(ts).alias(f"ts_{number}"), F.col(seq).alias(f"seq_{number}"))

    found = side(1)
    for number in range(2, times + 1):
        last = number - 1
        found = interval_join(
            found, side(number), (f"_k{last}", f"_k{number}"), (f"ts_{last}", f"ts_{number}"), timedelta(0), within
        ).where(
            (F.struct(f"ts_{number}", f"seq_{number}") > F.struct(f"ts_{last}", f"seq_{last}"))
            & (F.col(f"ts_{number}") < F.col("ts_1") + durations.literal(within))
        )
        found = found.drop(f"_k{last}")
    return found.withColumnRenamed(f"_k{times}", key)
