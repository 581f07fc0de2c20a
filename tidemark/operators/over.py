"""Bounded-row OVER aggregates (batch). The streaming counterpart is ``processors.LastRows``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.ordered import over_rows


def average_of_last(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "ts", preceding: int = 3, out: str = "avg_ts"
) -> DataFrame:
    """``avg(value)`` over the current row and the ``preceding`` rows before it."""
    return over_rows(df, keys, order, preceding, lambda w: {out: F.avg(value).over(w.rowsBetween(-preceding, 0))})


def count_and_max_of_last(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    counted: str = "url",
    value: str = "ts",
    preceding: int = 2,
) -> DataFrame:
    """``count`` and ``max`` sharing one window definition."""

    def expressions(window):
        frame = window.rowsBetween(-preceding, 0)
        return {"cnt": F.count(counted).over(frame), "max_ts": F.max(value).over(frame)}

    return over_rows(df, keys, order, preceding, expressions)
