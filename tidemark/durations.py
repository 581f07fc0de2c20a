"""Durations are ``datetime.timedelta`` everywhere; these helpers turn them into what Spark wants."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, functions as F


def micros(duration: timedelta) -> int:
    return round(duration.total_seconds() * 1_000_000)


def text(duration: timedelta) -> str:
    """Interval string for ``window``, ``withWatermark`` and triggers."""
    return f"{micros(duration)} microseconds"


def literal(duration: timedelta) -> Column:
    """Day-time interval column, for timestamp arithmetic."""
    return F.lit(duration)
