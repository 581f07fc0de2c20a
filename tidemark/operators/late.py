"""Late data against a bounded-out-of-orderness watermark, decided row by row in arrival order.

For a row of window ``[s, e)`` let ``seen`` be the largest event time of all earlier arrivals:

* ``late``    when ``seen >= e + delay + lateness`` (side output),
* ``refire``  when ``e + delay <= seen < e + delay + lateness`` (updates a window already emitted),
* ``on_time`` otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import durations
from tidemark.operators.ordered import Run, running

ON_TIME, REFIRE, LATE = "on_time", "refire", "late"


def classify(
    df: DataFrame,
    ts: str,
    arrival: Sequence[str],
    size: timedelta = timedelta(seconds=10),
    delay: timedelta = timedelta(seconds=2),
    lateness: timedelta = timedelta(seconds=30),
    seen_before: Column | None = None,
) -> DataFrame:
    """Add ``window_start``, ``window_end`` and ``lateness``.

    ``seen_before`` is the largest event time that came before the first row, if any. A row without an event time
    belongs to no window and counts as late, so it is in the side output.
    """
    seen_rows = running(df, [], arrival, {"_seen": Run("max", F.col(ts), inclusive=False)})
    seen = F.col("_seen") if seen_before is None else F.greatest("_seen", seen_before)
    windowed = seen_rows.where(F.col(ts).isNotNull()).withColumn("_w", F.window(ts, durations.text(size)))
    closes = F.col("_w").end + durations.literal(delay)
    verdict = (
        F.when(seen >= closes + durations.literal(lateness), LATE).when(seen >= closes, REFIRE).otherwise(ON_TIME)
    )
    timed = windowed.select(
        *df.columns, F.col("_w").start.alias("window_start"), F.col("_w").end.alias("window_end"), verdict.alias("lateness")
    )
    untimed = df.where(F.col(ts).isNull()).withColumn("lateness", F.lit(LATE))
    return timed.unionByName(untimed, allowMissingColumns=True)


def window_counts(classified: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Final counts: everything but late rows, with the number of re-firing rows."""
    kept = classified.where(F.col("lateness") != LATE)
    return kept.groupBy("window_start", "window_end", *keys).agg(
        F.count(F.lit(1)).alias("cnt"), F.count_if(F.col("lateness") == REFIRE).alias("refires")
    )


def side_output(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("lateness") == LATE).drop("lateness")
