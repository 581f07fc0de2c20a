"""What five kinds of keyed state hold after each row (batch twin of ``processors.StateTour``)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark import durations
from tidemark.operators.ordered import Run, over_rows, running

# fixed values: what the map state's counter starts at
MAP_START = 999


def keyed_state_tour(
    df: DataFrame, key: str, order: Sequence[str], url: str = "url", ts: str = "timestamp"
) -> DataFrame:
    """Per row, in ``order`` within its key:

    * value state: the previous row's url (NULL at first);
    * list state: its length. The list itself is the key's first ``list_size`` rows; repeating it on every
      row would make the output quadratic;
    * map state: a counter that starts at 999;
    * reducing state: the first row's url with the latest time;
    * aggregating state: ``count: n``.
    """
    runs = {
        "value_url": Run("last", F.col(url), inclusive=False),
        "list_size": Run("count"),
        "reduced_url": Run("first", F.col(url)),
    }
    slim = df.select(*dict.fromkeys([key, *order, url, ts]))
    toured = running(slim, [key], order, runs)
    return toured.select(
        *dict.fromkeys([key, *order]),
        "value_url",
        "list_size",
        (F.col("list_size") + (MAP_START - 1)).alias("map_value"),
        "reduced_url",
        F.col(ts).alias("reduced_ts"),
        F.concat(F.lit("count: "), F.col("list_size").cast("string")).alias("aggregate"),
    )


def expiring_count(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str = "ts", ttl: timedelta = timedelta(hours=1), out: str = "cnt"
) -> DataFrame:
    """A running count per key whose state is gone ``ttl`` of event time after its last write, so that it starts anew.

    ``order`` begins with ``ts`` (a timestamp or epoch milliseconds). Every row writes; a row that comes ``ttl`` or more
    after the one before it is the first of a new count. A row without a time neither expires nor keeps a state: NULLs come
    first and count as one run. Gaps are found from the row before (the last row of the slice before is its halo), and the
    place of the last gap is a running maximum, so a hot key is walked in slices.
    """
    numeric = isinstance(df.schema[ts].dataType, T.LongType)
    amount = F.lit(durations.micros(ttl) // 1000).cast("long") if numeric else durations.literal(ttl)
    compared = over_rows(df, keys, order, 1, lambda window: {"_last": F.lag(ts).over(window)})
    numbered = running(compared, keys, order, {"_row": Run("count")})
    begins = F.coalesce(F.col(ts) >= F.col("_last") + amount, F.col("_last").isNull() & F.col(ts).isNotNull(), F.lit(False))
    started = running(numbered, keys, order, {"_from": Run("max", F.when(begins, F.col("_row")))})
    return started.withColumn(out, F.col("_row") - F.coalesce("_from", F.lit(1)) + 1).drop("_last", "_row", "_from")
