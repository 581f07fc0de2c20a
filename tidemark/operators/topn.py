"""Top-N by count, global and per window. Ties: count descending, then key ascending.

Rankings filter on ``row_number() <= n``, for which Spark keeps only n rows per group on the map side
before the exchange, so a window with very many keys never gathers in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.operators.keyed import count_by
from tidemark.operators.windows import hop_count, tumble_count


def top_keys(df: DataFrame, key: str = "user_name", n: int = 2) -> DataFrame:
    """The n most frequent keys; Spark takes n rows per task, then n of those."""
    best = count_by(df, [key]).orderBy(F.desc("cnt"), key).limit(n)
    return best.withColumn("row_num", F.row_number().over(Window.orderBy(F.desc("cnt"), key)).cast("long"))


def rank_in_window(counts: DataFrame, key: str, n: int = 2, window: Sequence[str] = ("window_start", "window_end")) -> DataFrame:
    """The n rows with the largest ``cnt`` per window, from counts per window and key.

    On a stream apply it to each micro-batch of finished counts (``streaming.runner.start_top_n``): the
    rows of a window all leave the append-mode aggregation in the same batch.
    """
    order = Window.partitionBy(*window).orderBy(F.desc("cnt"), key)
    return counts.withColumn("row_num", F.row_number().over(order).cast("long")).where(F.col("row_num") <= n)


def top_per_tumble(df: DataFrame, ts: str, size: timedelta = timedelta(seconds=10), key: str = "user", n: int = 2) -> DataFrame:
    return rank_in_window(tumble_count(df, ts, size, [key]), key, n)


def top_per_hop(
    df: DataFrame,
    ts: str,
    slide: timedelta = timedelta(seconds=5),
    size: timedelta = timedelta(seconds=10),
    key: str = "url",
    n: int = 2,
) -> DataFrame:
    return rank_in_window(hop_count(df, ts, slide, size, [key]), key, n)


def describe_top(ranked: DataFrame, key: str = "url") -> DataFrame:
    """One text row per window listing its (at most n) ranked keys."""
    # at most n entries per window, by construction of `ranked`
    entries = F.array_sort(F.collect_list(F.struct("row_num", F.col(key).cast("string").alias("k"), "cnt")))
    line = F.array_join(
        F.transform(entries, lambda e: F.concat(F.lit("No."), e["row_num"], F.lit(" "), e["k"], F.lit(" views: "), e["cnt"])), "; "
    )
    return ranked.groupBy("window_end").agg(line.alias("report"))


def top_values(counts: DataFrame, value: str = "cnt", n: int = 2, window: str = "window_end") -> DataFrame:
    """The n largest values per window with their rank; equal values each take a rank."""
    order = Window.partitionBy(window).orderBy(F.desc(value))
    ranked = counts.select(window, F.col(value).alias("value"), F.row_number().over(order).cast("long").alias("rank"))
    return ranked.where(F.col("rank") <= n)
