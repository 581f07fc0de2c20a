"""Keyed aggregates without time windows: final values, and running values per input row.

The final forms are plain hash aggregates and work on streams in ``update`` or ``complete`` mode. The
running forms emit one row per input row in a given total order and are batch only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.ordered import Run, running


def count_by(df: DataFrame, keys: Sequence[str], out: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "cnt") -> DataFrame:
    return running(df, keys, order, {out: Run("count")})


def running_reduce(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, Run]) -> DataFrame:
    """After each row, its key's rows so far reduced by an associative function per output column.

    ``values`` name them as :class:`Run` (sum, max, min, first, last, count) over any expression of the row.
    """
    return running(df, keys, order, values)


def max_field(df: DataFrame, keys: Sequence[str], field: str, order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The largest ``field`` per key, next to the ``keep`` columns of the key's *first* row."""
    first = F.min(F.struct(*order, *[c for c in keep if c not in order]))
    return (
        df.groupBy(*keys)
        .agg(F.max(field).alias(field), first.alias("_first"))
        .select(*keys, *[F.col("_first")[c].alias(c) for c in keep], field)
    )


def running_max_field(
    df: DataFrame, keys: Sequence[str], field: str, order: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """After each row: the largest ``field`` so far and the ``keep`` columns of the key's first row."""
    runs = {f"max_{field}": Run("max", F.col(field))}
    runs |= {f"first_{c}": Run("first", F.col(c)) for c in keep}
    return running(df, keys, order, runs)


def max_row(df: DataFrame, keys: Sequence[str], field: str, seq: str) -> DataFrame:
    """The whole row with the largest ``field`` per key; the earliest ``seq`` wins ties."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(F.col(field), -F.col(seq)))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, *[F.col("_best")[c].alias(c) for c in rest])


def latest_value(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """The last written ``value`` per key, as an upsert store would hold it."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def most_active_running(df: DataFrame, key: str, seq: str) -> DataFrame:
    """After each row: the key with the largest running count so far; later rows win ties."""
    counted = running_count(df.select(key, seq), [key], [seq], out="_cnt")
    leader = F.struct(F.col("_cnt").alias("cnt"), F.col(seq).alias("_at"), F.col(key).alias("leader"))
    return running(counted, [], [seq], {"_best": Run("max", leader)}, sizing=df.select(seq)).select(
        seq, key, F.col("_best.leader").alias("leader"), F.col("_best.cnt").alias("leader_cnt")
    )


def most_active(df: DataFrame, key: str, seq: str) -> DataFrame:
    """The key with the most rows; among equals the one that got there last."""
    totals = df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"), F.max(seq).alias("_last"))
    return totals.orderBy(F.desc("cnt"), F.desc("_last")).limit(1).select(key, "cnt")
