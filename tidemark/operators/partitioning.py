"""Explicit data distribution. Keyed operators need none of this; Spark exchanges by key itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def shuffle(df: DataFrame, partitions: int) -> DataFrame:
    """Random placement.

    Spark deals rows out round robin after ordering them by hash, from a start that differs per task. The
    effect is random and even, and unlike ``rand()`` it repeats exactly when a lost task is run again.
    """
    return df.repartition(partitions)


def rebalance(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Evenly filled partitions; without a number, of the size adaptive execution aims at."""
    return df.hint("rebalance") if partitions is None else df.repartition(partitions)


def rescale(df: DataFrame, partitions: int, grow: bool = False) -> DataFrame:
    """Fewer partitions by merging neighbours, without an exchange; more only with ``grow``."""
    return df.repartition(partitions) if grow else df.coalesce(partitions)


def broadcast_copies(df: DataFrame, partitions: int, out: str = "subtask") -> DataFrame:
    """Every row once per partition. The number of copies is the caller's constant."""
    copies = F.explode(F.sequence(F.lit(0), F.lit(partitions - 1)))
    return df.withColumn(out, copies).repartitionById(partitions, F.col(out))


def single(df: DataFrame) -> DataFrame:
    """All rows in one partition. By definition this does not scale; keep it for small results."""
    return df.coalesce(1)


def custom(df: DataFrame, partitions: int, partition_id: Column) -> DataFrame:
    """Row ``r`` goes to partition ``partition_id(r)``."""
    return df.repartitionById(partitions, partition_id.cast("int"))


def with_partition(df: DataFrame, out: str = "partition") -> DataFrame:
    return df.withColumn(out, F.spark_partition_id())
