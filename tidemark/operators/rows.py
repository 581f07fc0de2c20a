"""Row-wise transforms. All of them work on batch and streaming DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark import durations
from tidemark.operators.ordered import Run, running


def project(df: DataFrame, column: str = "user") -> DataFrame:
    return df.select(column)


def where_equal(df: DataFrame, column: str = "user", value: object = "Mary") -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def flatmap_fields(df: DataFrame, columns: Sequence[str] = ("user", "url", "timestamp"), out: str = "field") -> DataFrame:
    """One row per field of each input row, as text."""
    return df.select(F.explode(F.array(*[F.col(c).cast("string") for c in columns])).alias(out))


def flatmap_concat(
    df: DataFrame, columns: Sequence[str] = ("user", "url", "timestamp"), out: str = "line", separator: str = " -- "
) -> DataFrame:
    return df.select(F.concat_ws(separator, *[F.col(c).cast("string") for c in columns]).alias(out))


def flatmap_conditional(
    df: DataFrame, condition: Column, optional: str = "url", always: str = "timestamp", out: str = "field"
) -> DataFrame:
    """``optional`` only where ``condition`` holds, ``always`` in every case."""
    fields = F.array(F.when(condition, F.col(optional).cast("string")), F.col(always).cast("string"))
    return df.select(F.explode(F.filter(fields, lambda field: field.isNotNull())).alias(out))


def lines(df: DataFrame, text: str = "text", out: str = "line") -> DataFrame:
    """One row per line of a text column; other columns are kept."""
    return df.select(*[c for c in df.columns if c != text], F.explode(F.split(text, "\n")).alias(out))


def words(df: DataFrame, line: str = "line", out: str = "word", lowercase: bool = False) -> DataFrame:
    """One row per non-empty, space-separated word of ``line``; other columns are kept."""
    source = F.lower(line) if lowercase else F.col(line)
    exploded = df.select(*[c for c in df.columns if c != line], F.explode(F.split(source, " ")).alias(out))
    return exploded.where(F.col(out) != "")


def text_length(df: DataFrame, column: str = "user", out: str = "user_length") -> DataFrame:
    return df.select(F.length(F.col(column).cast("string")).alias(out))


def map_partitions(
    df: DataFrame,
    open_: Callable[[], object],
    map_: Callable[[object, pd.DataFrame], pd.DataFrame],
    close: Callable[[object], None],
    schema: T.StructType | str,
) -> DataFrame:
    """Map Arrow batches with something opened once per partition and closed at its end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open_()
        try:
            for batch in batches:
                yield map_(resource, batch)
        finally:
            close(resource)

    return df.mapInPandas(run, schema)


def annotate_watermark(
    df: DataFrame, arrival: Sequence[str], ts: str = "timestamp", delay: timedelta = timedelta(0)
) -> DataFrame:
    """Add the watermark each row meets (largest earlier event time minus ``delay``) and its partition.

    The partition is the one Spark read the row in. ``watermark`` is NULL for the first arrival.
    """
    tagged = df.withColumn("subtask", F.spark_partition_id())
    seen = running(tagged, [], arrival, {"_seen": Run("max", F.col(ts), inclusive=False)})
    if isinstance(df.schema[ts].dataType, T.LongType):
        watermark = F.col("_seen") - F.lit(durations.micros(delay) // 1000).cast("long")
    else:
        watermark = F.col("_seen") - durations.literal(delay)
    return seen.withColumn("watermark", watermark).drop("_seen")
