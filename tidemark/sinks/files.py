"""Row-format file sinks."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark import durations

#: NULL is nothing between commas and an empty string is quoted; quotes are doubled, and no blank or line end is dropped.
WRITE_LOSSLESS = {"lineSep": "\n", "escape": '"', "emptyValue": '""', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
#: Reading needs a stand-in for NULL, or empty strings would be taken for it.
READ_LOSSLESS = WRITE_LOSSLESS | {"multiLine": "true", "emptyValue": "", "nullValue": "\x00null\x00"}


def start_rolling_text(
    df: DataFrame,
    path: str,
    checkpoint: str,
    interval: timedelta = timedelta(minutes=15),
    max_records_per_file: int = 10_000_000,
    available_now: bool = False,
) -> StreamingQuery:
    """Append a one-column stream as text files, a new set of files per ``interval``.

    Files also roll at ``max_records_per_file``; Spark rolls by record count, not by bytes or idleness.
    """
    writer = (
        df.writeStream.format("text").option("checkpointLocation", checkpoint).option("maxRecordsPerFile", max_records_per_file)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": durations.text(interval)}
    return writer.trigger(**trigger).start(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A finished DataFrame as a CSV table."""
    df.write.mode("errorifexists").options(**WRITE_LOSSLESS).csv(path)


def start_csv(df: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """An append-only stream as a CSV table."""
    writer = df.writeStream.format("csv").options(**WRITE_LOSSLESS).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start(path)
