"""File sources and the text and CSV conventions of click files."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark import durations
from tidemark.schemas import CLICK_CSV
from tidemark.sinks.files import READ_LOSSLESS


def text_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """One row per line, in ``line``."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("text").option("lineSep", "\n").load(path).select(F.col("value").alias("line"))


def csv_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType = CLICK_CSV,
    view: str | None = None,
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A filesystem CSV table with a declared schema; blanks around fields are dropped."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.schema(schema).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    table = reader.csv(path)
    if view:
        table.createOrReplaceTempView(view)
    return table


def written_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV table that ``sinks.files.write_csv`` or ``start_csv`` wrote, with blanks, line ends and empty strings as they were."""
    return spark.read.schema(schema).options(**READ_LOSSLESS).csv(path)


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table (a file, a folder, or nested partition folders) as a stream, all new files in each micro-batch.

    ``max_files_per_trigger`` bounds a micro-batch, oldest files first.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile():
        # a stream watches folders: of this one, the file alone
        return reader.option("pathGlobFilter", place.getName()).parquet(place.getParent().toString())
    return reader.parquet(path)


def with_rowtime(
    df: DataFrame, millis: str = "ts", out: str = "et", delay: timedelta = timedelta(seconds=1)
) -> DataFrame:
    """Event time cut to whole seconds, with a bounded-out-of-orderness watermark."""
    seconds = F.timestamp_seconds(F.call_function("div", F.col(millis), F.lit(1000).cast("long")))
    return df.withColumn(out, seconds).withWatermark(out, durations.text(delay))


def parse_click_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """``user, url, epoch millis`` text lines as click rows; other columns are kept."""
    parts = F.split(line, ",")
    return df.select(
        *[c for c in df.columns if c != line],
        F.trim(parts[0]).alias("user"),
        F.trim(parts[1]).alias("url"),
        F.trim(parts[2]).cast("long").alias("timestamp"),
    )


def to_table(df: DataFrame, view: str, **columns: str) -> DataFrame:
    """Register a DataFrame as a view, optionally selecting and renaming (``new=old``)."""
    table = df.select(*[F.col(old).alias(new) for new, old in columns.items()]) if columns else df
    table.createOrReplaceTempView(view)
    return table
