"""Starting streams: checkpoint and trigger settings, sinks, and per-batch steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark import durations
from tidemark.operators import late
from tidemark.operators.rules import match_rules, match_rules_at
from tidemark.operators.topn import rank_in_window


@dataclass(frozen=True)
class StreamSettings:
    """How a stream runs and what survives a failure.

    ``checkpoint`` and ``name`` must stay the same across restarts: together they identify the query, its
    source offsets and its state. ``interval`` is the time between micro-batches, each of which ends in a
    checkpoint and moves the watermark; ``None`` with ``available_now`` drains the input and stops. File
    sinks are exactly-once; per-batch steps may repeat a batch and are therefore keyed by batch id.
    """

    checkpoint: str
    name: str | None = None
    interval: timedelta | None = timedelta(seconds=10)
    output_mode: str = "append"
    available_now: bool = False

    def writer(self, df: DataFrame) -> DataStreamWriter:
        writer = df.writeStream.outputMode(self.output_mode).option("checkpointLocation", self.checkpoint)
        if self.name:
            writer = writer.queryName(self.name)
        if self.available_now:
            return writer.trigger(availableNow=True)
        return writer.trigger(processingTime=durations.text(self.interval)) if self.interval else writer


def watermarked(df: DataFrame, et: str = "et", delay: timedelta = timedelta(0)) -> DataFrame:
    """Bounded out-of-orderness; a zero delay expects event times in order."""
    return df.withWatermark(et, durations.text(delay))


def start_console(df: DataFrame, settings: StreamSettings) -> StreamingQuery:
    return settings.writer(df).format("console").option("truncate", False).start()


def start_files(df: DataFrame, path: str, settings: StreamSettings, file_format: str = "parquet") -> StreamingQuery:
    return settings.writer(df).format(file_format).start(path)


def start_batches(df: DataFrame, write: Callable[[DataFrame, int], None], settings: StreamSettings) -> StreamingQuery:
    """Hand each micro-batch and its id to ``write``."""
    return settings.writer(df).foreachBatch(write).start()


def start_top_n(
    counts: DataFrame, key: str, write: Callable[[DataFrame, int], None], settings: StreamSettings, n: int = 2
) -> StreamingQuery:
    """Rank finished windows of an append-mode count.

    The watermark finishes whole windows, so all rows of a window are in one micro-batch and a batch
    ranking of it is final.
    """
    return start_batches(counts, lambda batch, batch_id: write(rank_in_window(batch, key, n), batch_id), settings)


def start_rules(
    pairs: DataFrame,
    read_rules: Callable[[SparkSession], DataFrame],
    write: Callable[[DataFrame, int], None],
    settings: StreamSettings,
    mode: str = "all",
) -> StreamingQuery:
    """Match action pairs against rules that are read anew for every micro-batch.

    A changed rule applies from the next micro-batch on.
    """

    def match(batch: DataFrame, batch_id: int) -> None:
        write(match_rules(batch, read_rules(batch.sparkSession), mode), batch_id)

    return start_batches(pairs, match, settings)


def start_late_split(
    df: DataFrame,
    ts: str,
    arrival: Sequence[str],
    folder: str,
    settings: StreamSettings,
    size: timedelta = timedelta(seconds=10),
    delay: timedelta = timedelta(seconds=2),
    lateness: timedelta = timedelta(seconds=30),
) -> StreamingQuery:
    """Split a stream into on-time, re-firing and late rows, which Spark's own watermark would drop.

    Each micro-batch is classified row by row in arrival order, continuing from the largest event time of
    all earlier batches, which is kept beside the output per batch id. Rows go to
    ``folder/rows/batch=<id>/lateness=<verdict>``.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        before = _seen_before(batch, ts, folder, batch_id)
        with _kept(batch) as rows, _kept(late.classify(rows, ts, arrival, size, delay, lateness, seen_before=before)) as classified:
            classified.write.mode("overwrite").partitionBy("lateness").parquet(f"{folder}/rows/batch={batch_id}")
            _keep_seen(rows, ts, before, folder, batch_id)

    return start_batches(df, split, settings)


@contextmanager
def _kept(df: DataFrame) -> Iterator[DataFrame]:
    """Computed once for the writes inside, then let go."""
    held = df.persist()
    try:
        yield held
    finally:
        held.unpersist()


def _seen_before(batch: DataFrame, ts: str, folder: str, batch_id: int) -> Column:
    """The largest event time of all earlier batches, as the batch before this one left it."""
    schema = batch.select(F.col(ts).alias("seen")).schema
    row = batch.sparkSession.read.schema(schema).parquet(f"{folder}/seen/batch={batch_id - 1}").first() if batch_id else None
    return F.lit(row and row["seen"]).cast(schema["seen"].dataType)


def _keep_seen(rows: DataFrame, ts: str, before: Column, folder: str, batch_id: int) -> None:
    rows.agg(F.greatest(F.max(ts), before).alias("seen")).write.mode("overwrite").parquet(f"{folder}/seen/batch={batch_id}")


def _forget(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def start_late_windows(
    df: DataFrame,
    ts: str,
    keys: Sequence[str],
    arrival: Sequence[str],
    folder: str,
    settings: StreamSettings,
    size: timedelta = timedelta(seconds=10),
    delay: timedelta = timedelta(seconds=2),
    lateness: timedelta = timedelta(seconds=30),
) -> StreamingQuery:
    """Window counts that are emitted when the watermark passes the window, and again when late rows change them.

    Rows are judged one by one in arrival order as :func:`start_late_split` does. A micro-batch merges its counts with
    those of the windows that are still open, which the batch before left under its id, and writes

    * ``folder/updates/batch=<id>``: windows that the watermark has passed in this batch, and passed ones that its rows
      touched, with their counts so far (:func:`late_windows` reads the latest of each);
    * ``folder/side/batch=<id>``: rows that came too late for their window;
    * ``folder/open/batch=<id>``: windows that rows may still touch, and ``folder/seen/batch=<id>``: the largest event time.

    All are keyed by batch id, so a batch that is repeated after a failure writes the same again; of open windows only
    the last two ids are kept. What a batch costs grows with its rows and the open windows, not with the history. The
    latest updates do not depend on how the rows were dealt into micro-batches.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _seen_before(batch, ts, folder, batch_id)
        with _kept(batch) as rows, _kept(late.classify(rows, ts, arrival, size, delay, lateness, seen_before=before)) as classified:
            _keep_seen(rows, ts, before, folder, batch_id)
            now = _seen_before(rows, ts, folder, batch_id + 1)
            late.side_output(classified).write.mode("overwrite").parquet(f"{folder}/side/batch={batch_id}")
            window = ["window_start", "window_end", *keys]
            counts = late.window_counts(classified, keys)
            touched = counts.withColumn("touched", F.lit(True))
            if batch_id:
                earlier = spark.read.schema(counts.schema).parquet(f"{folder}/open/batch={batch_id - 1}")
                touched = touched.unionByName(earlier.withColumn("touched", F.lit(False)))
            sums = [F.sum(c).alias(c) for c in ("cnt", "refires")]
            with _kept(touched.groupBy(*window).agg(*sums, F.max("touched").alias("touched"))) as merged:
                closes = F.col("window_end") + durations.literal(delay)
                passed = F.coalesce(closes <= now, F.lit(False))
                fresh = F.coalesce(closes > before, F.lit(True))
                updates = merged.where(passed & (F.col("touched") | fresh)).drop("touched")
                updates.write.mode("overwrite").parquet(f"{folder}/updates/batch={batch_id}")
                still_open = F.coalesce(closes + durations.literal(lateness) > now, F.lit(True))
                merged.where(still_open).drop("touched").write.mode("overwrite").parquet(f"{folder}/open/batch={batch_id}")
        if batch_id > 1:
            _forget(spark, f"{folder}/open/batch={batch_id - 2}")

    return start_batches(df, step, settings)


def late_windows(spark: SparkSession, folder: str, keys: Sequence[str]) -> DataFrame:
    """The latest update of each window that :func:`start_late_windows` has emitted."""
    updates = spark.read.parquet(f"{folder}/updates")
    rest = ["cnt", "refires"]
    latest = F.max_by(F.struct(*rest), "batch").alias("_latest")
    return updates.groupBy("window_start", "window_end", *keys).agg(latest).select("window_start", "window_end", *keys, "_latest.*")


def start_rules_at(
    pairs: DataFrame,
    rules: DataFrame,
    order: Sequence[str],
    write: Callable[[DataFrame, int], None],
    folder: str,
    settings: StreamSettings,
) -> StreamingQuery:
    """Match action pairs against the rule that is valid at each, both arriving on streams with the ``order`` columns.

    The streams must come in ``order`` from micro-batch to micro-batch; inside one any order will do. The last rule of all
    earlier batches is kept under the batch id, so a repeated batch meets the same rules.
    """
    rule_columns = [*order, "action1", "action2"]
    tagged = pairs.withColumn("_is_rule", F.lit(False)).unionByName(
        rules.select(*rule_columns).withColumn("_is_rule", F.lit(True)), allowMissingColumns=True
    )

    def match(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with _kept(batch) as rows:
            now = rows.where("_is_rule").select(*rule_columns)
            if batch_id:
                now = now.unionByName(spark.read.schema(now.schema).parquet(f"{folder}/rule/batch={batch_id - 1}"))
            with _kept(now) as known:
                write(match_rules_at(rows.where("NOT _is_rule").drop("_is_rule"), known, order), batch_id)
                last = known.agg(F.max(F.struct(*rule_columns)).alias("_r")).where("_r IS NOT NULL").select("_r.*")
                last.write.mode("overwrite").parquet(f"{folder}/rule/batch={batch_id}")

    return start_batches(tagged, match, settings)
