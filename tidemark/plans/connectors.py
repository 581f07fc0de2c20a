"""Sources and sinks: data goes out through a sink and comes back through a source."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from tidemark.plans.registry import query, table
from tidemark.plans.rows import clicks
from tidemark.session import shared_folder
from tidemark.sinks import files as file_sinks, stores
from tidemark.sources import files

_CLICKS = "SELECT CAST(user_id AS VARCHAR) AS user_name, event_type AS url, (epoch_us(ts) // 1000) AS ts FROM events"


def _click_csv(spark, sf) -> str:
    """Clicks as a CSV folder with blanks after some commas."""
    folder = shared_folder(spark, "clicks-csv")
    gap = F.when(F.col("event_id") % 2 == 0, ", ").otherwise(",")
    line = F.concat("user", gap, "url", F.lit(", "), F.col("timestamp").cast("string"))
    clicks(spark, sf).select(line.alias("value")).write.text(folder)
    return folder


@query("src_text_lines", "SELECT unnest(string_split(text, chr(10))) AS line FROM documents")
def src_text_lines(spark, sf):
    folder = shared_folder(spark, "text-lines")
    table(spark, sf, "documents").select("text").write.text(folder)
    return files.text_lines(spark, folder)


@query("parse_click_lines", 'SELECT CAST(user_id AS VARCHAR) AS "user", event_type AS url, (epoch_us(ts) // 1000) AS "timestamp" FROM events')
def parse_click_lines(spark, sf):
    return files.parse_click_lines(files.text_lines(spark, _click_csv(spark, sf)))


@query("src_csv_table", _CLICKS)
def src_csv_table(spark, sf):
    return files.csv_table(spark, _click_csv(spark, sf), view="click_table")


@query("src_csv_rowtime", f"SELECT *, CAST(to_timestamp(ts // 1000) AT TIME ZONE 'UTC' AS TIMESTAMP) AS et FROM ({_CLICKS})")
def src_csv_rowtime(spark, sf):
    timed = files.with_rowtime(files.csv_table(spark, _click_csv(spark, sf)))
    return timed.withColumn("et", F.col("et").cast("timestamp_ntz"))


@query("stream_to_table", "SELECT CAST(user_id AS VARCHAR) AS user_name, event_type AS link FROM events WHERE event_type <> 'view'")
def stream_to_table(spark, sf):
    files.to_table(clicks(spark, sf), "renamed_clicks", user_name="user", link="url")
    return spark.sql("SELECT user_name, link FROM renamed_clicks WHERE link <> 'view'")


@query("src_replay_clicks", "SELECT event_id, user_id, event_type FROM events")
def src_replay_clicks(spark, sf):
    """Clicks replayed as a stream by Spark's own file source, whose offsets are the files it has seen."""
    schema = T.StructType.fromDDL("event_id long, user_id long, event_type string")
    stream = files.parquet_stream(spark, f"{sf}/events.parquet", schema)
    folder, checkpoint = shared_folder(spark, "replay"), shared_folder(spark, "replay-offsets")
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start(folder).awaitTermination()
    return spark.read.schema(schema).parquet(folder)


@query("sink_csv_roundtrip", "SELECT event_id, user_id, event_type, value FROM events")
def sink_csv_roundtrip(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    folder = shared_folder(spark, "csv-sink")
    file_sinks.write_csv(events, folder)
    return files.written_csv(spark, folder, events.schema)


@query("sink_text_files", "SELECT event_type || ' -- ' || event_id AS line FROM events")
def sink_text_files(spark, sf):
    """A stream through the rolling text sink, read back."""
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())])
    stream = files.parquet_stream(spark, f"{sf}/events.parquet", schema)
    line = F.concat("event_type", F.lit(" -- "), F.col("event_id").cast("string"))
    folder, checkpoint = shared_folder(spark, "text-sink"), shared_folder(spark, "text-sink-offsets")
    file_sinks.start_rolling_text(stream.select(line.alias("value")), folder, checkpoint, available_now=True).awaitTermination()
    return files.text_lines(spark, folder)


@query(
    "index_documents",
    """SELECT 'events' AS "index", '{"' || user_id || '":"' || event_type || '"}' AS document FROM events""",
)
def index_documents(spark, sf):
    return stores.index_documents(clicks(spark, sf))


@query("buffered_batches", "SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 10 AS batch_no FROM events")
def buffered_batches(spark, sf):
    return stores.buffered_batches(table(spark, sf, "events").select("event_id"), "event_id")
