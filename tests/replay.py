"""Feed rows to a stream as a few parquet files and collect what comes out."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql.types import _parse_datatype_string

from tidemark.sources.files import parquet_stream

FLUSH_MS = int(datetime(2100, 1, 1, tzinfo=timezone.utc).timestamp() * 1000)
SCHEMA = "seq long, user_id long, event_type string, ts long, et timestamp, side int"
ARROW = pa.schema(
    [
        ("seq", pa.int64()),
        ("user_id", pa.int64()),
        ("event_type", pa.string()),
        ("ts", pa.int64()),
        ("et", pa.timestamp("us", tz="UTC")),
        ("side", pa.int32()),
    ]
)
FLUSH_USER = -1


def event(seq, user_id, event_type, ts, side=0):
    return {"seq": seq, "user_id": user_id, "event_type": event_type, "ts": ts, "et": ts * 1000, "side": side}


def write_files(folder, rows, parts=2, flush=True):
    """``rows`` in arrival order over ``parts`` files, then one row that ends all windows and timers."""
    folder.mkdir(parents=True, exist_ok=True)
    size = -(-len(rows) // parts)
    chunks = [rows[i : i + size] for i in range(0, len(rows), size)]
    if flush:
        # both sides need it: the watermark of a join is the smaller of its inputs'
        chunks.append([event(10**9 + i, FLUSH_USER, kind, FLUSH_MS, i % 2) for i, kind in enumerate(["click", "purchase"])])
    for number, chunk in enumerate(chunks):
        columns = {f.name: pa.array([r[f.name] for r in chunk]).cast(f.type) for f in ARROW}
        pq.write_table(pa.table(columns, schema=ARROW), folder / f"part-{number}.parquet")
    return str(folder)


def open_stream(spark, path):
    return parquet_stream(spark, path, _parse_datatype_string(SCHEMA), max_files_per_trigger=1)


def drain(df, mode="append"):
    """Run a stream until its input is used up and return all emitted rows."""
    name = f"out_{uuid.uuid4().hex}"
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    spark = df.sparkSession
    rows = spark.table(name).collect()
    spark.sql(f"DROP VIEW {name}")
    return rows


def as_set(rows, *columns):
    found = sorted((tuple(r[c] for c in columns) for r in rows), key=repr)
    return found
