"""Flat token files without an index, and the counts of their documents by a scan for end-of-document ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import files
from tidemark.llm.tables import stored
from tidemark.llm.tokens import encoder
from tidemark.llm.words import slices

BLOCK_BYTES = 1 << 20
_GROUP = 1024  # blocks whose sums are first put together


def write(docs: DataFrame, tokenizer: str, end_id: int, dtype: str = "<u2", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every text where it lies into flat files of ids, ``end_id`` behind each document, and nothing else.

    Returns a written table ``address, size`` (bytes), ``doc_ids``: what went into each file, in order, for those who
    want to name the documents again; the scan does not use it. Texts never yield ``end_id`` if that is a special token:
    special tokens' strings are ordinary text. Raises OverflowError if an id does not fit ``dtype``.
    """
    base = files.folder(docs.sparkSession, "flat")
    most = np.iinfo(np.dtype(dtype)).max
    if end_id > most:
        raise OverflowError(f"id {end_id} does not fit {dtype}")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, special_as_text=True).encode
        address, out, size, doc_ids = None, None, 0, []
        for batch in batches:
            for part in slices(batch, "text"):
                if out is None:
                    address, out = files.created(base, ".ids")
                ids = encode(part.column("text")).ended(end_id).ids
                if len(ids) and ids.max() > most:
                    raise OverflowError(f"id {ids.max()} does not fit {dtype}")
                size += out.write(ids.astype(dtype).tobytes())
                doc_ids.append(part.column("doc"))
        if out is not None:
            out.close()
            held = pa.concat_arrays(doc_ids)
            lists = pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held)
            yield pa.RecordBatch.from_arrays([pa.array([address]), pa.array([size], pa.int64()), lists], ["address", "size", "doc_ids"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
    return stored(rows.mapInArrow(task, "address string, size long, doc_ids array<long>"), "flat-manifest")


def scan(addresses: DataFrame, end_id: int, dtype: str = "<u2", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``address, ordinal, start, n_tokens`` of each document in flat files given as ``address, size``.

    Files are cut into blocks that any task may search; ``start`` and ``n_tokens`` count ids, without the end id. A
    block's first document began in an earlier block: exclusive prefix scans over the blocks of a file (a sum of the
    documents that ended, a maximum of the place of the last end) stitch it together; blocks are first put together in
    groups, so that a huge file isn't one task's window. Ids behind the last end id are one more document; an empty
    file has none.
    """
    width = np.dtype(dtype).itemsize
    step = max(1, block_bytes // width)
    blocks = addresses.where("size > 0").select(
        "address", (F.col("size") / width).cast("long").alias("n"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") / width - 1) / step))).alias("block"),
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            address, file, ends = None, None, []
            for row in batch.to_pylist():
                if row["address"] != address:
                    address, file = row["address"], files.opened(row["address"])
                first = row["block"] * step
                data = file.read_at(min(step, row["n"] - first) * width, first * width)
                ends.append(np.flatnonzero(np.frombuffer(data, dtype) == end_id) + first)
            offsets = np.concatenate(([0], np.cumsum([len(e) for e in ends])))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([*ends, []]).astype(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "ends"])

    width_tasks = int(addresses.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    searched = stored(
        blocks.repartitionByRange(width_tasks, "address", "block").mapInArrow(task, "address string, n long, block long, ends array<long>"),
        "flat-ends",
    )
    sums = searched.select(
        "address", "block", F.floor(F.col("block") / _GROUP).alias("group"),
        F.size("ends").cast("long").alias("ended"), F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(-1)).alias("last"),
    )
    groups = sums.groupBy("address", "group").agg(F.sum("ended").alias("g_ended"), F.max("last").alias("g_last"))
    over_groups = Window.partitionBy("address").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(
        "address", "group", F.coalesce(F.sum("g_ended").over(over_groups), F.lit(0)).alias("g_ended"),
        F.coalesce(F.max("g_last").over(over_groups), F.lit(-1)).alias("g_last"),
    )
    inside = Window.partitionBy("address", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.join(groups, ["address", "group"]).select(
        "address", "block",
        (F.col("g_ended") + F.coalesce(F.sum("ended").over(inside), F.lit(0))).alias("ended"),
        F.greatest("g_last", F.coalesce(F.max("last").over(inside), F.lit(-1))).alias("last"),
    )
    stitched = searched.join(before, ["address", "block"])
    at_end = (F.col("block") + 1) * step >= F.col("n")
    tail = F.when(at_end & (F.coalesce(F.try_element_at("ends", F.lit(-1)), F.col("last")) < F.col("n") - 1), F.array("n")).otherwise(F.array().cast("array<long>"))
    every = stitched.withColumn("ends", F.concat("ends", tail)).select("address", "ended", "last", "ends", F.posexplode("ends").alias("k", "end"))
    start = F.when(F.col("k") == 0, F.col("last")).otherwise(F.try_element_at("ends", F.col("k"))) + 1
    return every.select("address", (F.col("ended") + F.col("k")).alias("ordinal"), start.alias("start"), (F.col("end") - start).alias("n_tokens"))


def named(counts: DataFrame, written: DataFrame) -> DataFrame:
    """``counts`` with ``doc_id``, from what :func:`write` returned."""
    ids = written.select("address", F.posexplode("doc_ids").alias("ordinal", "doc_id"))
    return counts.join(ids.withColumn("ordinal", F.col("ordinal").cast("long")), ["address", "ordinal"], "left")
