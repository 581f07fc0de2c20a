"""Written intermediate tables in the shared folder, and the place of each row in a global order."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import remove_folder, shared_folder


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` written to the shared folder and read again: later jobs neither repeat it nor depend on its executors."""
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def dropped(*frames: DataFrame) -> None:
    """Remove the files of frames that :func:`stored` wrote, when all that is made of them is stored; other files stay."""
    for frame in frames:
        for folder in {f.rpartition("/")[0] for f in frame.inputFiles()}:
            remove_folder(folder.rpartition("/")[2])


def written_order(frame: DataFrame) -> list[Column]:
    """Columns that sort the rows of a frame as Spark wrote them: by the number of the file, its name, and the place in it.

    Reading packs files by their size, so the rows themselves come in another order. A frame that does not come from
    files (or has a column ``_metadata`` of its own) is in the order of its partitions.
    """
    name, place = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    try:
        frame.select(name, place).schema  # noqa: B018
    except AnalysisException:
        return [F.monotonically_increasing_id()]
    number = F.regexp_extract(name, "^part-(\\d+)", 1).try_cast("long")
    return [number, name, place]


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1_000) -> Iterator[None]:
    """Jobs that run inside hand texts to Python in batches of so many rows, which both sides hold in memory."""
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


def few_rows(spark: SparkSession, rows: int = 1_000) -> None:
    """From now on texts go to Python in batches of so many rows at most, also those of frames that run later."""
    if not 0 < int(spark.conf.get(_BATCH_ROWS)) <= rows:
        spark.conf.set(_BATCH_ROWS, str(rows))


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def lean(task: Task) -> Task:
    """``task`` for ``mapInArrow``, giving freed memory back at its end: workers live on through the steps that follow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # the C library of Linux
            trim(0)

    return run


def released(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps: Spark drops them when the driver's garbage is collected.

    The scheduler holds on to its last job, so a job of one row comes after that of the step.
    """
    gc.collect()
    spark.range(1).count()
    spark.sparkContext._jvm.System.gc()


def numbered(frame: DataFrame, *order: Column, name: str = "rank", purpose: str = "ranks") -> DataFrame:
    """``frame`` with the 0-based place of each row in a total order, by a range sort and per-task offsets.

    Tasks count their rows by themselves; only one row per task meets to make the offsets. Sort ties get places in no
    stated order. The sorted rows are written once, so that places stay what they are.
    """
    sorted_rows = stored(frame.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()), purpose)
    task = F.shiftrightunsigned("__at", 33)
    sizes = sorted_rows.groupBy(task.alias("__task")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__task", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    place = F.col("__offset") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    joined = sorted_rows.withColumn("__task", task).join(offsets, "__task")
    return joined.select(*(F.col(f"`{c}`") for c in frame.columns), place.alias(name))


#: Bits of the filter that :func:`likely` sends to all tasks, whatever the number of ids.
FILTER_BITS = 1 << 24


def likely(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` is in ``ids`` (doc_id), and some others that a later join leaves out.

    A Bloom filter of a fixed size, two bits an id, is sent to where the documents lie; only what passes is moved. With
    far more ids than bits it lets everything through, and the join that follows does all the work.
    """
    bits = [F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(FILTER_BITS)).alias("bit") for seed in (1, 2)]
    placed = ids.select(F.explode(F.array(*bits)).alias("bit"))
    one = F.expr("shiftleft(1L, CAST(bit % 64 AS INT))")
    words = placed.groupBy(F.floor(F.col("bit") / 64).alias("word")).agg(F.bit_or(one).alias("set")).toArrow()
    held = np.zeros(FILTER_BITS // 64, np.uint64)
    held[words.column("word").to_numpy()] = words.column("set").to_numpy().view(np.uint64)
    shipped = docs.sparkSession.sparkContext.broadcast(held)

    def passing(batches):
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for name in ("__bit_1", "__bit_2"):
                at = batch.column(name).to_numpy()
                keep &= (shipped.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0
            yield batch.drop_columns(["__bit_1", "__bit_2"]).filter(pa.array(keep))

    tagged = docs.withColumns({f"__bit_{i + 1}": b for i, b in enumerate(bits)})
    return tagged.mapInArrow(lean(passing), docs.schema)
