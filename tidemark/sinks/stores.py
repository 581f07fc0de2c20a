"""Sinks for outside stores, and what each of them should receive.

``foreachBatch`` may repeat a batch after a failure, so every writer here is keyed by the batch id.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.keyed import latest_value
from tidemark.operators.ordered import floor_div, number_rows

BatchWriter = Callable[[DataFrame, int], None]


def kafka_messages(df: DataFrame, value: Column | None = None) -> DataFrame:
    """The ``value`` column a Kafka sink expects; by default the row as JSON."""
    return df.select((F.to_json(F.struct(*df.columns)) if value is None else value.cast("string")).alias("value"))


def kafka_sink_options(servers: str, topic: str = "events") -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def jdbc_options(url: str, table: str = "clicks", driver: str | None = None, batch_size: int = 1000) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size)}
    if driver:
        options["driver"] = driver
    return options


def jdbc_rows(df: DataFrame, user: str = "user", url: str = "url", timestamp: str = "timestamp") -> DataFrame:
    """The three insert parameters, all as text."""
    return df.select(*[F.col(c).cast("string").alias(n) for n, c in (("user", user), ("url", url), ("timestamp", timestamp))])


def jdbc_writer(options: dict[str, str], connections: int = 16) -> BatchWriter:
    """Insert each micro-batch over at most ``connections`` connections, with its batch id.

    The batch id column lets the table reject or drop a repeated batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id))
        rows.coalesce(connections).write.format("jdbc").options(**options).mode("append").save()

    return write


def upsert_writer(folder: str, keys: Sequence[str], value: str, order: Sequence[str]) -> BatchWriter:
    """Keep the latest ``value`` per key in a versioned parquet table, one version per micro-batch.

    Version n is version n-1 merged with batch n, so repeating a batch rewrites the same version.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*keys, value, *order)
        if batch_id > 0:
            rows = rows.unionByName(batch.sparkSession.read.schema(rows.schema).parquet(version(folder, batch_id - 1)))
        best = F.max(F.struct(*order, value)).alias("_best")
        latest = rows.groupBy(*keys).agg(best).select(*keys, F.col("_best")[value].alias(value), *[F.col("_best")[c].alias(c) for c in order])
        latest.write.mode("overwrite").parquet(version(folder, batch_id))

    return write


def version(folder: str, batch_id: int) -> str:
    return f"{folder}/version={batch_id}"


def index_documents(df: DataFrame, user: str = "user", url: str = "url", index: str = "events") -> DataFrame:
    """One ``{user: url}`` JSON document per row with the index it belongs to."""
    document = F.to_json(F.create_map(F.col(user).cast("string"), F.col(url)))
    return df.select(F.lit(index).alias("index"), document.alias("document"))


def buffered_batches(df: DataFrame, seq: str, size: int = 10, out: str = "batch_no") -> DataFrame:
    """Group rows into consecutive batches of ``size`` in ``seq`` order; the last may be shorter."""
    numbered = number_rows(df, [], [seq], "_row")
    return numbered.withColumn(out, floor_div(F.col("_row") - 1, size)).drop("_row")


def buffered_writer(write_rows: Callable[[DataFrame], None], seq: str, size: int = 10) -> BatchWriter:
    """Number each micro-batch's rows into batches of ``size`` before handing them on.

    Rows that do not fill a batch need no buffer of ours: source offsets already guarantee them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_rows(buffered_batches(batch, seq, size).withColumn("batch_id", F.lit(batch_id)))

    return write


def carried_batches_writer(write_rows: Callable[[DataFrame, int], None], folder: str, seq: str, size: int = 10) -> BatchWriter:
    """Hand on full batches of exactly ``size`` rows, whatever the micro-batches are; the rest waits for the next one.

    Rows are numbered in ``seq`` order through all micro-batches (which come in that order); ``write_rows`` gets the rows of
    the batches that are full now, with ``batch_no``, and the micro-batch's id. Fewer than ``size`` rows and their number
    are carried below ``folder`` by batch id, so a repeated micro-batch hands on the same batches, and a restarted query
    goes on where it was. ``waiting_rows`` are those that no batch has had yet.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, held = batch.sparkSession, batch.persist()
        try:
            total = spark.read.parquet(f"{folder}/total/batch={batch_id - 1}").first()["total"] if batch_id else 0
            numbered = number_rows(held, [], [seq], "_row").withColumn("_row", F.col("_row") + F.lit(total).cast("long"))
            if batch_id:
                numbered = numbered.unionByName(spark.read.schema(numbered.schema).parquet(f"{folder}/rest/batch={batch_id - 1}"))
            now = total + held.count()
            full = now - now % size
            numbered = numbered.persist()
            numbered.where(F.col("_row") > full).write.mode("overwrite").parquet(f"{folder}/rest/batch={batch_id}")
            ready = numbered.where(F.col("_row") <= full)
            write_rows(ready.withColumn("batch_no", floor_div(F.col("_row") - 1, size)).drop("_row"), batch_id)
            spark.range(1).select(F.lit(now).cast("long").alias("total")).write.mode("overwrite").parquet(f"{folder}/total/batch={batch_id}")
            numbered.unpersist()
        finally:
            held.unpersist()

    return write


def waiting_rows(spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
    return spark.read.parquet(f"{folder}/rest/batch={batch_id}").drop("_row")


def bucketed_writer(folder: str, keys: Sequence[str], value: str, order: Sequence[str], buckets: int = 64) -> BatchWriter:
    """Keep the latest ``value`` per key in a table of hash buckets, of which a micro-batch rewrites those it touches.

    ``folder/data/version=<id>/bucket=<b>`` are files of batch ``id``; ``folder/manifest/batch=<id>`` says which version of
    each bucket is valid after it, so readers see whole batches, files of untouched buckets stay as they are, and a repeated
    batch starts from the manifest before it and writes the same again. Versions that neither the last manifest nor the one
    before it names are removed. ``buckets`` must stay the same for a table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, columns = batch.sparkSession, list(dict.fromkeys([*keys, value, *order]))
        placed = batch.select(*columns, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")).persist()
        try:
            touched = {row["bucket"] for row in placed.select("bucket").distinct().collect()}  # at most `buckets` numbers
            valid = _manifest(spark, folder, batch_id - 1) if batch_id else {}
            old = [_bucket(folder, version, b) for b, version in valid.items() if b in touched]
            rows = placed
            if old:
                before = spark.read.schema(batch.select(*columns).schema).parquet(*old)
                rows = rows.unionByName(before.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")))
            best = F.max_by(F.struct(*[c for c in columns if c not in keys]), F.struct(*order)).alias("_best")
            latest = rows.groupBy("bucket", *keys).agg(best).select("bucket", *keys, "_best.*")
            latest.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/data/version={batch_id}")
            named = {**valid, **dict.fromkeys(touched, batch_id)}
            listed = spark.createDataFrame(sorted(named.items()), "bucket int, version long")
            listed.coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest/batch={batch_id}")
            older = _manifest(spark, folder, batch_id - 2) if batch_id > 1 else {}
            for b, version in older.items():  # repeating this batch needs the manifest before it, no older one
                if version not in (valid.get(b), named.get(b)):
                    _remove(spark, _bucket(folder, version, b))
        finally:
            placed.unpersist()

    return write


def _bucket(folder: str, version: int, bucket: int) -> str:
    return f"{folder}/data/version={version}/bucket={bucket}"


def _manifest(spark: SparkSession, folder: str, batch_id: int) -> dict[int, int]:
    return {r["bucket"]: r["version"] for r in spark.read.parquet(f"{folder}/manifest/batch={batch_id}").collect()}


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def read_bucketed(spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
    """The table as it is after micro-batch ``batch_id``."""
    paths = [_bucket(folder, version, b) for b, version in sorted(_manifest(spark, folder, batch_id).items())]
    return spark.read.parquet(*paths)


def read_upserted(spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
    return spark.read.parquet(version(folder, batch_id))


__all__ = [
    "bucketed_writer", "buffered_batches", "buffered_writer", "carried_batches_writer", "index_documents", "jdbc_options", "jdbc_rows", "jdbc_writer",
    "kafka_messages", "kafka_sink_options", "latest_value", "read_bucketed", "read_upserted", "upsert_writer", "version",
    "waiting_rows",
]
