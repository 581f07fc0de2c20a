"""Socket and Kafka sources. Both need an outside service; Kafka also needs its connector jar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Text lines from a socket, in ``line``. Not replayable, so for trying things out only."""
    stream = spark.readStream.format("socket").option("host", host).option("port", port).load()
    return stream.select(F.col("value").alias("line"))


def kafka_source_options(
    servers: str, topic: str = "clicks", group_id: str | None = None, starting: str = "latest"
) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if group_id:
        options["kafka.group.id"] = group_id
    return options


def kafka_lines(spark: SparkSession, servers: str, topic: str = "clicks", **options: str) -> DataFrame:
    """Message values of a topic as text, in ``line``."""
    stream = spark.readStream.format("kafka").options(**kafka_source_options(servers, topic, **options)).load()
    return stream.select(F.col("value").cast("string").alias("line"))
