"""Row transforms and data distribution."""

from __future__ import annotations

from datetime import timedelta

import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators import partitioning, rows
from tidemark.plans.registry import query, table

def arrival():
    """A disorderly but fixed arrival order."""
    return F.col("event_id") + F.pmod(F.col("event_id") * 37, F.lit(50))


def delayed_arrival():
    """Arrival by the clock, up to two and a half hours after the event: as disorderly at every scale."""
    return F.unix_seconds(F.col("ts").cast("timestamp")) + F.pmod(F.col("event_id") * 37, F.lit(50)) * 180


def clicks(spark, sf):
    """Events in the click shape: user, url, epoch milliseconds."""
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, sf, "events").select(
        "event_id", F.col("user_id").cast("string").alias("user"), F.col("event_type").alias("url"), millis.alias("timestamp")
    )


@query("map_project", "SELECT user_id FROM events")
def map_project(spark, sf):
    return rows.project(table(spark, sf, "events"), "user_id")


@query("filter_eq", "SELECT event_id, user_id, event_type FROM events WHERE event_type = 'click'")
def filter_eq(spark, sf):
    return rows.where_equal(table(spark, sf, "events"), "event_type", "click").select("event_id", "user_id", "event_type")


@query(
    "flatmap_fields",
    """SELECT unnest([CAST(user_id AS VARCHAR), event_type, CAST((epoch_us(ts) // 1000) AS VARCHAR)]) AS field FROM events""",
)
def flatmap_fields(spark, sf):
    return rows.flatmap_fields(clicks(spark, sf))


@query(
    "flatmap_concat",
    "SELECT concat_ws(' -- ', CAST(user_id AS VARCHAR), event_type, CAST((epoch_us(ts) // 1000) AS VARCHAR)) AS line FROM events",
)
def flatmap_concat(spark, sf):
    return rows.flatmap_concat(clicks(spark, sf))


@query(
    "flatmap_conditional",
    """SELECT event_type AS field FROM events WHERE user_id = 7
       UNION ALL SELECT CAST((epoch_us(ts) // 1000) AS VARCHAR) FROM events""",
)
def flatmap_conditional(spark, sf):
    return rows.flatmap_conditional(clicks(spark, sf), F.col("user") == "7")


@query("rich_map_length", "SELECT event_id, CAST(length(CAST(user_id AS VARCHAR)) AS INTEGER) AS user_length FROM events")
def rich_map_length(spark, sf):
    return clicks(spark, sf).select("event_id", F.length("user").alias("user_length"))


@query("rich_map_partitions", "SELECT event_id, CAST(length(CAST(user_id AS VARCHAR)) AS INTEGER) AS user_length FROM events")
def rich_map_partitions(spark, sf):
    def measure(opened: dict, batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"event_id": batch["event_id"], "user_length": batch["user"].str.len().astype("int32")})

    return rows.map_partitions(
        clicks(spark, sf).select("event_id", "user"), dict, measure, dict.clear, "event_id long, user_length int"
    )


@query("table_select_where", "SELECT user_id, event_type FROM events WHERE event_type = 'purchase' AND value > 50")
def table_select_where(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("clicks_table")
    spark.sql("SELECT user_id, event_type, value FROM clicks_table WHERE event_type = 'purchase'").createOrReplaceTempView(
        "purchases_table"
    )
    return spark.sql("SELECT user_id, event_type FROM purchases_table WHERE value > 50")


@query(
    "annotate_watermark",
    """WITH a AS (SELECT event_id, ts, event_id + (event_id * 37) % 50 AS arrival FROM events)
       SELECT event_id, ts,
              max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                - INTERVAL 2 SECOND AS watermark
       FROM a""",
)
def annotate_watermark(spark, sf):
    arrivals = table(spark, sf, "events").select("event_id", "ts", arrival().alias("arrival"))
    annotated = rows.annotate_watermark(arrivals, ["arrival", "event_id"], "ts", timedelta(seconds=2))
    return annotated.select("event_id", "ts", "watermark")


@query("part_shuffle", "SELECT event_id, user_id FROM events")
def part_shuffle(spark, sf):
    return partitioning.shuffle(table(spark, sf, "events").select("event_id", "user_id"), 16)


@query("part_rebalance", "SELECT event_id, user_id FROM events")
def part_rebalance(spark, sf):
    return partitioning.rebalance(table(spark, sf, "events").select("event_id", "user_id"), 16)


@query("part_rescale", "SELECT event_id, user_id FROM events")
def part_rescale(spark, sf):
    return partitioning.rescale(table(spark, sf, "events").select("event_id", "user_id"), 4)


@query(
    "part_even_placement",
    """SELECT s.strategy, 16::BIGINT AS partitions, count(*) AS placed, true AS even
       FROM events, (VALUES ('shuffle'), ('rebalance')) s(strategy) GROUP BY s.strategy""",
)
def part_even_placement(spark, sf):
    """Partitions that have rows after either way of dealing them, and whether none has more than its share and one a task."""
    events = table(spark, sf, "events").select("event_id")
    tasks = events.rdd.getNumPartitions()
    dealt = {"shuffle": partitioning.shuffle(events, 16), "rebalance": partitioning.rebalance(events, 16)}
    sizes = [partitioning.with_partition(df).groupBy("partition").count().withColumn("strategy", F.lit(s)) for s, df in dealt.items()]
    shape = sizes[0].unionByName(sizes[1]).groupBy("strategy").agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("count").alias("placed"), F.max("count").alias("_most")
    )
    share = F.ceil(F.col("placed") / 16)
    return shape.select("strategy", "partitions", "placed", (F.col("_most") <= share + tasks).alias("even"))


@query("part_broadcast_copies", "SELECT n_nationkey, CAST(unnest([0, 1, 2, 3]) AS INTEGER) AS subtask FROM nation")
def part_broadcast_copies(spark, sf):
    copies = partitioning.broadcast_copies(table(spark, sf, "nation").select("n_nationkey"), 4)
    return partitioning.with_partition(copies, "placed").select("n_nationkey", F.col("placed").alias("subtask"))


@query("part_global", "SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type")
def part_global(spark, sf):
    counts = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))
    return partitioning.single(counts)


@query("part_custom", "SELECT event_id, CAST(event_id % 2 AS INTEGER) AS \"partition\" FROM events")
def part_custom(spark, sf):
    placed = partitioning.custom(table(spark, sf, "events").select("event_id"), 2, F.col("event_id") % 2)
    return partitioning.with_partition(placed)
