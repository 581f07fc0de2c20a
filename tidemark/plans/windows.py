"""Event-time windows, late data, OVER windows, timers and periodic counts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.operators import late, over, timers, windows
from tidemark.plans.registry import query, table
from tidemark.plans.rows import clicks, delayed_arrival

HOUR, DAY = timedelta(hours=1), timedelta(days=1)


def _tumble_sql(key: str) -> str:
    return f"""SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
                      time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, {key}, count(*) AS cnt
               FROM events GROUP BY ALL"""


def _hop_sql(key: str) -> str:
    return f"""WITH h AS (SELECT unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 1 DAY]) AS s, {key} FROM events)
               SELECT CAST(s AS TIMESTAMP) AS window_start, CAST(s + INTERVAL 2 DAY AS TIMESTAMP) AS window_end, {key},
                      count(*) AS cnt
               FROM h GROUP BY ALL"""


@query("tumble_user_count", _tumble_sql("user_id"))
def tumble_user_count(spark, sf):
    return windows.tumble_count(table(spark, sf, "events"), "ts", DAY, ["user_id"])


@query("url_view_count", _tumble_sql("event_type"))
def url_view_count(spark, sf):
    return windows.url_view_count(table(spark, sf, "events"), "ts", DAY, "event_type")


@query("manual_tumble_count", _tumble_sql("event_type"))
def manual_tumble_count(spark, sf):
    """Window state that a program keeps by hand is an ordinary window here; same rows as ``url_view_count``."""
    return windows.tumble_count(table(spark, sf, "events"), "ts", DAY, ["event_type"])


@query(
    "sql_tumble_end",
    """SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, count(*) AS cnt
       FROM events GROUP BY ALL""",
)
def sql_tumble_end(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("clicks_table")
    return spark.sql(
        """SELECT user_id, window.end AS window_end, count(1) AS cnt
           FROM clicks_table GROUP BY user_id, window(ts, '1 day')"""
    )


@query("tvf_tumble", _tumble_sql("user_id"))
def tvf_tumble(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("clicks_table")
    return spark.sql(
        """SELECT window.start AS window_start, window.end AS window_end, user_id, count(1) AS cnt
           FROM clicks_table GROUP BY window(ts, '1 day'), user_id"""
    )


@query("tvf_hop", _hop_sql("user_id"))
def tvf_hop(spark, sf):
    return windows.hop_count(table(spark, sf, "events"), "ts", DAY, 2 * DAY, ["user_id"])


@query("sliding_url_count", _hop_sql("event_type"))
def sliding_url_count(spark, sf):
    return windows.hop_count(table(spark, sf, "events"), "ts", DAY, 2 * DAY, ["event_type"])


@query(
    "tvf_cumulate",
    """WITH c AS (SELECT date_trunc('day', ts) AS s, ts, user_id, unnest([6, 12, 18, 24]) AS h FROM events)
       SELECT CAST(s AS TIMESTAMP) AS window_start, CAST(s + to_hours(h) AS TIMESTAMP) AS window_end, user_id, count(*) AS cnt
       FROM c WHERE ts < s + to_hours(h) GROUP BY ALL""",
)
def tvf_cumulate(spark, sf):
    return windows.cumulate_count(table(spark, sf, "events"), "ts", 6 * HOUR, DAY, ["user_id"])


@query(
    "sliding_pv_uv",
    """WITH h AS (SELECT unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 1 DAY]) AS s, user_id FROM events)
       SELECT CAST(s AS TIMESTAMP) AS window_start, CAST(s + INTERVAL 2 DAY AS TIMESTAMP) AS window_end,
              count(*) AS pv, count(DISTINCT user_id) AS uv,
              CAST(count(*) // count(DISTINCT user_id) AS DOUBLE) AS ratio
       FROM h GROUP BY s""",
)
def sliding_pv_uv(spark, sf):
    return windows.pv_uv(table(spark, sf, "events"), "ts", 2 * DAY, DAY, "user_id")


@query(
    "window_uv",
    """SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
              time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, count(DISTINCT user_id) AS uv
       FROM events GROUP BY ALL""",
)
def window_uv(spark, sf):
    return windows.window_uv(table(spark, sf, "events"), "ts", DAY, "user_id")


@query(
    "count_window_avg_ts",
    """WITH n AS (SELECT user_id, (epoch_us(ts) // 1000) AS ms,
                         (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 5 AS group_no FROM events)
       SELECT user_id, group_no, CAST(sum(ms) // count(*) AS BIGINT) AS avg_ts
       FROM n GROUP BY user_id, group_no HAVING count(*) = 5""",
)
def count_window_avg_ts(spark, sf):
    result = windows.count_window_average(clicks(spark, sf), ["user"], ["event_id"], "timestamp", 5)
    return result.withColumn("user", F.col("user").cast("long")).withColumnRenamed("user", "user_id")


_LATE = """
    WITH a AS (SELECT event_id, user_id, ts, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
                      (epoch_us(ts) // 1000000) + (event_id * 37) % 50 * 180 AS arrival FROM events),
         s AS (SELECT *, max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM a),
         l AS (SELECT event_id, user_id, ts, window_start, window_start + INTERVAL 1 HOUR AS window_end,
                      CASE WHEN seen >= window_start + INTERVAL 120 MINUTE THEN 'late'
                           WHEN seen >= window_start + INTERVAL 90 MINUTE THEN 'refire' ELSE 'on_time' END AS lateness FROM s)
"""


def _classified(spark, sf):
    arrivals = table(spark, sf, "events").select("event_id", "user_id", "ts", delayed_arrival().alias("arrival"))
    half = timedelta(minutes=30)
    return late.classify(arrivals, "ts", ["arrival", "event_id"], HOUR, half, half)


@query(
    "late_window_counts",
    f"""{_LATE} SELECT window_start, window_end, user_id, count(*) AS cnt,
                       count(*) FILTER (WHERE lateness = 'refire') AS refires
        FROM l WHERE lateness <> 'late' GROUP BY ALL""",
)
def late_window_counts(spark, sf):
    return late.window_counts(_classified(spark, sf), ["user_id"])


@query(
    "late_side_output",
    f"{_LATE} SELECT event_id, user_id, ts, window_start, window_end FROM l WHERE lateness = 'late'",
)
def late_side_output(spark, sf):
    return late.side_output(_classified(spark, sf)).drop("arrival")


_OVER_AVG = """
    SELECT event_id, user_id, avg((epoch_us(ts) // 1000)) OVER
        (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS avg_ts
    FROM events
"""


def _over_average(spark, sf):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", millis.alias("ms"))
    averaged = over.average_of_last(events, ["user_id"], ["ts", "event_id"], "ms", 3)
    return averaged.select("event_id", "user_id", "avg_ts")


@query("over_avg_rows", _OVER_AVG)
def over_avg_rows(spark, sf):
    return _over_average(spark, sf)


@query("stream_over_rows", _OVER_AVG)
def stream_over_rows(spark, sf):
    """Batch twin of ``processors.LastRows``."""
    return _over_average(spark, sf)


@query(
    "over_count_max_named",
    """SELECT event_id, user_id, count(event_type) OVER w AS cnt, max(ts) OVER w AS max_ts FROM events
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def over_count_max_named(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    result = over.count_and_max_of_last(events, ["user_id"], ["ts", "event_id"], "event_type", "ts", 2)
    return result.select("event_id", "user_id", "cnt", "max_ts")


@query(
    "event_time_timers",
    """SELECT user_id, ts AS at, 'arrival' AS kind FROM events
       UNION ALL SELECT DISTINCT user_id, ts + INTERVAL 10 SECOND, 'fire' FROM events""",
)
def event_time_timers(spark, sf):
    return timers.event_time_timers(table(spark, sf, "events"), "user_id", "ts")


@query(
    "periodic_pv",
    """WITH RECURSIVE e AS (SELECT user_id, epoch_us(ts) // 1000 AS ms FROM events),
       fires AS (
           SELECT user_id, min(ms) + 604800000 AS fire_ts FROM e GROUP BY user_id
           UNION ALL
           SELECT f.user_id, min(e.ms) + 604800000 FROM fires f JOIN e ON e.user_id = f.user_id AND e.ms > f.fire_ts
           GROUP BY f.user_id, f.fire_ts)
       SELECT f.user_id, f.fire_ts, count(*) AS cnt
       FROM fires f JOIN e ON e.user_id = f.user_id AND e.ms <= f.fire_ts GROUP BY f.user_id, f.fire_ts""",
)
def periodic_pv(spark, sf):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    events = table(spark, sf, "events").select("user_id", millis.alias("timestamp"))
    return timers.periodic_count(events, "user_id", "timestamp", 7 * DAY)
