"""Two-stream queries."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.operators import joins
from tidemark.plans.registry import query, table
from tidemark.plans.rows import delayed_arrival
from tidemark.plans.windows import DAY, HOUR


def _side(spark, sf, event_type: str, prefix: str):
    """One event type as a stream of its own, with prefixed columns."""
    events = table(spark, sf, "events").where(F.col("event_type") == event_type)
    return events.select(*[F.col(c).alias(f"{prefix}_{n}") for n, c in (("user", "user_id"), ("id", "event_id"), ("ts", "ts"))])


_PAIR = "p.user_id AS p_user, p.event_id AS p_id, p.ts AS p_ts, c.user_id AS c_user, c.event_id AS c_id, c.ts AS c_ts"
_P = "(SELECT * FROM events WHERE event_type = 'purchase') p"
_C = "(SELECT * FROM events WHERE event_type = 'click') c"


@query(
    "window_join",
    f"""SELECT date_trunc('day', p.ts)::TIMESTAMP AS window_start, (date_trunc('day', p.ts) + INTERVAL 1 DAY)::TIMESTAMP AS window_end,
               {_PAIR}
        FROM {_P} JOIN {_C} ON p.user_id = c.user_id AND date_trunc('day', p.ts) = date_trunc('day', c.ts)""",
)
def window_join(spark, sf):
    left, right = _side(spark, sf, "purchase", "p"), _side(spark, sf, "click", "c")
    return joins.window_join(left, right, ("p_user", "c_user"), ("p_ts", "c_ts"), DAY)


_DAY_OF = "date_trunc('day', ts)::TIMESTAMP AS window_start, (date_trunc('day', ts) + INTERVAL 1 DAY)::TIMESTAMP AS window_end"


@query(
    "window_cogroup",
    f"""SELECT user_id, {_DAY_OF}, CASE event_type WHEN 'purchase' THEN 'left' ELSE 'right' END AS side,
               row_number() OVER (PARTITION BY user_id, date_trunc('day', ts), event_type ORDER BY ts, event_id) - 1 AS position,
               event_id AS value
        FROM events WHERE event_type IN ('purchase', 'click')""",
)
def window_cogroup(spark, sf):
    events = table(spark, sf, "events")
    purchases, clicks = events.where("event_type = 'purchase'"), events.where("event_type = 'click'")
    return joins.window_cogroup(purchases, clicks, "user_id", "ts", ["ts", "event_id"], "event_id", DAY)


@query(
    "window_cogroup_counts",
    f"""SELECT user_id, {_DAY_OF}, count(*) FILTER (WHERE event_type = 'purchase') AS left_rows,
               count(*) FILTER (WHERE event_type = 'click') AS right_rows
        FROM events WHERE event_type IN ('purchase', 'click') GROUP BY ALL""",
)
def window_cogroup_counts(spark, sf):
    events = table(spark, sf, "events")
    purchases, clicks = events.where("event_type = 'purchase'"), events.where("event_type = 'click'")
    return joins.window_cogroup_counts(purchases, clicks, "user_id", "ts", DAY)


@query(
    "interval_join",
    f"""SELECT {_PAIR} FROM {_P} JOIN {_C} ON p.user_id = c.user_id
        AND c.ts BETWEEN p.ts - INTERVAL 5 HOUR AND p.ts + INTERVAL 10 HOUR""",
)
def interval_join(spark, sf):
    left, right = _side(spark, sf, "purchase", "p"), _side(spark, sf, "click", "c")
    return joins.interval_join(left, right, ("p_user", "c_user"), ("p_ts", "c_ts"), -5 * HOUR, 10 * HOUR)


@query(
    "bill_check",
    """SELECT a.user_id AS a_user, a.event_id AS a_id, a.ts AS a_ts, p.user_id AS p_user, p.event_id AS p_id, p.ts AS p_ts,
              CASE WHEN p.user_id IS NULL THEN 'platform_missing' WHEN a.user_id IS NULL THEN 'app_missing' ELSE 'success' END AS status
       FROM (SELECT * FROM events WHERE event_type = 'signup') a
       FULL JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
         ON a.user_id = p.user_id AND p.ts BETWEEN a.ts AND a.ts + INTERVAL 12 HOUR""",
)
def bill_check(spark, sf):
    app, platform = _side(spark, sf, "signup", "a"), _side(spark, sf, "purchase", "p")
    return joins.reconcile(app, platform, ("a_user", "p_user"), ("a_ts", "p_ts"), 12 * HOUR)


@query(
    "unbounded_join",
    """SELECT o_orderkey, o_custkey, l_linenumber, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def unbounded_join(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.unbounded_join(orders, items, ("o_orderkey", "l_orderkey")).drop("l_orderkey")


@query(
    "connect_map",
    """SELECT 'Integer: ' || CAST(l_linenumber AS VARCHAR) AS value FROM lineitem
       UNION ALL SELECT 'Long: ' || CAST(o_orderkey AS VARCHAR) FROM orders""",
)
def connect_map(spark, sf):
    return joins.connect_map(
        table(spark, sf, "lineitem"),
        table(spark, sf, "orders"),
        F.concat(F.lit("Integer: "), F.col("l_linenumber").cast("string")),
        F.concat(F.lit("Long: "), F.col("o_orderkey").cast("string")),
    )


@query(
    "union_streams",
    """SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'
       UNION ALL SELECT event_id, user_id, ts FROM events WHERE event_type = 'view'""",
)
def union_streams(spark, sf):
    events = table(spark, sf, "events")
    clicks, views = (events.where(F.col("event_type") == t).select("event_id", "user_id", "ts") for t in ("click", "view"))
    return joins.union_streams(clicks, views)


_ARRIVED = "(epoch_us(ts) // 1000000) + (event_id * 37) % 50 * 180"


@query(
    "union_watermark",
    f"""WITH u AS (SELECT event_id, ts, {_ARRIVED} AS arrival, CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS lane
                   FROM events WHERE event_type IN ('click', 'view', 'purchase')),
             m AS (SELECT event_id, ts, lane, max(ts) FILTER (WHERE lane = 0) OVER w AS m0, max(ts) FILTER (WHERE lane = 1) OVER w AS m1,
                          max(ts) FILTER (WHERE lane = 2) OVER w AS m2
                   FROM u WINDOW w AS (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT event_id, ts, lane::INTEGER AS lane,
               CASE WHEN m0 IS NOT NULL AND m1 IS NOT NULL AND m2 IS NOT NULL THEN least(m0, m1, m2) - INTERVAL 2 SECOND END AS watermark
        FROM m""",
)
def union_watermark(spark, sf):
    """Three inputs that arrive out of order: what each row meets is the smallest of their watermarks."""
    events = table(spark, sf, "events").select("event_id", "event_type", "ts", delayed_arrival().alias("arrival"))
    frames = [events.where(F.col("event_type") == kind).drop("event_type") for kind in ("click", "view", "purchase")]
    marked = joins.union_watermark(frames, ["arrival", "event_id"], "ts", timedelta(seconds=2))
    return marked.select("event_id", "ts", "lane", "watermark")


@query(
    "split_route",
    """SELECT event_id, user_id, CASE event_type WHEN 'click' THEN 'clicks' WHEN 'purchase' THEN 'purchases' ELSE 'main' END AS route
       FROM events""",
)
def split_route(spark, sf):
    routes = {"clicks": F.col("event_type") == "click", "purchases": F.col("event_type") == "purchase"}
    return joins.route(table(spark, sf, "events"), routes).select("event_id", "user_id", "route")
