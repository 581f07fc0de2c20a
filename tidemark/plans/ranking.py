"""Top-N queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import topn, windows
from tidemark.plans.registry import query, table
from tidemark.plans.windows import DAY

_TUMBLE_COUNTS = """
    SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
           user_id, count(*) AS cnt FROM events GROUP BY ALL
"""
_HOP_RANKED = """
    WITH h AS (SELECT unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 1 DAY]) AS s, event_type FROM events),
         c AS (SELECT CAST(s AS TIMESTAMP) AS window_start, CAST(s + INTERVAL 2 DAY AS TIMESTAMP) AS window_end, event_type,
                      count(*) AS cnt FROM h GROUP BY ALL),
         r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, event_type) AS row_num FROM c)
"""


@query(
    "topn_users",
    """SELECT user_id, cnt, row_number() OVER (ORDER BY cnt DESC, user_id) AS row_num
       FROM (SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id)
       QUALIFY row_number() OVER (ORDER BY cnt DESC, user_id) <= 2""",
)
def topn_users(spark, sf):
    return topn.top_keys(table(spark, sf, "events"), "user_id", 2)


@query(
    "window_topn_users",
    f"""WITH c AS ({_TUMBLE_COUNTS}),
             r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, user_id) AS row_num FROM c)
        SELECT * FROM r WHERE row_num <= 2""",
)
def window_topn_users(spark, sf):
    return topn.top_per_tumble(table(spark, sf, "events"), "ts", DAY, "user_id", 2)


@query("sliding_topn_urls", f"{_HOP_RANKED} SELECT * FROM r WHERE row_num <= 2")
def sliding_topn_urls(spark, sf):
    return topn.top_per_hop(table(spark, sf, "events"), "ts", DAY, 2 * DAY, "event_type", 2)


@query(
    "window_all_topn",
    f"""{_HOP_RANKED}
        SELECT window_end, string_agg('No.' || row_num || ' ' || event_type || ' views: ' || cnt, '; ' ORDER BY row_num) AS report
        FROM r WHERE row_num <= 2 GROUP BY window_end""",
)
def window_all_topn(spark, sf):
    ranked = topn.top_per_hop(table(spark, sf, "events"), "ts", DAY, 2 * DAY, "event_type", 2)
    return topn.describe_top(ranked, "event_type")


@query(
    "top2_table_agg",
    f"""WITH c AS ({_TUMBLE_COUNTS}),
             r AS (SELECT window_end, cnt AS value, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC) AS rank FROM c)
        SELECT * FROM r WHERE rank <= 2""",
)
def top2_table_agg(spark, sf):
    counts = windows.tumble_count(table(spark, sf, "events"), "ts", DAY, ["user_id"])
    return topn.top_values(counts.select("window_end", F.col("cnt")))
