"""Keyed aggregates, running and final, and the changelog."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.operators import changelog, keyed, rows, states
from tidemark.operators.ordered import Run
from tidemark.plans.registry import query, table
from tidemark.plans.rows import clicks

_WORDS = """
    SELECT doc_id, word FROM (SELECT doc_id, unnest(string_split(replace(lower(text), chr(10), ' '), ' ')) AS word FROM documents)
    WHERE word <> ''
"""


@query("wordcount", f"SELECT word, count(*) AS cnt FROM ({_WORDS}) GROUP BY word")
def wordcount(spark, sf):
    lines = rows.lines(table(spark, sf, "documents").select("text"))
    return keyed.count_by(rows.words(lines, lowercase=True), ["word"])


@query(
    "running_count",
    """SELECT event_id, event_type,
              count(*) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS cnt
       FROM events""",
)
def running_count(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    return keyed.running_count(events, ["event_type"], ["event_id"])


@query(
    "keyed_max_field",
    """SELECT user_id, arg_min(event_type, event_id) AS event_type, max(value) AS value FROM events GROUP BY user_id""",
)
def keyed_max_field(spark, sf):
    return keyed.max_field(table(spark, sf, "events"), ["user_id"], "value", ["event_id"], ["event_type"])


@query(
    "keyed_max_field_running",
    """SELECT event_id, user_id, max(value) OVER w AS max_value, first_value(event_type) OVER w AS first_event_type
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)""",
)
def keyed_max_field_running(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    result = keyed.running_max_field(events, ["user_id"], "value", ["event_id"], ["event_type"])
    return result.select("event_id", "user_id", "max_value", "first_event_type")


@query(
    "keyed_maxby_row",
    """SELECT user_id, event_id, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) = 1""",
)
def keyed_maxby_row(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    return keyed.max_row(events, ["user_id"], "value", "event_id")


@query(
    "reduce_click_count",
    """SELECT event_id, user_id,
              count(*) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS cnt
       FROM events""",
)
def reduce_click_count(spark, sf):
    return keyed.running_count(table(spark, sf, "events").select("event_id", "user_id"), ["user_id"], ["event_id"])


_RUNNING = """
    SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS cnt
    FROM events
"""


@query(
    "most_active_user",
    f"""WITH r AS ({_RUNNING}),
        b AS (SELECT event_id, user_id, max({{'cnt': cnt, 'at': event_id, 'leader': user_id}}) OVER
                  (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS best FROM r)
        SELECT event_id, user_id, best.leader AS leader, best.cnt AS leader_cnt FROM b""",
)
def most_active_user(spark, sf):
    return keyed.most_active_running(table(spark, sf, "events"), "user_id", "event_id")


@query(
    "most_active_user_final",
    """SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id
       ORDER BY count(*) DESC, max(event_id) DESC LIMIT 1""",
)
def most_active_user_final(spark, sf):
    return keyed.most_active(table(spark, sf, "events"), "user_id", "event_id")


@query("sql_group_count", "SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id")
def sql_group_count(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("clicks_table")
    return spark.sql("SELECT user_id, count(1) AS cnt FROM clicks_table GROUP BY user_id")


@query(
    "latest_value_per_key",
    "SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id",
)
def latest_value_per_key(spark, sf):
    return keyed.latest_value(table(spark, sf, "events"), ["user_id"], "event_type", ["ts", "event_id"])


@query(
    "changelog_group_count",
    f"""WITH r AS ({_RUNNING})
        SELECT event_id, user_id, CAST(0 AS INTEGER) AS part, CASE WHEN cnt = 1 THEN '+I' ELSE '-U' END AS op,
               CASE WHEN cnt = 1 THEN 1 ELSE cnt - 1 END AS cnt FROM r
        UNION ALL SELECT event_id, user_id, CAST(1 AS INTEGER), '+U', cnt FROM r WHERE cnt > 1""",
)
def changelog_group_count(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id")
    return changelog.count_changelog(events, ["user_id"], ["event_id"])


@query(
    "changelog_topn",
    """WITH r AS (SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY event_id) AS cnt FROM events),
            t AS (SELECT event_id AS moment FROM r QUALIFY row_number() OVER (PARTITION BY cnt ORDER BY event_id) <= 3),
            l AS (SELECT t.moment, r.user_id, max(r.cnt) AS cnt, max(r.event_id) AS reached
                  FROM t JOIN r ON r.event_id <= t.moment GROUP BY t.moment, r.user_id),
            p AS (SELECT moment, user_id, cnt, row_number() OVER (PARTITION BY moment ORDER BY cnt DESC, reached) AS row_num
                  FROM l QUALIFY row_num <= 3),
            c AS (SELECT *, lag({'u': user_id, 'n': cnt}) OVER (PARTITION BY row_num ORDER BY moment) AS old FROM p),
            d AS (SELECT * FROM c WHERE old IS NULL OR old.u <> user_id OR old.n <> cnt)
       SELECT moment AS event_id, row_num, 0::INTEGER AS part, CASE WHEN old IS NULL THEN '+I' ELSE '-U' END AS op,
              CASE WHEN old IS NULL THEN user_id ELSE old.u END AS user_id, CASE WHEN old IS NULL THEN cnt ELSE old.n END AS cnt FROM d
       UNION ALL SELECT moment, row_num, 1::INTEGER, '+U', user_id, cnt FROM d WHERE old IS NOT NULL""",
)
def changelog_topn(spark, sf):
    """The three users with the most events, place by place, as they change."""
    return changelog.top_n_changelog(table(spark, sf, "events").select("event_id", "user_id"), "user_id", "event_id", 3)


@query(
    "expiring_count",
    """WITH g AS (SELECT event_id, user_id, ts, row_number() OVER w AS k,
                         ts >= lag(ts) OVER w + INTERVAL 2 DAY AS gone FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
            s AS (SELECT *, sum(CASE WHEN gone THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY k) AS run FROM g)
       SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id, run ORDER BY k) AS cnt FROM s""",
)
def expiring_count(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return states.expiring_count(events, ["user_id"], ["ts", "event_id"], "ts", timedelta(days=2))


_WEIGHT = "(event_id % 3)"


@query(
    "changelog_weighted_avg",
    f"""WITH r AS (SELECT event_id, user_id, CAST(sum(event_id * {_WEIGHT}) OVER w AS BIGINT) AS n,
                          CAST(sum({_WEIGHT}) OVER w AS BIGINT) AS d
                   FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
             v AS (SELECT event_id, user_id, CASE WHEN d > 0 THEN n // d END AS average FROM r),
             c AS (SELECT *, lag(average) OVER w AS old, row_number() OVER w AS k FROM v WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
        SELECT event_id, user_id, CAST(0 AS INTEGER) AS part, CASE WHEN k = 1 THEN '+I' ELSE '-U' END AS op,
               CASE WHEN k = 1 THEN average ELSE old END AS average
        FROM c WHERE k = 1 OR old IS DISTINCT FROM average
        UNION ALL SELECT event_id, user_id, CAST(1 AS INTEGER), '+U', average FROM c WHERE k > 1 AND old IS DISTINCT FROM average""",
)
def changelog_weighted_avg(spark, sf):
    """A user aggregate as a changelog: the whole-number average of event ids, weighted 0, 1 or 2."""
    weight = F.col("event_id") % 3
    sums = {"n": Run("sum", F.col("event_id") * weight), "d": Run("sum", weight)}
    summed = keyed.running_reduce(table(spark, sf, "events").select("event_id", "user_id"), ["user_id"], ["event_id"], sums)
    averaged = summed.withColumn("average", F.when(F.col("d") > 0, F.expr("n div d")))
    return changelog.value_changelog(averaged, ["user_id"], ["event_id"], ["average"])


@query(
    "reduce_general",
    """SELECT event_id, user_id, CAST(sum(event_id) OVER w AS BIGINT) AS id_sum, max(value) OVER w AS value_max,
              min(event_type) OVER w AS type_min, first_value(ts) OVER w AS ts_first
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""",
)
def reduce_general(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    values = {
        "id_sum": Run("sum", F.col("event_id")),
        "value_max": Run("max", F.col("value")),
        "type_min": Run("min", F.col("event_type")),
        "ts_first": Run("first", F.col("ts")),
    }
    return keyed.running_reduce(events, ["user_id"], ["event_id"], values).select("event_id", "user_id", *values)


@query(
    "keyed_state_tour",
    """SELECT event_id, user_id, lag(event_type) OVER w AS value_url, row_number() OVER w AS list_size,
              998 + row_number() OVER w AS map_value,
              first_value(event_type) OVER w AS reduced_url, (epoch_us(ts) // 1000) AS reduced_ts,
              'count: ' || CAST(row_number() OVER w AS VARCHAR) AS aggregate
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""",
)
def keyed_state_tour(spark, sf):
    toured = states.keyed_state_tour(clicks(spark, sf), "user", ["event_id"])
    return toured.withColumn("user", F.col("user").cast("long")).withColumnRenamed("user", "user_id")
