"""Sequence patterns and behaviour rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import patterns, rules
from tidemark.plans.registry import query, table
from tidemark.plans.windows import DAY, HOUR
from tidemark.schemas import RULE

_RUNS = """
    WITH r AS (SELECT user_id, ts AS ts_1, lead(ts, 1) OVER w AS ts_2, lead(ts, 2) OVER w AS ts_3, event_type AS e1,
                      lead(event_type, 1) OVER w AS e2, lead(event_type, 2) OVER w AS e3
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
         m AS (SELECT user_id, ts_1, ts_2, ts_3 FROM r WHERE e1 = 'error' AND e2 = 'error' AND e3 = 'error')
"""


def _errors(spark, sf, times: int):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    return patterns.consecutive(events, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", times)


@query("cep_three_fails", f"{_RUNS} SELECT * FROM m")
def cep_three_fails(spark, sf):
    return _errors(spark, sf, 3)


@query(
    "cep_steps",
    """WITH r AS (SELECT user_id, ts AS ts_1, lead(ts, 1) OVER w AS ts_2, lead(ts, 2) OVER w AS ts_3, event_type AS e1,
                      lead(event_type, 1) OVER w AS e2, lead(event_type, 2) OVER w AS e3
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
       SELECT user_id, ts_1, ts_2, ts_3 FROM r
       WHERE e1 = 'view' AND e2 = 'click' AND e3 <> 'error' AND ts_3 < ts_1 + INTERVAL 2 DAY""",
)
def cep_steps(spark, sf):
    """A view, then a click, then anything but an error, with nothing in between and in less than two days."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    kind = F.col("event_type")
    return patterns.steps(events, ["user_id"], ["ts", "event_id"], [kind == "view", kind == "click", kind != "error"], 2 * DAY)


@query(
    "cep_times_consecutive",
    f"""{_RUNS} SELECT user_id || ' failed 3 times in a row: ' || (epoch_us(ts_1) // 1000) || ', ' || (epoch_us(ts_2) // 1000) || ', ' || (epoch_us(ts_3) // 1000)
        AS alert FROM m""",
)
def cep_times_consecutive(spark, sf):
    matches = _errors(spark, sf, 3)
    millis = [F.unix_millis(F.col(f"ts_{i}").cast("timestamp")).alias(f"ts_{i}") for i in (1, 2, 3)]
    return patterns.alert_text(matches.select("user_id", *millis), "user_id", 3)


@query(
    "cep_order_timeout",
    """SELECT s.user_id, s.ts AS first_ts, min(p.ts) AS second_ts,
              CASE WHEN min(p.ts) IS NULL THEN 'timeout' ELSE 'paid' END AS status
       FROM (SELECT * FROM events WHERE event_type = 'signup') s
       LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
         ON s.user_id = p.user_id AND p.ts > s.ts AND p.ts < s.ts + INTERVAL 12 HOUR
       GROUP BY s.user_id, s.event_id, s.ts""",
)
def cep_order_timeout(spark, sf):
    return patterns.followed_by(
        table(spark, sf, "events"),
        ["user_id"],
        ["ts", "event_id"],
        F.col("event_type") == "signup",
        F.col("event_type") == "purchase",
        12 * HOUR,
    )


@query(
    "cep_times_combinations",
    """WITH e AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'error')
       SELECT a.user_id, a.ts AS ts_1, a.event_id AS seq_1, b.ts AS ts_2, b.event_id AS seq_2, c.ts AS ts_3, c.event_id AS seq_3
       FROM e a JOIN e b ON a.user_id = b.user_id AND (b.ts, b.event_id) > (a.ts, a.event_id)
                JOIN e c ON a.user_id = c.user_id AND (c.ts, c.event_id) > (b.ts, b.event_id)
       WHERE b.ts < a.ts + INTERVAL 1 DAY AND c.ts < a.ts + INTERVAL 1 DAY""",
)
def cep_times_combinations(spark, sf):
    return patterns.combinations(table(spark, sf, "events"), "user_id", "ts", "event_id", F.col("event_type") == "error", DAY, 3)


_PAIRS = """
    WITH p AS (SELECT event_id, user_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS action1,
                      event_type AS action2 FROM events),
         r AS (SELECT * FROM (VALUES ('click', 'purchase', 1), ('view', 'click', 2), ('signup', 'purchase', 3)) t(action1, action2, rule_seq))
"""


def _rules(spark):
    return spark.createDataFrame([("click", "purchase", 1), ("view", "click", 2), ("signup", "purchase", 3)], RULE)


@query("behavior_pattern", f"{_PAIRS} SELECT user_id, event_id, p.action1, p.action2 FROM p JOIN r USING (action1, action2)")
def behavior_pattern(spark, sf):
    return rules.behavior_pattern(table(spark, sf, "events"), _rules(spark), "user_id", ["event_id"], "event_type", "all")


@query(
    "behavior_pattern_latest",
    f"""{_PAIRS} SELECT user_id, event_id, action1, action2 FROM p
        WHERE (action1, action2) = (SELECT (action1, action2) FROM r ORDER BY rule_seq DESC LIMIT 1)""",
)
def behavior_pattern_latest(spark, sf):
    return rules.behavior_pattern(table(spark, sf, "events"), _rules(spark), "user_id", ["event_id"], "event_type", "latest")


_KINDS = "['view', 'click', 'signup', 'purchase', 'error']"


def _dated_rules(events):
    """Every 53rd event sets a new rule over two kinds of events, dealt by its id."""
    kinds = F.array(*map(F.lit, ("view", "click", "signup", "purchase", "error")))
    pick = lambda n: F.element_at(kinds, (F.floor(F.col("event_id") / n) % 5 + 1).cast("int"))
    return events.where(F.col("event_id") % 53 == 0).select("ts", "event_id", pick(53).alias("action1"), pick(265).alias("action2"))


@query(
    "behavior_pattern_asof",
    f"""WITH p AS (SELECT event_id, user_id, ts, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS action1,
                          event_type AS action2 FROM events),
             r AS (SELECT ts, event_id, {_KINDS}[event_id // 53 % 5 + 1] AS r1, {_KINDS}[event_id // 265 % 5 + 1] AS r2
                   FROM events WHERE event_id % 53 = 0),
             o AS (SELECT ts, event_id, 0 AS side, r1, r2, NULL AS user_id, NULL AS action1, NULL AS action2 FROM r
                   UNION ALL SELECT ts, event_id, 1, NULL, NULL, user_id, action1, action2 FROM p),
             v AS (SELECT *, last_value(r1 IGNORE NULLS) OVER w AS v1, last_value(r2 IGNORE NULLS) OVER w AS v2
                   FROM o WINDOW w AS (ORDER BY ts, event_id, side ROWS UNBOUNDED PRECEDING))
        SELECT user_id, ts, event_id, action1, action2 FROM v WHERE side = 1 AND action1 = v1 AND action2 = v2""",
)
def behavior_pattern_asof(spark, sf):
    """Each pair of actions against the rule that was valid at the second one."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    return rules.behavior_pattern_at(events, _dated_rules(events), "user_id", ["ts", "event_id"], "event_type")
