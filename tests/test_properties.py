"""Random small inputs against plain Python, with slices of three rows."""

from __future__ import annotations

from datetime import timedelta
from itertools import combinations

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators import joins, patterns, timers, windows
from tidemark.operators.ordered import Run, over_rows, running

pytestmark = pytest.mark.usefixtures("tiny_slices")
checked = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

# one hot key, clustered times, ties on the time
events = st.lists(
    st.tuples(st.sampled_from(["hot", "hot", "hot", "cold", None]), st.integers(0, 40), st.sampled_from("abc")), min_size=1, max_size=40
)


def frame(spark, rows):
    data = [(i, k, t, e) for i, (k, t, e) in enumerate(rows)]
    df = spark.createDataFrame(data, "seq long, key string, ts long, kind string")
    return df.withColumn("et", F.timestamp_seconds("ts"))


def by_key(rows):
    groups = {}
    for seq, (key, ts, kind) in enumerate(rows):
        groups.setdefault(key, []).append((ts, seq, kind))
    return {key: sorted(group) for key, group in groups.items()}


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@checked
@given(events)
def test_running_and_last_rows(spark, rows):
    df = frame(spark, rows)
    runs = {"n": Run("count"), "top": Run("max", F.col("kind"), inclusive=False), "first": Run("first", F.col("kind"))}
    found = running(df, ["key"], ["ts", "seq"], runs).select("seq", "n", "top", "first")
    back = running(df, ["key"], ["ts", "seq"], {"n": Run("count", inclusive=False)}, reverse=True).select("seq", "n")
    last = over_rows(df, ["key"], ["ts", "seq"], 2, lambda w: {"s": F.sum("seq").over(w.rowsBetween(-2, 0))}).select("seq", "s")
    expected, expected_back, expected_last = [], [], []
    for group in by_key(rows).values():
        for i, (_, seq, _) in enumerate(group):
            before = [kind for _, _, kind in group[:i]]
            expected.append((seq, i + 1, max(before, default=None), group[0][2]))
            expected_back.append((seq, len(group) - i - 1))
            expected_last.append((seq, sum(s for _, s, _ in group[max(0, i - 2) : i + 1])))
    assert collected(found) == sorted(expected, key=repr)
    assert collected(back) == sorted(expected_back, key=repr)
    assert collected(last) == sorted(expected_last, key=repr)


@checked
@given(events)
def test_patterns(spark, rows):
    df = frame(spark, rows)
    hit = F.col("kind") == "a"
    strict = patterns.consecutive(df, ["key"], ["ts", "seq"], hit, 3).select("key", "ts_1", "ts_2", "ts_3")
    loose = patterns.followed_by(df, ["key"], ["ts", "seq"], hit, F.col("kind") == "b", timedelta(milliseconds=5))
    some = patterns.combinations(df, "key", "et", "seq", hit, timedelta(seconds=4)).select("seq_1", "seq_2", "seq_3")
    e_strict, e_loose, e_some = [], [], []
    for key, group in by_key(rows).items():
        for i, (ts, _, kind) in enumerate(group):
            if len(group) >= i + 3 and all(g[2] == "a" for g in group[i : i + 3]):
                e_strict.append((key, *[g[0] for g in group[i : i + 3]]))
            if kind == "a":
                then = next((t for t, _, k in group[i + 1 :] if k == "b"), None)
                paid = then is not None and then - ts < 5
                e_loose.append((key, ts, then if paid else None, "paid" if paid else "timeout"))
        if key is not None:
            hits = [g for g in group if g[2] == "a"]
            e_some += [tuple(g[1] for g in c) for c in combinations(hits, 3) if c[2][0] - c[0][0] < 4]
    assert collected(strict) == sorted(e_strict, key=repr)
    assert collected(loose) == sorted(e_loose, key=repr)
    assert collected(some) == sorted(e_some, key=repr)


@checked
@given(events, events)
def test_interval_join_and_reconcile(spark, left, right):
    left, right = left + left[:2], right + right[:3]  # repeated rows

    def side(rows, prefix):
        return frame(spark, rows).select(*[F.col(c).alias(f"{prefix}_{c}") for c in ("seq", "key", "et")])

    lower, upper = timedelta(seconds=-2), timedelta(seconds=3)
    pair = (side(left, "l"), side(right, "r"), ("l_key", "r_key"), ("l_et", "r_et"))
    inner = [
        (i, j)
        for i, (lk, lt, _) in enumerate(left)
        for j, (rk, rt, _) in enumerate(right)
        if lk is not None and lk == rk and lt - 2 <= rt <= lt + 3
    ]
    lonely_left = [(i, None) for i in range(len(left)) if i not in {p[0] for p in inner}]
    lonely_right = [(None, j) for j in range(len(right)) if j not in {p[1] for p in inner}]
    def times(pairs):
        return [(None if i is None else left[i][:2], None if j is None else right[j][:2]) for i, j in pairs]

    plain = [side.select(*[F.col(f"{p}_{c}").alias(f"{p}_{c}") for c in ("key", "et")]) for side, p in ((pair[0], "l"), (pair[1], "r"))]
    found = joins.interval_join(*plain, *pair[2:], lower, upper, "full")
    found = found.select("l_key", F.unix_seconds("l_et"), "r_key", F.unix_seconds("r_et"))
    flat = [(*(a or (None, None)), *(b or (None, None))) for a, b in times(inner + lonely_left + lonely_right)]
    assert collected(found) == sorted(flat, key=repr)
    for how, expected in (("inner", inner), ("left", inner + lonely_left), ("full", inner + lonely_left + lonely_right)):
        found = joins.interval_join(*pair, lower, upper, how).select("l_seq", "r_seq")
        assert collected(found) == sorted(expected, key=repr), how


@checked
@given(events)
def test_windows_and_periods(spark, rows):
    df = frame(spark, rows)
    cumulate = windows.cumulate_count(df, "et", timedelta(seconds=5), timedelta(seconds=20), ["key"])
    found = cumulate.select(F.unix_seconds("window_start"), F.unix_seconds("window_end"), "key", "cnt")
    counts = {}
    for key, ts, _ in rows:
        start = ts - ts % 20
        for end in range(start + 5, start + 21, 5):
            if ts < end:
                counts[start, end, key] = counts.get((start, end, key), 0) + 1
    assert collected(found) == sorted([(*k, n) for k, n in counts.items()], key=repr)

    reports = []
    for key, group in by_key(rows).items():
        times, due = [g[0] for g in group], None
        for ts in times:
            if due is not None and ts > due:
                reports.append((key, due, sum(t <= due for t in times)))
                due = None
            due = ts + 7 if due is None else due
        reports.append((key, due, sum(t <= due for t in times)))
    found = timers.periodic_count(df, "key", "ts", timedelta(milliseconds=7))
    assert collected(found) == sorted(reports, key=repr)
