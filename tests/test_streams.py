"""Every stream produces what its batch twin produces on the same rows."""

from __future__ import annotations

import os
import shutil
import time
from datetime import timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from replay import ARROW, FLUSH_USER, as_set, drain, event, open_stream, write_files

from tidemark.operators import changelog, joins, keyed, late, ordered, over, patterns, rows, rules, states, timers, topn, windows
from tidemark.schemas import RULE
from tidemark.session import shared_folder
from tidemark.sinks import stores
from tidemark.sources import files
from tidemark.streaming import processors, runner

HOUR, DAY = timedelta(hours=1), timedelta(days=1)
USERS = 6


@pytest.fixture(scope="module")
def history():
    """The events of a few users, in arrival order."""
    table = pq.read_table("/root/testdata/sf0.01/events.parquet").to_pydict()
    picked = [i for i, user in enumerate(table["user_id"]) if user < USERS]
    return [
        event(table["event_id"][i], table["user_id"][i], table["event_type"][i], int(table["ts"][i].timestamp() * 1000), i % 2)
        for i in picked
    ]


@pytest.fixture(scope="module")
def batch(spark, history):
    frame = spark.createDataFrame([[r[f.name] for f in ARROW if f.name != "et"] for r in history], "seq long, user_id long, event_type string, ts long, side int")
    return frame.withColumn("et", F.timestamp_millis("ts")).cache()


@pytest.fixture(scope="module")
def folder(tmp_path_factory, history):
    return write_files(tmp_path_factory.mktemp("events") / "in", history)


@pytest.fixture
def stream(spark, folder):
    return open_stream(spark, folder)


@pytest.fixture
def timed(stream):
    return runner.watermarked(stream, "et")


def settings(spark, **more):
    return runner.StreamSettings(shared_folder(spark, "checkpoint"), available_now=True, **more)


def real(found):
    return [r for r in found if r["user_id"] != FLUSH_USER]


def same(found, expected, *columns):
    left, right = as_set(found, *columns), as_set(expected.collect(), *columns)
    assert left == right
    assert left


# --- stateless transforms and built-in aggregates ----------------------------------------------------


def test_row_transforms(stream, batch):
    def transformed(df):
        kept = rows.where_equal(df, "event_type", "click")
        return rows.flatmap_conditional(kept, F.col("user_id") == 3, "event_type", "ts")

    found = [r for r in drain(transformed(stream)) if r["field"] != "4102444800000"]
    same(found, transformed(batch), "field")


def test_grouped_count_in_complete_mode(stream, batch):
    found = real(drain(keyed.count_by(stream, ["user_id"]), "complete"))
    same(found, keyed.count_by(batch, ["user_id"]), "user_id", "cnt")


@pytest.mark.parametrize(
    "operator",
    [
        lambda df: windows.tumble_count(df, "et", DAY, ["user_id"]),
        lambda df: windows.hop_count(df, "et", DAY, 2 * DAY, ["user_id"]),
        lambda df: windows.cumulate_count(df, "et", 6 * HOUR, DAY, ["user_id"]),
    ],
    ids=["tumble", "hop", "cumulate"],
)
def test_window_counts(timed, batch, operator):
    same(real(drain(operator(timed))), operator(batch), "window_start", "window_end", "user_id", "cnt")


def test_sliding_pv_uv(timed, batch):
    def operator(df):
        return windows.pv_uv(df, "et", 2 * DAY, DAY, "user_id")

    found = [r for r in drain(operator(timed)) if r["window_start"].year < 2090]
    same(found, operator(batch), "window_start", "window_end", "pv", "uv", "ratio")


def test_window_top_n(spark, timed, batch):
    out = shared_folder(spark, "topn")
    counts = windows.hop_count(timed, "et", DAY, 2 * DAY, ["event_type"])
    runner.start_top_n(
        counts, "event_type", lambda df, i: df.write.parquet(f"{out}/batch={i}"), settings(spark)
    ).awaitTermination()
    found = [r for r in spark.read.parquet(out).collect() if r["window_start"].year < 2090]
    expected = topn.top_per_hop(batch, "et", DAY, 2 * DAY, "event_type")
    same(found, expected, "window_start", "window_end", "event_type", "cnt", "row_num")


# --- joins -------------------------------------------------------------------------------------------


def sides(df):
    def side(kind, prefix):
        kept = df.where(F.col("event_type") == kind)
        return kept.select(*[F.col(c).alias(f"{prefix}_{c}") for c in ("user_id", "seq", "et")])

    return side("purchase", "p"), side("click", "c")


def timed_sides(stream):
    left, right = sides(stream)
    return runner.watermarked(left, "p_et"), runner.watermarked(right, "c_et")


def test_window_join(stream, batch):
    def operator(pair):
        return joins.window_join(*pair, ("p_user_id", "c_user_id"), ("p_et", "c_et"), DAY)

    found = [r for r in drain(operator(timed_sides(stream))) if r["p_user_id"] != FLUSH_USER]
    same(found, operator(sides(batch)), "window_start", "p_seq", "c_seq")


@pytest.mark.parametrize("how", ["inner", "full"])
def test_interval_join(stream, batch, how):
    def operator(pair):
        return joins.interval_join(*pair, ("p_user_id", "c_user_id"), ("p_et", "c_et"), -5 * HOUR, 10 * HOUR, how)

    found = drain(operator(timed_sides(stream)))
    found = [r for r in found if FLUSH_USER not in (r["p_user_id"], r["c_user_id"])]
    same(found, operator(sides(batch)), "p_seq", "c_seq")


def test_unbounded_join_and_union(stream, batch):
    def operator(pair):
        return joins.unbounded_join(*pair, ("p_user_id", "c_user_id"))

    found = [r for r in drain(operator(sides(stream))) if r["p_user_id"] != FLUSH_USER]
    same(found, operator(sides(batch)), "p_seq", "c_seq")

    def union(df):
        return joins.union_streams(df.where("event_type = 'click'"), df.where("event_type = 'view'"))

    same(real(drain(union(stream))), union(batch), "seq", "event_type")


def test_reconcile(timed, batch):
    wait = 12 * HOUR
    tagged = timed.where("event_type IN ('signup', 'purchase')").withColumn(
        "side", F.when(F.col("event_type") == "signup", "app").otherwise("platform")
    )
    found = real(drain(processors.reconcile(tagged, "user_id", wait)))

    def side(kind, prefix):
        kept = batch.where(F.col("event_type") == kind)
        return kept.select(*[F.col(c).alias(f"{prefix}_{c}") for c in ("user_id", "ts", "et")])

    expected = joins.reconcile(side("signup", "app"), side("purchase", "platform"), ("app_user_id", "platform_user_id"), ("app_et", "platform_et"), wait)
    same(found, expected, "app_ts", "platform_ts", "status")


def test_window_cogroup(timed, batch):
    two = timed.where("event_type IN ('click', 'purchase')").withColumn("value", F.col("seq"))
    two = two.withColumn("side", F.when(F.col("event_type") == "click", "right").otherwise("left"))
    found = real(drain(processors.window_cogroup(two, "user_id", DAY)))
    expected = joins.window_cogroup(
        batch.where("event_type = 'purchase'"), batch.where("event_type = 'click'"), "user_id", "et", ["et", "seq"], "seq", DAY
    ).withColumn("window_start", F.unix_millis("window_start"))
    same(found, expected, "user_id", "window_start", "side", "position", "value")


# --- keyed state -------------------------------------------------------------------------------------


def test_count_changelog(stream, batch):
    found = real(drain(processors.count_changelog(stream, "user_id")))
    same(found, changelog.count_changelog(batch, ["user_id"], ["seq"]), "user_id", "seq", "part", "op", "cnt")


def test_count_window(stream, batch):
    found = real(drain(processors.count_window_average(stream, "user_id", 5)))
    same(found, windows.count_window_average(batch, ["user_id"], ["seq"], "ts", 5), "user_id", "group_no", "avg_ts")


def test_state_tour(stream, batch):
    found = real(drain(processors.keyed_state_tour(stream.withColumnRenamed("event_type", "url"), "user_id")))
    expected = states.keyed_state_tour(batch.withColumnRenamed("event_type", "url"), "user_id", ["seq"], "url", "ts")
    same(found, expected, "seq", "value_url", "list_size", "map_value", "reduced_url", "reduced_ts", "aggregate")


def test_event_time_timers(timed, batch):
    found = real(drain(processors.timers(timed, "user_id", timedelta(seconds=10))))
    expected = timers.event_time_timers(batch, "user_id", "et").withColumn("at", F.unix_millis("at"))
    same(found, expected, "user_id", "at", "kind")


def test_periodic_count(timed, batch):
    found = real(drain(processors.periodic_count(timed, "user_id", 3 * DAY)))
    expected = timers.periodic_count(batch, "user_id", "ts", 3 * DAY)
    same(found, expected, "user_id", "fire_ts", "cnt")


def test_last_rows(timed, batch):
    found = real(drain(processors.last_rows(timed, "user_id", 3)))
    expected = over.average_of_last(batch, ["user_id"], ["ts", "seq"], "ts", 3)
    assert [(r[0], round(r[1], 3)) for r in as_set(found, "seq", "avg_ts")] == [
        (r[0], round(r[1], 3)) for r in as_set(expected.collect(), "seq", "avg_ts")
    ]


def test_consecutive(timed, batch):
    failed = F.col("event_type") == "error"
    found = real(drain(processors.consecutive(timed, "user_id", failed, 3)))
    same(found, patterns.consecutive(batch, ["user_id"], ["ts", "seq"], failed, 3), "user_id", "ts_1", "ts_2", "ts_3")


def test_followed_by(timed, batch):
    first, second = F.col("event_type") == "signup", F.col("event_type") == "purchase"
    found = real(drain(processors.followed_by(timed, "user_id", first, second, 12 * HOUR)))
    expected = patterns.followed_by(batch, ["user_id"], ["ts", "seq"], first, second, 12 * HOUR)
    same(found, expected, "user_id", "first_ts", "second_ts", "status")


def test_rules_are_read_per_batch(spark, stream, batch):
    out, seen = shared_folder(spark, "rules"), []

    def read_rules(session):
        seen.append(1)
        return session.createDataFrame([("click", "purchase", 1), ("view", "click", 2)], RULE)

    pairs = processors.action_pairs(stream.withColumnRenamed("event_type", "action"), "user_id")
    runner.start_rules(pairs, read_rules, lambda df, i: df.write.parquet(f"{out}/batch={i}"), settings(spark)).awaitTermination()
    found = real(spark.read.parquet(out).collect())
    expected = rules.behavior_pattern(batch, read_rules(spark), "user_id", ["seq"], "event_type")
    same(found, expected, "user_id", "seq", "action1", "action2")
    assert len(seen) > 2


def test_watermark_probe(timed):
    found = real(drain(processors.annotate_watermark(timed, "user_id")))
    marks = {r["watermark_ms"] for r in found}
    assert len(marks) == 2
    assert min(marks) == 0
    # no row of a later file is older than the watermark of its micro-batch
    assert all(r["ts"] >= r["watermark_ms"] for r in found)


def _until(query, ready, seconds=60):
    deadline = time.time() + seconds
    while not ready() and time.time() < deadline and query.isActive:
        time.sleep(0.2)
    query.stop()
    assert ready()


def test_processing_time_timers(spark, tmp_path):
    path = write_files(tmp_path / "in", [event(1, 1, "click", 1000), event(2, 2, "click", 2000)], 1, flush=False)
    out = processors.timers(open_stream(spark, path), "user_id", timedelta(milliseconds=100), event_time=False)
    query = out.writeStream.format("memory").queryName("pt_timers").outputMode("append").start()
    _until(query, lambda: spark.table("pt_timers").where("kind = 'fire'").count() == 2)
    assert spark.table("pt_timers").where("kind = 'arrival'").count() == 2


def test_state_expires(spark, tmp_path):
    path = write_files(tmp_path / "in", [event(1, 1, "click", 1000), event(2, 1, "click", 2000)], 1, flush=False)
    out = processors.expiring_count(open_stream(spark, path), "user_id", timedelta(milliseconds=1500))
    query = out.writeStream.format("memory").queryName("ttl_counts").outputMode("append").start()
    deadline = time.time() + 60
    while spark.table("ttl_counts").count() < 2 and time.time() < deadline:
        time.sleep(0.2)
    time.sleep(2)
    write_files(tmp_path / "more", [event(3, 1, "click", 3000)], 1, flush=False)
    (tmp_path / "more" / "part-0.parquet").rename(tmp_path / "in" / "part-9.parquet")
    _until(query, lambda: spark.table("ttl_counts").count() == 3)
    assert as_set(spark.table("ttl_counts").collect(), "seq", "cnt") == [(1, 1), (2, 2), (3, 1)]


# --- sources and sinks -------------------------------------------------------------------------------


def test_late_split(spark, tmp_path, history):
    shuffled = sorted(history, key=lambda r: r["seq"] + r["seq"] * 37 % 500)
    arrivals = [dict(r, seq=i) for i, r in enumerate(shuffled)]
    path = write_files(tmp_path / "in", arrivals, 2, flush=False)
    half = timedelta(minutes=30)
    out = shared_folder(spark, "late")
    runner.start_late_split(open_stream(spark, path), "et", ["seq"], out, settings(spark), HOUR, half, half).awaitTermination()
    found = spark.read.parquet(f"{out}/rows").collect()
    expected = late.classify(spark.read.parquet(path), "et", ["seq"], HOUR, half, half)
    same(found, expected, "seq", "window_start", "lateness")
    assert len({r["lateness"] for r in found}) == 3


def test_upsert_keeps_latest_and_repeats_safely(spark, stream, batch):
    out = shared_folder(spark, "upsert")
    write = stores.upsert_writer(out, ["user_id"], "event_type", ["ts", "seq"])

    def twice(df, batch_id):
        write(df, batch_id)
        write(df, batch_id)

    runner.start_batches(stream, twice, settings(spark)).awaitTermination()
    found = real(stores.read_upserted(spark, out, 2).collect())
    same(found, keyed.latest_value(batch, ["user_id"], "event_type", ["ts", "seq"]), "user_id", "event_type")


def test_buffered_batches(spark, stream, history):
    out = shared_folder(spark, "buffered")
    write = stores.buffered_writer(lambda df: df.write.mode("append").parquet(out), "seq", 10)
    runner.start_batches(stream, write, settings(spark)).awaitTermination()
    sizes = spark.read.parquet(out).groupBy("batch_id", "batch_no").count()
    assert sizes.agg(F.sum("count")).first()[0] == len(history) + 2
    assert sizes.where("count > 10").count() == 0


def test_file_sinks_restart_where_they_stopped(spark, tmp_path, history):
    path = write_files(tmp_path / "in", history[:50], 2, flush=False)
    out, kept = shared_folder(spark, "files"), settings(spark, name="restartable")
    runner.start_files(open_stream(spark, path), out, kept).awaitTermination()
    write_files(tmp_path / "more", history[50:80], 1, flush=False)
    (tmp_path / "more" / "part-0.parquet").rename(tmp_path / "in" / "part-9.parquet")
    runner.start_files(open_stream(spark, path), out, kept).awaitTermination()
    assert sorted(r.seq for r in spark.read.parquet(out).collect()) == sorted(r["seq"] for r in history[:80])


def test_csv_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("Alice, ./home, 1000\nMary,./cart, 13999")
    table = files.with_rowtime(files.csv_table(spark, str(tmp_path / "in"), streaming=True, max_files_per_trigger=1))
    found = drain(table.withColumn("s", F.unix_seconds("et")))
    assert as_set(found, "user_name", "url", "ts", "s") == [("Alice", "./home", 1000, 1), ("Mary", "./cart", 13999, 13)]


# --- late windows, rules over time, and state of any type ---------------------------------------------


def split_folder(tmp_path, history, parts, name="in"):
    """Files that a stream reads in this order, by their times."""
    folder = write_files(tmp_path / name, history, parts=parts, flush=False)
    for number, file in enumerate(sorted(Path(folder).iterdir(), key=lambda f: int(f.stem.split("-")[1]))):
        os.utime(file, (9 * 10**8 + number, 9 * 10**8 + number))
    return folder


LATE = dict(size=DAY, delay=HOUR, lateness=12 * HOUR)


def moment():
    """Arrival up to thirty hours after the event."""
    return F.struct((F.col("ts") / 3_600_000).cast("long") + F.pmod(F.col("seq") * 37, F.lit(30)), "seq")


@pytest.mark.parametrize("parts", [1, 5])
def test_late_windows_fire_again(spark, history, batch, tmp_path, parts):
    """Whatever the micro-batches are, the latest updates are the batch counts and the side output is the same."""
    arrived = sorted(history, key=lambda r: (r["ts"] // 3_600_000 + (r["seq"] * 37) % 30, r["seq"]))
    arriving = open_stream(spark, split_folder(tmp_path, arrived, parts)).withColumn("arrival", moment())
    out = shared_folder(spark, "late")
    last = batch.agg(F.max("et")).first()[0]
    query = runner.start_late_windows(arriving, "et", ["user_id"], ["arrival"], out, settings(spark), **LATE)
    query.awaitTermination()

    classified = late.classify(batch.withColumn("arrival", moment()), "et", ["arrival"], **LATE)
    passed = late.window_counts(classified, ["user_id"]).where(F.col("window_end") + F.expr("INTERVAL 1 HOUR") <= F.lit(last))
    columns = ("window_start", "window_end", "user_id", "cnt", "refires")
    same(runner.late_windows(spark, out, ["user_id"]).collect(), passed, *columns)
    same(spark.read.parquet(f"{out}/side").collect(), late.side_output(classified), "seq", "window_start")
    updates = spark.read.parquet(f"{out}/updates")
    assert parts == 1 or updates.count() > passed.count()  # some windows fired again
    kept = spark.read.parquet(f"{out}/open")
    assert kept.select("batch").distinct().count() <= 2 and kept.count() < passed.count()


def test_late_windows_may_repeat_a_batch(spark, batch):
    """A batch that is handed on twice leaves what it left once."""
    frames = [batch.withColumn("arrival", moment()).where(f"seq % 2 = {i}") for i in (0, 1)]
    seen, steps = [], []
    original = runner.start_batches
    try:
        runner.start_batches = lambda df, write, settings: steps.append(write)
        for out in (shared_folder(spark, "once"), shared_folder(spark, "twice")):
            runner.start_late_windows(frames[0], "et", ["user_id"], ["arrival"], out, None, **LATE)
            for i, frame in enumerate(frames):
                for _ in range(1 if "once" in out else 2):
                    steps[-1](frame, i)
            seen.append((as_set(runner.late_windows(spark, out, ["user_id"]).collect(), "window_start", "user_id", "cnt", "refires"), spark.read.parquet(f"{out}/side").count()))
    finally:
        runner.start_batches = original
    assert seen[0] == seen[1] and seen[0][0]


def test_rules_valid_at_the_action(spark, history, batch, tmp_path):
    ordered = sorted(history, key=lambda r: r["seq"])
    stream = open_stream(spark, split_folder(tmp_path, ordered, 4)).withColumnRenamed("event_type", "action")
    out, kept = shared_folder(spark, "pairs"), shared_folder(spark, "rules")

    def dated(df):
        picked = df.where("seq % 11 = 0")
        return picked.select("seq", F.lit("view").alias("action1"), F.when(F.col("seq") % 2 == 0, "click").otherwise("view").alias("action2"))

    pairs = processors.action_pairs(stream, "user_id")
    rules_stream = dated(open_stream(spark, str(tmp_path / "in")))
    query = runner.start_rules_at(pairs, rules_stream, ["seq"], lambda df, i: df.write.mode("overwrite").parquet(f"{out}/batch={i}"), kept, settings(spark))
    query.awaitTermination()
    actions = batch.withColumnRenamed("event_type", "action")
    expected = rules.behavior_pattern_at(actions, dated(batch), "user_id", ["seq"])
    same(spark.read.parquet(out).collect(), expected, "user_id", "seq", "action1", "action2")


def test_over_any_columns(timed, batch):
    aggregates = {"cnt": ("count", "event_type"), "last": ("max", "event_type"), "low": ("min", "ts"), "total": ("sum", "side")}
    found = real(drain(processors.over_last(timed, "user_id", aggregates, 2)))

    def frames(window):
        frame = window.rowsBetween(-2, 0)
        return {"cnt": F.count("event_type").over(frame), "last": F.max("event_type").over(frame), "low": F.min("ts").over(frame), "total": F.sum("side").over(frame)}

    expected = ordered.over_rows(batch, ["user_id"], ["ts", "seq"], 2, frames)
    same(found, expected, "seq", "cnt", "last", "low", "total")
    plain = over.count_and_max_of_last(batch, ["user_id"], ["ts", "seq"], "event_type", "ts", 2)
    twin = real(drain(processors.over_last(timed, "user_id", {"cnt": ("count", "event_type"), "max_ts": ("max", "ts")}, 2)))
    same(twin, plain, "seq", "cnt", "max_ts")


def test_steps(timed, batch):
    kind = F.col("event_type")
    conditions = [kind == "view", kind == "click", kind != "error"]
    for within in (2 * DAY, None):
        found = real(drain(processors.steps(timed, "user_id", conditions, within)))
        same(found, patterns.steps(batch, ["user_id"], ["ts", "seq"], conditions, within), "user_id", "ts_1", "ts_2", "ts_3")


def test_counts_that_expire_by_event_time(timed, batch):
    found = real(drain(processors.expiring_count_by_event_time(timed, "user_id", 2 * DAY)))
    same(found, states.expiring_count(batch, ["user_id"], ["ts", "seq"], "ts", 2 * DAY), "user_id", "seq", "cnt")


def test_general_reduce(stream, batch):
    values = {
        "n": ordered.Run("count"), "total": ordered.Run("sum", F.col("ts") % 1000), "high": ordered.Run("max", F.col("event_type")),
        "low": ordered.Run("min", F.when(F.col("side") == 1, F.col("ts"))), "first": ordered.Run("first", F.col("event_type")), "last": ordered.Run("last", F.col("side")),
    }
    found = real(drain(processors.running_reduce(stream, "user_id", values)))
    same(found, keyed.running_reduce(batch, ["user_id"], ["seq"], values), "user_id", "seq", *values)


@pytest.mark.parametrize("parts", [4])
def test_batches_of_exact_size(spark, history, batch, tmp_path, parts):
    rows_in_order = sorted(history, key=lambda r: r["seq"])
    out, kept = shared_folder(spark, "batches"), shared_folder(spark, "rest")
    writer = stores.carried_batches_writer(lambda df, i: df.write.mode("overwrite").parquet(f"{out}/micro={i}"), kept, "seq", 10)
    setting = settings(spark)
    whole = split_folder(tmp_path, rows_in_order[: len(rows_in_order) // 2], parts)
    runner.start_batches(open_stream(spark, whole), writer, setting).awaitTermination()
    more = split_folder(tmp_path, rows_in_order[len(rows_in_order) // 2 :], parts, "more")
    for number in range(parts):
        if (file := Path(more, f"part-{number}.parquet")).exists():
            shutil.copy(file, f"{whole}/part-{100 + number}.parquet")
            os.utime(f"{whole}/part-{100 + number}.parquet", (10**9 + number, 10**9 + number))
    runner.start_batches(open_stream(spark, whole), writer, setting).awaitTermination()  # goes on after a restart
    found = spark.read.parquet(out)
    expected = stores.buffered_batches(batch, "seq", 10)
    full = expected.join(expected.groupBy("batch_no").count().where("count = 10"), "batch_no", "left_semi")
    same(found.collect(), full, "seq", "batch_no")
    last = max(int(r["micro"]) for r in found.select("micro").distinct().collect())
    assert stores.waiting_rows(spark, kept, last).count() == len(history) % 10


def test_bucketed_table(spark, batch, tmp_path):
    folder = str(tmp_path / "table")
    write = stores.bucketed_writer(folder, ["user_id"], "event_type", ["seq"], 4)
    first, second, third = (batch.where(f"seq % 3 = {i}") for i in range(3))

    def files():
        return {str(p.relative_to(folder)) for p in Path(folder, "data").rglob("*.parquet")}

    write(first, 0)
    before = files()
    few = second.where("user_id = 2")
    write(few, 1)
    assert before <= files()  # a repeated batch may still need them
    (touched,) = {p.split("/")[1] for p in files() - before}
    write(few, 1)
    expected = keyed.latest_value(first.unionByName(few), ["user_id"], "event_type", ["seq"])
    same(stores.read_bucketed(spark, folder, 1).collect(), expected, "user_id", "event_type")
    write(third, 2)
    assert not any(p.startswith(f"version=0/{touched}/") for p in files())
    expected = keyed.latest_value(first.unionByName(few).unionByName(third), ["user_id"], "event_type", ["seq"])
    same(stores.read_bucketed(spark, folder, 2).collect(), expected, "user_id", "event_type")
