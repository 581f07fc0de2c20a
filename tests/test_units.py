"""Slice sizes, option builders, settings and small sinks."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from replay import event, open_stream, write_files

from tidemark import session
from tidemark.operators import ordered, partitioning
from tidemark.operators.ordered import MAX_ROWS_CONF, Run, over_rows, running
from tidemark.sinks import stores
from tidemark.sources import brokers
from tidemark.streaming import runner


@pytest.fixture
def limit(spark):
    spark.conf.set(MAX_ROWS_CONF, "100")
    yield 100
    spark.conf.unset(MAX_ROWS_CONF)


_SHAPES = {
    "even": "id",
    "coarse": "id div 1000",
    "burst": "if(id % 2 = 0, id, 1500 + id % 50)",
    "equal": "0",
    "nulls": "if(id % 2 = 0, NULL, 7)",
    "epoch_sparse_burst": "if(id = 0, 0, if(id < 100, id * 86400000, 1700000000000 + id))",
    "full_range": "xxhash64(id)",
    "text": "concat('t', CAST(id % 700 AS STRING))",
    "double": "if(id % 9 = 0, CAST('NaN' AS DOUBLE), id / 7)",
    "date": "date_add(DATE'2024-01-01', CAST(id % 300 AS INT))",
}


@pytest.mark.parametrize("time", _SHAPES.values(), ids=_SHAPES.keys())
def test_slices_keep_the_limit_and_the_results(spark, limit, time):
    rows = spark.range(3000).selectExpr("id AS seq", f"{time} AS ts", "if(id % 30 = 0, 'cold', 'hot') AS key")
    sliced, hot, slices = ordered._sliced(rows, ["key"], ["ts", "seq"], None)
    sizes = {r[0]: r[1] for r in sliced.groupBy("key", *slices).count().groupBy("key").agg(F.max("count")).collect()}
    assert sizes == {"cold": 100, "hot": limit}
    assert hot.select("key").distinct().collect() == [("hot",)]

    def results():
        runs = {"n": Run("count"), "f": Run("first", F.col("seq")), "l": Run("last", F.col("seq"), inclusive=False)}
        forward = running(rows, ["key"], ["ts", "seq"], runs)
        back = running(forward, ["key"], ["ts", "seq"], {"r": Run("count")}, reverse=True)
        last = over_rows(back, ["key"], ["ts", "seq"], 3, lambda w: {"s": F.sum("seq").over(w.rowsBetween(-3, 0))})
        return last.select("seq", "n", "f", "l", "r", "s").sort("seq").collect()

    found = results()
    spark.conf.set(MAX_ROWS_CONF, "100000")
    assert found == results()


def test_plain_window_without_hot_keys(spark):
    plain = running(spark.range(100).withColumn("key", F.lit(1)), ["key"], ["id"], {"n": Run("count")})
    plan = plain._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "Join" not in plan


def test_streams_are_refused(spark, tmp_path):
    stream = open_stream(spark, write_files(tmp_path / "in", [event(1, 1, "click", 1)], 1))
    with pytest.raises(ValueError, match="batch only"):
        over_rows(stream, ["user_id"], ["seq"], 1, lambda w: {"p": F.lag("seq").over(w)})


def test_unknown_rule_mode(spark):
    from tidemark.operators.rules import match_rules

    with pytest.raises(ValueError, match="unknown mode"):
        match_rules(spark.range(1), spark.range(1), "some")


def test_kafka_options_and_messages(spark):
    assert brokers.kafka_source_options("host:9092", group_id="g") == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "clicks",
        "startingOffsets": "latest",
        "kafka.group.id": "g",
    }
    assert stores.kafka_sink_options("host:9092") == {"kafka.bootstrap.servers": "host:9092", "topic": "events"}
    frame = spark.createDataFrame([("Mary", "./home", 1000)], "user string, url string, timestamp long")
    assert stores.kafka_messages(frame).first()[0] == '{"user":"Mary","url":"./home","timestamp":1000}'
    assert stores.kafka_messages(frame, F.col("timestamp")).first()[0] == "1000"


def test_jdbc_rows_and_options(spark):
    frame = spark.createDataFrame([("Mary", "./home", 1000)], "user string, url string, timestamp long")
    assert tuple(stores.jdbc_rows(frame).first()) == ("Mary", "./home", "1000")
    assert stores.jdbc_options("jdbc:x", driver="d") == {"url": "jdbc:x", "dbtable": "clicks", "batchsize": "1000", "driver": "d"}


def test_distribution(spark):
    frame = spark.range(1000)
    sizes = [r[1] for r in partitioning.with_partition(partitioning.rebalance(frame, 4)).groupBy("partition").count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) < 100
    assert partitioning.rebalance(frame).count() == partitioning.shuffle(frame, 3).count() == 1000
    assert partitioning.rescale(frame.repartition(8), 2).rdd.getNumPartitions() == 2
    assert partitioning.rescale(frame, 5, grow=True).rdd.getNumPartitions() == 5
    copies = partitioning.with_partition(partitioning.broadcast_copies(spark.range(3), 4), "placed")
    assert copies.where("placed <> subtask").count() == 0 and copies.count() == 12
    assert partitioning.single(frame).rdd.getNumPartitions() == 1


def test_console_and_interval_settings(spark, tmp_path):
    stream = open_stream(spark, write_files(tmp_path / "in", [event(1, 1, "click", 1)], 1, flush=False))
    settings = runner.StreamSettings(session.shared_folder(spark, "offsets"), "shown", timedelta(milliseconds=200))
    query = runner.start_console(stream, settings)
    query.processAllAvailable()
    assert query.name == "shown" and query.isActive
    query.stop()


def test_shared_folder_follows_the_cluster_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    first, second = session.shared_folder(spark, "x"), session.shared_folder(spark, "x")
    assert first.startswith(configured.rstrip("/")) and first != second


def test_csv_keeps_every_string(spark, tmp_path):
    from tidemark.sinks import files as sinks
    from tidemark.sources import files as sources

    texts = [" a ", "b\nc", "", None, 'say "x"', "'", "a,b", "\\", '\\"', "\t", "#", "\r\nz", '"', "null", "é"]
    frame = spark.createDataFrame(list(enumerate(texts)), "i long, s string")
    sinks.write_csv(frame, str(tmp_path / "out"))
    assert sources.written_csv(spark, str(tmp_path / "out"), frame.schema).sort("i").collect() == frame.sort("i").collect()


@pytest.mark.parametrize("shape", ["file", "folder", "nested"])
def test_text_sink_reads_tables_of_any_shape(spark, tmp_path, shape):
    import shutil
    from pathlib import Path

    import __spark_entry__ as entry

    source, target = Path("/root/testdata/sf0.001/events.parquet"), tmp_path / "events.parquet"
    if shape == "file":
        shutil.copyfile(source, target)
    else:
        place = target / "day=1" / "hour=2" if shape == "nested" else target
        place.mkdir(parents=True)
        shutil.copyfile(source, place / "part-0.parquet")
    for name in ("sink_text_files", "src_replay_clicks"):
        assert entry.queries()[name](spark, str(tmp_path)).count() == spark.read.parquet(str(source)).count()


# --- NULLs, and work that grows with what is there ----------------------------------------------------


def test_reconcile_tells_sides_of_rows_without_a_key(spark):
    from datetime import datetime, timedelta

    from tidemark.operators import joins

    at = datetime(2024, 1, 1)
    app = spark.createDataFrame([(None, at), ("k", at), ("t", None)], "a_key string, a_ts timestamp")
    platform = spark.createDataFrame([(None, at), ("k", at + timedelta(seconds=1)), ("u", at)], "p_key string, p_ts timestamp")
    found = joins.reconcile(app, platform, ("a_key", "p_key"), ("a_ts", "p_ts")).collect()
    assert sorted((r.a_key, r.p_key, r.status) for r in found if r.status == "success") == [("k", "k", "success")]
    missing = sorted((r.a_key or r.p_key or "", r.status) for r in found if r.status != "success")
    assert missing == [("", "app_missing"), ("", "platform_missing"), ("t", "platform_missing"), ("u", "app_missing")]


def test_periodic_counts_of_missing_times_and_keys(spark):
    from datetime import timedelta

    from tidemark.operators import timers
    from tidemark.operators.ordered import MAX_ROWS_CONF

    rows = [(1, 0), (1, 5), (1, 10), (1, 11), (1, None), (None, 3), (None, 30), (None, None), (2, None)]
    df = spark.createDataFrame(rows, "k long, timestamp long")
    want = [(1, 10, 3), (1, 21, 4), (None, 13, 1), (None, 40, 2)]
    for limit in ("1000", "1"):  # walked; and by successors
        spark.conf.set(MAX_ROWS_CONF, limit)
        found = timers.periodic_count(df, "k", "timestamp", timedelta(milliseconds=10)).collect()
        assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    spark.conf.unset(MAX_ROWS_CONF)
    assert timers.periodic_count(df.where("false"), "k").collect() == []


def test_periodic_counts_of_one_key_with_all_rows(spark):
    """One key's ticks by successors and doubling are those of a walk, over many rounds."""
    import random
    from datetime import timedelta

    from tidemark.operators import timers
    from tidemark.operators.ordered import MAX_ROWS_CONF

    rng = random.Random(1)
    df = spark.createDataFrame([(7, rng.randrange(4000)) for _ in range(1500)], "k long, timestamp long")
    walked = sorted(map(tuple, timers.periodic_count(df, "k", "timestamp", timedelta(milliseconds=10)).collect()))
    spark.conf.set(MAX_ROWS_CONF, "400")
    doubled = sorted(map(tuple, timers.periodic_count(df, "k", "timestamp", timedelta(milliseconds=10)).collect()))
    spark.conf.unset(MAX_ROWS_CONF)
    assert doubled == walked and len(walked) > 200


def test_cumulative_windows_make_one_row_a_step(spark):
    """Steps of a window are made from their numbers: one row each, however many a window has."""
    from datetime import datetime, timedelta

    from tidemark.operators import windows

    start = datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", start + timedelta(seconds=i * 7)) for i in range(2000)], "user string, ts timestamp")
    found = windows.cumulate_count(df, "ts", timedelta(seconds=15), timedelta(hours=24)).collect()
    assert len(found) == 24 * 240
    for r in found[:: len(found) // 50]:
        assert r.cnt == min(2000, -(-int((r.window_end - start).total_seconds()) // 7))


def test_top_n_changelog_against_sorting(spark, tiny_slices):
    import random

    from tidemark.operators import changelog

    rng = random.Random(4)
    users = [rng.choice(["a", "b", "c", "d", None]) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(users)), "seq long, user string")
    counts, reached, places, want = {}, {}, [], []
    for seq, user in enumerate(users):
        counts[user], reached[user] = counts.get(user, 0) + 1, seq
        now = sorted(((n, u) for u, n in counts.items()), key=lambda x: (-x[0], reached[x[1]]))[:3]
        for i, (n, u) in enumerate(now):
            old = places[i] if i < len(places) else None
            if old is None:
                want.append((seq, i + 1, 0, "+I", u, n))
            elif old != (n, u):
                want += [(seq, i + 1, 0, "-U", old[1], old[0]), (seq, i + 1, 1, "+U", u, n)]
        places = now
    found = changelog.top_n_changelog(df, "user", "seq", 3).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


def test_union_watermark_waits_for_every_input(spark, tiny_slices):
    from datetime import timedelta

    from tidemark.operators import joins

    left = spark.createDataFrame([(1, 100), (2, 90), (5, None), (6, 300)], "n long, ts long")
    right = spark.createDataFrame([(3, 50), (4, 200)], "n long, ts long")
    found = joins.union_watermark([left, right], ["n"], "ts", timedelta(milliseconds=10)).collect()
    assert sorted((r.n, r.lane, r.watermark) for r in found) == [(1, 0, None), (2, 0, None), (3, 1, None), (4, 1, 40), (5, 0, 90), (6, 0, 90)]
