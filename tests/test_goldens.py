"""Small literal inputs with results worked out by hand (see FIXTURES.md)."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import functions, schemas
from tidemark.operators import changelog, joins, keyed, over, partitioning, patterns, rows, rules, timers, topn, windows
from tidemark.sources import files

CLICKS = """Alice, ./home, 1000
Alice, ./user, 4000
Judy, ./prod?id=100, 1000
Eric, ./user, 1000
Tom, ./cart, 1000
Bob, ./user, 2000
Bob, ./prod?id=20, 4000
Bob, ./cart, 6000
Mary,./home, 11000
Mary,./cart, 13000
Tom, ./home, 15100"""

SEVEN = [
    ("Tom", "./cart", 1000),
    ("Tom", "./home", 20000),
    ("Judy", "./home", 3000),
    ("Judy", "./home", 4000),
    ("Martin", "./home", 5000),
    ("Martin", "./cart", 6000),
    ("Martin", "./prod", 7000),
]


def seconds(*columns):
    return [F.unix_seconds(c).alias(c) for c in columns]


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(params=["whole", "sliced"], autouse=True)
def slicing(request):
    if request.param == "sliced":
        request.getfixturevalue("tiny_slices")


@pytest.fixture
def clicks(spark, tmp_path):
    (tmp_path / "clicks.txt").write_text(CLICKS)
    return files.with_rowtime(files.csv_table(spark, str(tmp_path / "clicks.txt"), view="clicks"))


@pytest.fixture
def seven(spark):
    frame = spark.createDataFrame(SEVEN, schemas.EVENT)
    return frame.withColumn("seq", F.element_at(F.create_map(*[F.lit(x) for i, e in enumerate(SEVEN) for x in (f"{e[0]}{e[2]}", i)]), F.concat("user", "timestamp")).cast("long"))


def at_seconds(spark, rows_, *names):
    """Rows whose last column is epoch milliseconds, as a timestamp."""
    frame = spark.createDataFrame(rows_, list(names))
    return frame.withColumn(names[-1], F.timestamp_millis(names[-1]))


def test_clicks_counts(clicks, spark):
    expected = [("Alice", 2), ("Bob", 3), ("Eric", 1), ("Judy", 1), ("Mary", 2), ("Tom", 2)]
    assert tuples(keyed.count_by(clicks, ["user_name"])) == expected
    assert tuples(spark.sql("SELECT user_name, count(1) FROM clicks GROUP BY user_name")) == expected
    assert rows.where_equal(clicks, "user_name", "Bob").count() == 3


def test_clicks_windows(clicks):
    tumble = windows.tumble_count(clicks, "et", keys=["user_name"]).select(*seconds("window_end"), "user_name", "cnt")
    first = [(10, "Alice", 2), (10, "Bob", 3), (10, "Eric", 1), (10, "Judy", 1), (10, "Tom", 1)]
    assert tuples(tumble) == [*first, (20, "Mary", 2), (20, "Tom", 1)]

    hop = windows.hop_count(clicks, "et", keys=["user_name"]).select(*seconds("window_end"), "user_name", "cnt")
    early = [(5, "Alice", 2), (5, "Bob", 2), (5, "Eric", 1), (5, "Judy", 1), (5, "Tom", 1)]
    late = [(15, "Bob", 1), (15, "Mary", 2), (20, "Mary", 2), (20, "Tom", 1), (25, "Tom", 1)]
    assert tuples(hop) == sorted(early + first + late, key=repr)

    cumulate = windows.cumulate_count(clicks, "et", keys=["user_name"]).select(*seconds("window_end"), "user_name", "cnt")
    assert tuples(cumulate) == sorted([*early, *first, (15, "Mary", 2), (20, "Mary", 2), (20, "Tom", 1)], key=repr)


def test_clicks_over(clicks):
    averaged = over.average_of_last(clicks, ["user_name"], ["ts"]).select("user_name", "avg_ts")
    expected = [("Alice", 1000), ("Alice", 2500), ("Bob", 2000), ("Bob", 3000), ("Bob", 4000), ("Eric", 1000), ("Judy", 1000)]
    expected += [("Mary", 11000), ("Mary", 12000), ("Tom", 1000), ("Tom", 8050)]
    assert tuples(averaged) == sorted([(u, float(a)) for u, a in expected], key=repr)

    counted = over.count_and_max_of_last(clicks, ["user_name"], ["ts"]).select("user_name", "cnt", "max_ts")
    expected = [("Alice", 1, 1000), ("Alice", 2, 4000), ("Bob", 1, 2000), ("Bob", 2, 4000), ("Bob", 3, 6000), ("Eric", 1, 1000)]
    expected += [("Judy", 1, 1000), ("Mary", 1, 11000), ("Mary", 2, 13000), ("Tom", 1, 1000), ("Tom", 2, 15100)]
    assert tuples(counted) == sorted(expected, key=repr)


def test_clicks_top(clicks):
    assert tuples(topn.top_keys(clicks, "user_name")) == [("Alice", 2, 2), ("Bob", 3, 1)]
    ranked = topn.top_per_tumble(clicks, "et", key="user_name").select(*seconds("window_end"), "user_name", "cnt")
    assert tuples(ranked) == [(10, "Alice", 2), (10, "Bob", 3), (20, "Mary", 2), (20, "Tom", 1)]
    values = topn.top_values(windows.tumble_count(clicks, "et", keys=["user_name"])).select(*seconds("window_end"), "value", "rank")
    assert tuples(values) == [(10, 2, 2), (10, 3, 1), (20, 1, 2), (20, 2, 1)]


def test_clicks_functions(clicks, spark):
    averages = clicks.groupBy("user_name").agg(functions.weighted_average("ts", F.lit(1)).alias("a"))
    assert tuples(averages) == [("Alice", 2500), ("Bob", 4000), ("Eric", 1000), ("Judy", 1000), ("Mary", 12000), ("Tom", 8050)]
    assert functions.split_words(clicks).count() == 13
    functions.register_functions(spark)
    assert spark.sql("SELECT MyHash('Alice')").first()[0] == 63350368
    assert clicks.select(functions.string_hash("user_name")).distinct().count() == 6


def test_weighted_average_of_nothing_is_null(spark):
    frame = spark.createDataFrame([(1, 0), (2, 0)], "v long, w long")
    assert frame.agg(functions.weighted_average("v", "w")).first()[0] is None


def test_hash_variants_agree(spark):
    texts = ["", "Alice", "Grüße", "日本", "a\U0001f600b", "x" * 500]
    frame = spark.createDataFrame([(t,) for t in texts], "s string")
    functions.register_functions(spark)
    found = frame.select("s", functions.string_hash("s"), F.expr("MyHash(s)")).collect()
    assert len(found) == len(texts)
    assert all(r[1] == r[2] for r in found)


def test_split_drops_trailing_empty_parts(spark):
    frame = spark.createDataFrame([("a?b??",), ("??",), ("",), ("?x",), ("plain",), (None,)], "url string")
    functions.register_functions(spark)
    frame.createOrReplaceTempView("urls")
    expected = sorted([("a?b??", "a", 1), ("a?b??", "b", 1), ("", "", 0), ("?x", "", 0), ("?x", "x", 1), ("plain", "plain", 5)], key=repr)
    assert tuples(functions.split_words(frame)) == expected
    lateral = "SELECT url, t.* FROM (SELECT url, MySplit(url) AS parts FROM urls), LATERAL inline(parts) AS t"
    assert tuples(spark.sql(lateral)) == expected


def test_words(spark, tmp_path):
    (tmp_path / "words.txt").write_text("Hello Word Java Scala\nHello Word Java Scala\nHello Word\nHello\nWord\n")
    counted = keyed.count_by(rows.words(files.text_lines(spark, str(tmp_path / "words.txt"))), ["word"])
    assert tuples(counted) == [("Hello", 4), ("Java", 2), ("Scala", 2), ("Word", 4)]


def test_seven_events(seven):
    final = keyed.max_field(seven, ["user"], "timestamp", ["seq"], ["url"])
    assert tuples(final) == [("Judy", "./home", 4000), ("Martin", "./home", 7000), ("Tom", "./cart", 20000)]
    best = keyed.max_row(seven, ["user"], "timestamp", "seq").select("user", "url", "timestamp")
    assert tuples(best) == [("Judy", "./home", 4000), ("Martin", "./prod", 7000), ("Tom", "./home", 20000)]
    leaders = keyed.most_active_running(seven, "user", "seq").orderBy("seq").collect()
    expected = [("Tom", 1), ("Tom", 2), ("Tom", 2), ("Judy", 2), ("Judy", 2), ("Martin", 2), ("Martin", 3)]
    assert [(r["leader"], r["leader_cnt"]) for r in leaders] == expected
    assert tuples(keyed.most_active(seven, "user", "seq")) == [("Martin", 3)]
    assert [r[0] for r in tuples(rows.text_length(seven))] == [3, 3, 4, 4, 6, 6, 6]


def test_flatmap(spark):
    events = spark.createDataFrame([("Tom", "./cart", 10000), ("Judy", "./home", 20000), ("Martin", "./home", 4000)], schemas.EVENT)
    assert rows.flatmap_fields(events).count() == 9
    assert ("Tom -- ./cart -- 10000",) in tuples(rows.flatmap_concat(events))
    assert tuples(rows.flatmap_conditional(events, F.col("user") == "Tom")) == [("./cart",), ("10000",), ("20000",), ("4000",)]


def test_changelog(spark):
    users = ["Alice", "Bob", "Alice", "Cary", "Bob", "Alice"]
    frame = spark.createDataFrame(list(enumerate(users)), "seq long, user string")
    changes = changelog.count_changelog(frame, ["user"], ["seq"]).orderBy("seq", "part").select("op", "user", "cnt").collect()
    assert [tuple(r) for r in changes] == [
        ("+I", "Alice", 1),
        ("+I", "Bob", 1),
        ("-U", "Alice", 1),
        ("+U", "Alice", 2),
        ("+I", "Cary", 1),
        ("-U", "Bob", 1),
        ("+U", "Bob", 2),
        ("-U", "Alice", 2),
        ("+U", "Alice", 3),
    ]


LEFT = [("Tom", 1000), ("Jerry", 1000), ("Tom", 2000), ("Jerry", 2000), ("Jerry", 5100)]
RIGHT = [("Tom", 3000), ("Jerry", 4000), ("Tom", 4500), ("Jerry", 5000)]


def test_window_join(spark):
    left, right = at_seconds(spark, LEFT, "lk", "lt"), at_seconds(spark, RIGHT, "rk", "rt")
    joined = joins.window_join(left, right, ("lk", "rk"), ("lt", "rt")).select(*seconds("window_start"), "lk")
    assert tuples(joined) == [(0, "Jerry")] * 2 + [(0, "Tom")] * 4 + [(5, "Jerry")]


def test_window_cogroup(spark):
    left, right = (
        at_seconds(spark, side, "key", "ts").withColumn("ms", F.unix_millis("ts")) for side in (LEFT, RIGHT[:3])
    )
    members = joins.window_cogroup(left, right, "key", "ts", ["ms"], "ms")
    assert tuples(members.select("key", *seconds("window_start"), "side", "position", "value")) == [
        ("Jerry", 0, "left", 0, 1000),
        ("Jerry", 0, "left", 1, 2000),
        ("Jerry", 0, "right", 0, 4000),
        ("Jerry", 5, "left", 0, 5100),
        ("Tom", 0, "left", 0, 1000),
        ("Tom", 0, "left", 1, 2000),
        ("Tom", 0, "right", 0, 3000),
        ("Tom", 0, "right", 1, 4500),
    ]
    counts = joins.window_cogroup_counts(left, right, "key", "ts").select("key", *seconds("window_start"), "left_rows", "right_rows")
    assert tuples(counts) == [("Jerry", 0, 2, 1), ("Jerry", 5, 1, 0), ("Tom", 0, 2, 2)]


def test_window_cogroup_has_one_shape_at_every_size(spark):
    left = spark.range(25_000).selectExpr("'k' AS key", "timestamp_seconds(1) AS ts", "id AS ms")
    right = spark.range(3).selectExpr("'k' AS key", "timestamp_seconds(2) AS ts", "id AS ms")
    members = joins.window_cogroup(left, right, "key", "ts", ["ms"], "ms")
    assert members.where("position = value").groupBy("side").count().sort("side").collect() == [("left", 25_000), ("right", 3)]
    assert joins.window_cogroup_counts(left, right, "key", "ts").select("left_rows", "right_rows").collect() == [(25_000, 3)]


def test_interval_join(spark):
    left = at_seconds(spark, [("Mary", 5000), ("Alice", 5000), ("Bob", 20000), ("Alice", 20000), ("Cary", 51000)], "lk", "lt")
    right = at_seconds(
        spark,
        [("Bob", 2000), ("Alice", 3000), ("Alice", 3500), ("Bob", 2500), ("Alice", 36000), ("Bob", 31000), ("Bob", 17000), ("Bob", 15000)],
        "rk",
        "rt",
    )
    joined = joins.interval_join(left, right, ("lk", "rk"), ("lt", "rt"))
    found = joined.select("lk", F.unix_millis("lt").alias("l"), F.unix_millis("rt").alias("r"))
    assert tuples(found) == [("Alice", 5000, 3000), ("Alice", 5000, 3500), ("Bob", 20000, 15000), ("Bob", 20000, 17000)]


def test_bill_check(spark):
    app = at_seconds(spark, [("order-1", 1000), ("order-2", 2000), ("order-3", 3500)], "ak", "at")
    platform = at_seconds(spark, [("order-1", 3000), ("order-3", 4000)], "pk", "pt")
    found = joins.reconcile(app, platform, ("ak", "pk"), ("at", "pt")).select("ak", "status")
    assert tuples(found) == [("order-1", "success"), ("order-2", "platform_missing"), ("order-3", "success")]


def test_unbounded_join_and_connect(spark):
    left = spark.createDataFrame([("a", 1000), ("b", 2000), ("a", 3000)], "lk string, lt long")
    right = spark.createDataFrame([("a", 3000), ("b", 4000), ("a", 6000), ("d", 7000)], "rk string, rt long")
    assert [r[0] for r in tuples(joins.unbounded_join(left, right, ("lk", "rk")))] == ["a"] * 4 + ["b"]
    ints, longs = spark.range(1, 4), spark.range(4, 7)
    mapped = joins.connect_map(ints, longs, F.concat(F.lit("Integer: "), "id"), F.concat(F.lit("Long: "), "id"))
    assert tuples(mapped) == [(f"Integer: {i}",) for i in (1, 2, 3)] + [(f"Long: {i}",) for i in (4, 5, 6)]


LOGINS = [("user_1", "fail", 2000), ("user_1", "fail", 3000), ("user_2", "fail", 4000), ("user_1", "fail", 5000)]
LOGINS += [("user_2", "fail", 7000), ("user_2", "fail", 8000), ("user_2", "success", 6000)]


def test_login_failures(spark):
    frame = spark.createDataFrame([(i, *login) for i, login in enumerate(LOGINS)], "seq long, user_id string, event_type string, ts long")
    failed = F.col("event_type") == "fail"
    matches = patterns.consecutive(frame, ["user_id"], ["ts", "seq"], failed)
    assert tuples(matches) == [("user_1", 2000, 3000, 5000)]
    assert tuples(patterns.alert_text(matches, "user_id")) == [("user_1 failed 3 times in a row: 2000, 3000, 5000",)]
    timed = frame.withColumn("et", F.timestamp_millis("ts"))
    chosen = patterns.combinations(timed, "user_id", "et", "seq", failed, timedelta(seconds=10))
    # also the runs that the success of user_2 interrupts
    assert tuples(chosen.select("user_id", "seq_1", "seq_2", "seq_3")) == [("user_1", 0, 1, 3), ("user_2", 2, 4, 5)]


def test_order_timeout(spark):
    orders = [("order_1", "create", 1000), ("order_2", "create", 2000), ("order_1", "modify", 10000), ("order_1", "pay", 60000)]
    orders += [("order_3", "create", 600000), ("order_3", "pay", 1200000)]
    frame = spark.createDataFrame([(i, *o) for i, o in enumerate(orders)], "seq long, order_id string, event_type string, ts long")
    found = patterns.followed_by(frame, ["order_id"], ["ts", "seq"], F.col("event_type") == "create", F.col("event_type") == "pay")
    assert tuples(found) == [
        ("order_1", 1000, 60000, "paid"),
        ("order_2", 2000, None, "timeout"),
        ("order_3", 600000, 1200000, "paid"),
    ]


@pytest.mark.parametrize(("mode", "expected"), [("all", [("Alice", "pay"), ("Bob", "order")]), ("latest", [("Bob", "order")])])
def test_behavior_rules(spark, mode, expected):
    actions = [("Alice", "login", 0), ("Alice", "pay", 1), ("Bob", "login", 2), ("Bob", "order", 3)]
    frame = spark.createDataFrame(actions, schemas.ACTION)
    loaded = spark.createDataFrame([("login", "pay", 0), ("login", "order", 1)], schemas.RULE)
    found = rules.behavior_pattern(frame, loaded, "user_id", ["seq"], mode=mode)
    assert tuples(found.select("user_id", "action2")) == expected


def test_event_time_timers(spark):
    frame = at_seconds(spark, [("Mary", 1000), ("Alice", 11000), ("Bob", 11001)], "user", "ts")
    fires = timers.event_time_timers(frame, "user", "ts").where("kind = 'fire'")
    assert tuples(fires.select("user", F.unix_millis("at"))) == [("Alice", 21000), ("Bob", 21001), ("Mary", 11000)]


def test_custom_partitioner(spark):
    placed = partitioning.with_partition(partitioning.custom(spark.range(1, 9), 2, F.col("id") % 2))
    assert tuples(placed) == [(i, i % 2) for i in range(1, 9)]


def test_split_routes(seven):
    routes = {"tom": F.col("user") == "Tom", "judy": F.col("user") == "Judy"}
    assert {name: df.count() for name, df in joins.split(seven, routes).items()} == {"tom": 2, "judy": 2, "main": 3}


def test_rowtime_is_cut_to_seconds(clicks):
    found = clicks.where("ts = 15100").select(F.col("et").cast("timestamp_ntz")).first()[0]
    assert found == datetime(1970, 1, 1, 0, 0, 15)
