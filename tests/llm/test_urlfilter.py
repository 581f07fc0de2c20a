from __future__ import annotations

import numpy as np
from helpers import documents
from pyspark.sql import functions as F

from tidemark.llm import urlfilter as U

EVENT = "entry string, category string, action string, at long"
CAPTURE = "id long, url string, fetched_at long"


def test_keys_of_urls(spark):
    urls = ["HTTP://User@WWW.Ex.com:80/A/b//c?x=/y#z", "https://ex.com", "mailto:x@ex.com", None, "/rel/path", "http://[::1]:8/p", "ftp://ex.com./q/"]
    got = [r.k for r in documents(spark, [(u,) for u in urls], "url string").select(U.keys(F.col("url"), 2, 2).alias("k")).collect()]
    assert got == [["com", "ex.com", "www.ex.com/A", "www.ex.com/A/b"], ["com", "ex.com"], [], [], [], ["[::1]", "[::1]/p"], ["com", "ex.com", "ex.com/q"]]


def test_events_become_disjoint_intervals(spark):
    rows = [("a.com", "x", "add", 5), ("a.com", "x", "add", 5), ("a.com", "y", "add", 9), ("A.com", None, "remove", 12), ("a.com", "z", "add", 20),
            ("b.com", "x", "remove", 3), (None, "x", "add", 1), ("c.com", "x", "add", None), ("c.com", "x", "drop", 4), ("d.com", "x", "remove", 7), ("d.com", "x", "add", 7)]
    got = sorted((tuple(r) for r in U.intervals(documents(spark, rows, EVENT)).collect()), key=repr)
    assert got == [("a.com", "x", 5, 9), ("a.com", "y", 9, 12), ("a.com", "z", 20, None), ("d.com", "x", 7, None)]


def test_captures_meet_what_was_listed_then(spark):
    rng = np.random.default_rng(7)
    entries = ["com", "ex.com", "a.ex.com", "ex.com/p", "ex.com/p/q", "other.org"]
    events = [(entries[i], f"c{k}", ["add", "remove"][k], int(t)) for i, k, t in zip(rng.integers(0, 6, 80), rng.integers(0, 2, 80), rng.integers(0, 400, 80), strict=True)]
    urls = ["http://ex.com/p/q/r", "http://a.ex.com/", "http://ex.com/pq", "http://other.org/p", "http://none.net/", None, "junk"]
    captures = [(i, urls[i % 7], int(rng.integers(-20, 450))) for i in range(140)] + [(140, urls[0], None), (3, urls[3], 77), (3, urls[3], 77)]
    listed = U.intervals(documents(spark, events, EVENT)).persist()
    spans = [tuple(r) for r in listed.collect()]
    covers = lambda entry, url: url and any(entry == k for k in {"http://ex.com/p/q/r": ["com", "ex.com", "ex.com/p", "ex.com/p/q"], "http://a.ex.com/": ["com", "ex.com", "a.ex.com"], "http://ex.com/pq": ["com", "ex.com"], "http://other.org/p": ["other.org"]}.get(url, []))
    want = []
    for i, url, at in captures:
        found = [s for s in spans if at is not None and covers(s[0], url) and s[2] <= at and (s[3] is None or at < s[3])]
        best = max(found, key=lambda s: (len(s[0]), s[0]), default=(None,) * 4)
        want.append((i, url, at, bool(found), *best))
    for slot in (U.SLOT_SECONDS, 13):
        got = [tuple(r) for r in U.judged(documents(spark, captures, CAPTURE), listed, slot=slot).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_empty_sides_and_clashing_names(spark):
    none = U.intervals(documents(spark, [], EVENT))
    clash = documents(spark, [(1, "http://a.com/", 5, "mine")], CAPTURE + ", category string")
    assert [tuple(r) for r in U.judged(clash, none).collect()] == [(1, "http://a.com/", 5, False, None, None, None, None)]
    some = U.intervals(documents(spark, [("a.com", "x", "add", 1)], EVENT))
    assert U.judged(documents(spark, [], CAPTURE), some).collect() == []
    assert U.judged(clash, some).first().category == "x"


def test_paths_tell_cases_apart_and_hosts_do_not(spark):
    listed = U.intervals(documents(spark, [("A.com/Foo", "x", "add", 1)], EVENT))
    captures = [(1, "http://a.com/Foo", 5), (2, "http://A.COM/Foo/b", 5), (3, "http://a.com/foo", 5)]
    assert {r.id: r.entry for r in U.judged(documents(spark, captures, CAPTURE), listed).collect()} == {1: "a.com/Foo", 2: "a.com/Foo", 3: None}


def test_columns_named_like_ours_and_times_far_off(spark):
    listed = U.intervals(documents(spark, [("a.com", "x", "add", 1), ("b.com", "y", "add", 9 * 10**9)], EVENT))
    rows = [(i, "http://a.com/", 1000 + i, "e", "c", "s", "u", "k") for i in range(20)]
    rows += [(20, "http://a.com/", 253_000_000_000, "e", "c", "s", "u", "k"), (21, "http://b.com/", 253_000_000_000, None, None, None, None, None), (22, "http://b.com/", -(10**12), "", "", "", "", "")]
    found = U.judged(documents(spark, rows, CAPTURE + ", e string, c string, s string, u string, k string"), listed, slot=10)
    assert {r.id: r.entry for r in found.collect()} == {**dict.fromkeys(range(21), "a.com"), 21: "b.com", 22: None}
