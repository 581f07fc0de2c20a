from __future__ import annotations

import hashlib
import zlib

import pytest
from helpers import documents

from tidemark.llm import warc

SCHEMA = "page_id long, url string, html string"


def test_pages_come_back_as_captures(spark):
    body = "<p>é</p>" * 30
    rows = [(5, "http://a/ b\n", body), (2, "http://b/", body), (9, None, body), (1, "u", "short"), (3, "v", "short"), (4, "w", None), (None, "x", body), (2, "http://b/", body)]
    whole = warc.captures(warc.read(warc.write(documents(spark, rows, SCHEMA)))).collect()
    got = []
    for r in whole:
        notes = {n["key"]: n["value"] for n in r.metadata.notes}
        page, first = notes.get("page-id"), notes.get("refers-to-page-id")
        got.append((page, r.response.type, first, r.response.payload_bytes, r.response.payload_digest))
        assert (r.requests, r.metadata_records) == (1, 1)
        assert r.request.first_line.startswith("GET ") and (r.response.payload is None) == (r.response.type == "revisit")
    size, digest = len(body.encode()), hashlib.sha256(body.encode()).hexdigest()
    small = [hashlib.sha256(t).hexdigest() for t in (b"short", b"")]
    want = [("5", "revisit", "2", size, digest), ("2", "response", None, size, digest), ("2", "response", None, size, digest)]
    want += [("9", "revisit", "2", size, digest), (None, "revisit", "2", size, digest)]
    want += [("1", "response", None, 5, small[0]), ("3", "response", None, 5, small[0]), ("4", "response", None, 0, small[1])]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {r.response.uri for r in whole} == {"http://a/%20b%0A", "http://b/", None, "u", "v", "w", "x"}


def _record(kind, name, *named):
    lines = "".join(f"WARC-Concurrent-To: <{n}>\r\n" for n in named)
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{name}>\r\n{lines}Content-Length: 2\r\n\r\nhi\r\n\r\n".encode()


def _captured(spark, path, *records):
    path.write_bytes(b"".join(_record(*r) for r in records))
    archives = spark.createDataFrame([(path.as_uri(),)], "address string")
    return {r.capture_id: (r.response and r.response.type, r.requests, r.metadata_records) for r in warc.captures(warc.read(archives)).collect()}


def test_companions_by_either_pointer_and_orphans(spark, tmp_path):
    got = _captured(
        spark, tmp_path / "plain.warc", ("warcinfo", "i"), ("request", "q1"), ("response", "r1", "q1", "m1"), ("metadata", "m1"),
        ("metadata", "m2", "r1"), ("request", "lost"), ("resource", "r2"),
    )
    assert got == {"r1": ("response", 1, 2), "r2": ("resource", None, None), "lost": (None, 1, 0)}


def test_any_identifier_and_chains_lead_to_the_response(spark, tmp_path):
    second = _captured(spark, tmp_path / "a.warc", ("request", "q", "m", "r"), ("response", "r"), ("metadata", "m", "r"))
    assert second == {"r": ("response", 1, 1)}
    chain = _captured(
        spark, tmp_path / "b.warc", ("response", "r1"), ("metadata", "m1", "m2"), ("metadata", "m2", "m3"), ("metadata", "m3", "q1"), ("request", "q1", "r1"),
        ("response", "r2", "q2"), ("request", "q2", "m4"), ("metadata", "m4"), ("metadata", "m5", "r2", "r1"),
    )
    assert chain == {"r1": ("response", 1, 4), "r2": ("response", 1, 1)}
    absent = _captured(
        spark, tmp_path / "c.warc", ("request", "q1", "gone"), ("metadata", "m1", "q1"), ("request", "q2", "m2"), ("metadata", "m2", "q2"),
        ("request", "q3", "q3"), ("response", "r"), ("response", "r", "q4"), ("request", "q4"), ("request", "q4"),
    )
    got = _captured(spark, tmp_path / "d.warc", ("response", "r"), ("response", "r"), ("request", "q", "r"))
    assert absent == {"gone": (None, 1, 1), "m2": (None, 1, 1), "q3": (None, 1, 0), "r": ("response", 2, 0)}
    assert got == {"r": ("response", 1, 0)}


def test_a_record_without_length_is_an_error(tmp_path):
    path = tmp_path / "x.warc"
    path.write_bytes(_record("response", "r").replace(b"Content-Length: 2", b"Other: 2"))
    with pytest.raises(ValueError, match="content-length"):
        list(warc.records(path.as_uri()))


def test_a_cut_archive_is_an_error(tmp_path):
    whole = warc._transaction("n", 1, "u", b"x" * 500, "d", None, None)
    path = tmp_path / "cut.warc.gz"
    path.write_bytes(whole)
    assert [r["type"] for r in warc.records(path.as_uri())] == ["request", "response", "metadata"]
    path.write_bytes(whole[:-30])
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.records(path.as_uri()))


def test_what_stands_behind_a_member_is_not_copied_for_each(tmp_path, monkeypatch):
    data = b"".join(warc._transaction("n", i, "u", b"%d" % i, "d", None, None) for i in range(300))
    path, given = tmp_path / "many.warc.gz", []
    path.write_bytes(data)

    class Counting:
        def __init__(self, bits):
            self._own = zlib.decompressobj(bits)

        def decompress(self, packed, most):
            given.append(len(packed))
            return self._own.decompress(packed, most)

        def __getattr__(self, name):
            return getattr(self._own, name)

    monkeypatch.setattr(warc, "zlib", type("Zlib", (), {"decompressobj": Counting}))
    read = [r for r in warc.records(path.as_uri()) if r["type"] == "response"]
    assert [r["payload"] for r in read] == [b"%d" % i for i in range(300)]
    assert sum(given) < len(data) + 900 * 10_000  # not the rest of the file for each of 900 members


@pytest.mark.parametrize("feed", [1, 7, 1 << 13])
@pytest.mark.parametrize("chunk", [3, 1 << 20])
def test_records_do_not_depend_on_how_archives_are_cut(tmp_path, monkeypatch, feed, chunk):
    path = tmp_path / "some.warc.gz"
    path.write_bytes(b"".join(warc._transaction("n", i, f"u{i}", bytes(range(256)) * i, "d", None, None) for i in range(4)))
    want = list(warc.records(path.as_uri()))
    assert [r["type"] for r in want] == ["request", "response", "metadata"] * 4
    monkeypatch.setattr(warc, "_FEED_BYTES", feed)
    monkeypatch.setattr(warc, "_READ_BYTES", chunk)
    monkeypatch.setattr(warc, "_WAIT_BYTES", 5)
    assert list(warc.records(path.as_uri())) == want
    path.write_bytes(path.read_bytes()[:-30])
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.records(path.as_uri()))


def test_no_pages(spark):
    assert warc.captures(warc.read(warc.write(documents(spark, [], SCHEMA)))).collect() == []
