from __future__ import annotations

import hashlib

import numpy as np
import pytest
from helpers import documents, prose, shingle_set

from tidemark.llm import fingerprints as FP


def _rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def _brute(texts: list[str]) -> list[tuple[str, str]]:
    out = []
    for i, text in enumerate(texts):
        following, k = texts[(i + 1) % len(texts)], len(text) // 4
        out.append((text[: len(text) - k] + following[:k], following))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    out = [" ".join(prose(rng, int(n))) for n in rng.integers(1, 900, 60)]
    out[7] = out[6]
    return [*out, "", "é ß 𝕏 ünï code a b c d e", "one two", "   ", "word " * 3000]


@pytest.mark.parametrize("rows_per_range", [4000, 3])
def test_edited_texts_and_likeness(spark, texts, rows_per_range, monkeypatch):
    monkeypatch.setattr(FP, "ROWS_PER_RANGE", rows_per_range)
    ids = [3 * i - 20 for i in range(len(texts))]
    got = _rows(FP.compared(documents(spark, list(zip(ids, texts)))).select("*", FP.likeness(_c("sketch"), _c("edited_sketch")).alias("near"), FP.printed(_c("sketch")).alias("p")))
    assert set(got) == set(ids)
    for i, (text, (edited, _)) in enumerate(zip(texts, _brute(texts))):
        row = got[ids[i]]
        assert (row.n_chars, row.edited) == (len(text), edited)
        a, b = shingle_set(text.lower()), shingle_set(edited.lower())
        if len(a) > 200:
            assert abs(row.near - len(a & b) / len(a | b)) < 0.2
        assert 0 <= row.near <= 1
    assert got[ids[6]].p == got[ids[7]].p
    assert hashlib.sha256(got[ids[0]].edited.encode()).hexdigest()


def _c(name):
    from pyspark.sql import functions as F

    return F.col(name)


def test_sketches_are_those_hashes_below_the_threshold_and_merge(spark, texts):
    rows = documents(spark, [(1, texts[0] + " " + texts[1]), (2, texts[0]), (3, None)])
    every = _rows(FP.with_sketch(rows, _c("text"), "s", scale=1))
    some = _rows(FP.with_sketch(rows, _c("text"), "s", scale=4))
    for i in (1, 2, 3):
        limit = (1 << 63) // 4
        assert some[i].s.hashes == [h for h in every[i].s.hashes if (h & (2**64 - 1)) >> 1 < limit]
    sketched = FP.with_sketch(rows, _c("text"), "sketch").withColumn("g", _c("doc_id") * 0)
    union = {r.hash for r in FP.merged(sketched, "g").collect()}
    assert union == set(some[1].s.hashes) | set(some[2].s.hashes)


def test_containment_between_unequal_documents(spark):
    rng = np.random.default_rng(6)
    long = prose(rng, 20_000, 100_000)
    rows = documents(spark, [(1, " ".join(long[4000:4800])), (2, " ".join(long))])
    pair = FP.with_sketch(rows, _c("text"), "s")
    a, b = pair.where("doc_id = 1").select(_c("s").alias("a")), pair.where("doc_id = 2").select(_c("s").alias("b"))
    row = a.join(b).select(FP.containment(_c("a"), _c("b")).alias("x"), FP.containment(_c("b"), _c("a")).alias("y")).first()
    assert row.x == 1 and row.y < 0.08


def test_odd_tables(spark):
    empty = documents(spark, [])
    assert FP.compared(empty).collect() == []
    one = FP.compared(documents(spark, [(None, "abcdefgh")])).collect()
    assert [(r.doc_id, r.edited) for r in one] == [(None, "abcdefab")]
    odd = documents(spark, [(1, None), (1, None), (None, "x y z w"), (5, "q")])
    assert sorted((r.doc_id or 0, r.n_chars, r.edited) for r in FP.compared(odd).collect()) == [(0, 7, "x y z "), (1, 0, ""), (1, 0, ""), (5, 1, "q")]
    clash = documents(spark, [(1, "a b", 2, "c")], "doc_id long, text string, n_chars long, edited string")
    assert FP.compared(clash).first().n_chars == 3
