"""Registered queries against their oracles, and the pipeline's stages against brute force, on a small table."""

from __future__ import annotations

import pytest
from helpers import DOCUMENT, alphanumeric, linked_components, shingle_set, spaced
from oracle_check import connect, differences

import corpus_pipeline
from tidemark.llm import mixing, queries, tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, con, name):
    assert differences(spark, con, name, queries.queries()[name], queries.oracle_sql()[name], SF) is None


def test_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [alphanumeric(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 13]) for w in items for i in range(max(1, len(w) - 12)) if w}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near copies", "decontamination", "mixing", "token files"]

    calm = stages["toxicity"](spark, docs, SF)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in calm.collect()}
    assert calm.columns == docs.columns and all(labels.get(i, 1) == 1 for i in gone)

    kept = stages["near copies"](spark, docs, SF)
    sets = {r.doc_id: shingle_set(r.text) for r in docs.collect()}
    want = linked_components(sets, lambda a, b: bool(a and b) and 100 * len(a & b) >= 75 * len(a | b))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, c in want.items() if i == c}

    clean = stages["decontamination"](spark, docs, SF)
    hit = {}
    for r in docs.collect():
        words = alphanumeric(r.text)
        places = {j for i in range(len(words) - 12) if tuple(words[i : i + 13]) in windows for j in range(i, i + 13)}
        hit[r.doc_id] = bool(places) and 20 * len(places) >= len(words)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {i for i, h in hit.items() if not h}

    mix = stages["mixing"](spark, docs, SF)
    assert mix.columns == docs.columns
    taken: dict = {}
    for r in mix.collect():
        taken[r.source] = taken.get(r.source, 0) + len(spaced(r.text))
    total = sum(len(spaced(r.text)) for r in docs.collect())
    assert sum(taken.values()) == pytest.approx(1.5 * total, rel=0.1)


def test_token_files_keep_the_training_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    order = [r.doc_id for r in mixing.mixed(docs).collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files
    try:
        mix = tables.stored(stages["mixing"](spark, docs, SF), "mixing")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = {r.f for r in mix.selectExpr("_metadata.file_name AS f").collect()}
    assert len(files) > 1 and order != sorted(order)
    found = stages["token files"](spark, mix, SF).orderBy("start").collect()
    assert [r.doc_id for r in found] == order
    own = spark.createDataFrame([(i, f"text {i}", "m") for i in (5, 3, 9, 3)], "doc_id long, text string, _metadata string")
    assert [r.doc_id for r in stages["token files"](spark, own.coalesce(1), SF).orderBy("start").collect()] == [5, 3, 9, 3]


def test_stages_take_odd_rows(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, None, "s", 5), (2, text + " end", "en", None, None), (2, text + " end", "en", None, None), (None, None, None, None, None), (4, "", "de", "s", 0)]
    docs = spark.createDataFrame(rows, DOCUMENT).selectExpr("*", "1 AS grade", "'x' AS n_words", "2.0 AS size", "3 AS start")
    empty = docs.where("false")
    for frame in (docs, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF)
            assert out.columns == (["doc_id", "start", "n_tokens", "ids_crc32"] if name == "token files" else frame.columns)
            found = out.collect()
            assert frame is docs or found == []
    assert sorted((r.doc_id or 0) for r in dict(corpus_pipeline.STAGES)["near copies"](spark, docs, SF).collect()) == [0, 1, 4]


def test_run_is_the_stages_in_turn(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "STAGES", [corpus_pipeline.STAGES[2], corpus_pipeline.STAGES[4]])
    assert corpus_pipeline.run(spark, SF).count() > 100
