from __future__ import annotations

import numpy as np
import pytest
from helpers import documents, spaced

from tidemark.llm import mixing as M

SCHEMA = "doc_id long, text string, source string"


def _targets(sizes: dict) -> dict:
    """By the rule: deal by weight, stop at twice the size, deal the excess again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    got, open_, left = dict.fromkeys(order, 0.0), set(order), 1.5 * sum(sizes.values())
    while left > 1e-9 and open_:
        total, excess = sum(weight[s] for s in open_), 0.0
        for s in list(open_):
            got[s] += left * weight[s] / total
            if got[s] > 2 * sizes[s]:
                excess += got[s] - 2 * sizes[s]
                got[s] = 2.0 * sizes[s]
                open_.discard(s)
        left = excess
    return got


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    out = []
    for i in range(400):
        source = "hot" if i % 3 == 0 else [None, "a", "b", "é", "z9", "B"][int(rng.integers(0, 6))]
        out.append((i, "w " * int(rng.integers(0, 200)), source))
    return out


@pytest.mark.parametrize("per_bucket", [20_000, 7])
def test_targets_are_met_and_reruns_agree(spark, rows, per_bucket, monkeypatch):
    monkeypatch.setattr(M, "ROWS_PER_BUCKET", per_bucket)
    once, again = (sorted(M.decisions(documents(spark, rows, SCHEMA)).collect(), key=lambda r: r.doc_id) for _ in range(2))
    assert once == again
    sizes: dict = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(spaced(text))
    want, taken = _targets(sizes), dict.fromkeys(sizes, 0)
    for r in once:
        assert r["__size"] == len(spaced(r.text)) and r["__source_size"] == sizes[r.source]
        assert r["__target"] == pytest.approx(want[r.source], rel=1e-9)
        assert 0 <= r["__taken"] <= 2 * r["__size"]
        taken[r.source] += r["__taken"]
        assert all(t is None or 0 <= t <= 1 for t in r["__times"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1


def test_times_follow_the_schedules(spark, rows):
    share = {}
    placed = M.decisions(documents(spark, rows, SCHEMA)).collect()
    for source in ("B", "hot"):  # classes 0 (falling) and, fifth in order, 1 (even)
        times = [t for r in placed if r.source == source for t in r["__times"] if t is not None]
        share[source] = np.mean([t < 0.5 for t in times])
    assert share["B"] > 0.55


def test_inverse_undoes_the_integral(spark):
    from pyspark.sql import functions as F

    knots = (0.5, 2.0, 0.0, 1.0)
    frame = spark.range(0, 101).select((F.col("id") / 100).alias("u")).withColumn("t", M._inverse(knots, F.col("u")))
    grid = np.linspace(0, 1, 30_001)
    density = np.interp(grid, np.linspace(0, 1, 4), knots)
    area = np.concatenate(([0], np.cumsum((density[1:] + density[:-1]) / 2)))
    for r in frame.collect():
        assert np.interp(r.t, grid, area / area[-1]) == pytest.approx(r.u, abs=1e-4)


def test_training_order_repeats_whole_documents(spark, rows):
    extra = [(*r, "x") for r in rows]
    mixed = M.mixed(documents(spark, extra, SCHEMA + ", size string"))
    assert mixed.columns == ["doc_id", "text", "source", "size"]
    got = [r.doc_id for r in mixed.collect()]
    whole = {r.doc_id: r["__whole"] for r in M.decisions(documents(spark, rows, SCHEMA)).collect()}
    assert sorted(got) == sorted(i for i, n in whole.items() for _ in range(n))


def test_odd_tables(spark):
    assert M.decisions(documents(spark, [], SCHEMA)).collect() == []
    assert M.mixed(documents(spark, [], SCHEMA)).collect() == []
    nothing = M.decisions(documents(spark, [(1, None, None), (None, "", "a"), (1, None, None)], SCHEMA)).collect()
    assert [(r["__size"], r["__taken"], r["__target"]) for r in nothing] == [(0, 0, 0.0)] * 3
    twice = M.decisions(documents(spark, [(1, "a b", "s"), (1, "a b", "s"), (None, "c d e", None)], SCHEMA)).collect()
    assert len(twice) == 3 and sum(r["__taken"] for r in twice) in (10, 11)
