from __future__ import annotations

import numpy as np
import pytest
from helpers import documents, linked_components, prose, shingle_set

from tidemark.llm import jaccard as J
from tidemark.llm.components import components


def _alike(a: set, b: set) -> bool:
    return bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)


@pytest.fixture(scope="module")
def corpus():
    """Chains and stars of near copies around the limit, exact copies, and a passage that many documents share."""
    rng = np.random.default_rng(8)
    docs, shared = [], prose(rng, 40)
    for _ in range(12):
        words = prose(rng, int(rng.integers(30, 300)))
        docs.append(words)
        for _ in range(int(rng.integers(0, 7))):
            words = list(docs[-1])
            for _ in range(int(rng.integers(0, 5))):
                words[int(rng.integers(0, len(words)))] = f"n{rng.integers(0, 10**6)}"
            docs.append(words + prose(rng, int(rng.integers(0, 12))))
    docs += [prose(rng, int(rng.integers(5, 30))) + shared for _ in range(25)]
    docs += [docs[0], docs[3], docs[3], ["a"], ["A"], ["a", "b"], [], ["x"] * 60, ["x"] * 90]
    texts = [" ".join(w) for w in docs]
    return {7 * i % 1000: t for i, t in enumerate(texts)}


@pytest.mark.parametrize(("frequent", "block"), [(64, 1024), (3, 4)])
def test_components_are_those_of_all_links(spark, corpus, frequent, block, monkeypatch):
    sets = {i: shingle_set(t) for i, t in corpus.items()}
    want = linked_components(sets, _alike)
    rows = documents(spark, list(corpus.items()))
    sizes, edges = J.links(rows, frequent=frequent, block_rows=block)
    assert {r.doc_id: r.n for r in sizes.collect()} == {i: len(s) for i, s in sets.items()}
    for r in edges.collect():
        assert want[r.a] == want[r.b]
    found = {r.node: r.component for r in components(edges).collect()}
    assert {i: found.get(i, i) for i in sets} == want
    assert max(list(want.values()).count(c) for c in want.values()) > 3


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 2**63, int(n)).astype(np.uint64)) for n in rng.integers(1, 400, 2))
        if rng.random() < 0.7:
            b = np.unique(np.concatenate((a[: len(a) * 3 // 4], b[: len(a) // 4 + 1])))
        maps = [J._parity(a), J._parity(b)]
        words = min(map(len, maps)) // 8
        differ = int(np.bitwise_count(J._folded(maps[0], words) ^ J._folded(maps[1], words)).sum())
        assert differ <= len(np.setxor1d(a, b))


def test_tiles_keep_all_pairs_across_blocks(spark):
    rows = spark.range(50).selectExpr("1L AS token", "id AS doc_id", "id AS component", "id % 2 + 5 AS band")
    tiles = [r.asDict() for r in J._tiles(rows, 7).collect()]
    met = set()
    groups: dict = {}
    for t in tiles:
        groups.setdefault((t["tile"], t["i"], t["j"]), []).append(t)
    for group in groups.values():
        assert len(group) <= 2 * 30
        for x in group:
            for y in group:
                if x["doc_id"] < y["doc_id"] and (x["home"] or y["home"]):
                    met.add((x["doc_id"], y["doc_id"]))
    assert met == {(a, b) for a in range(50) for b in range(a + 1, 50)}


def test_odd_tables_and_deduplication(spark):
    text = " ".join(f"w{i}" for i in range(30))
    assert J.joined(documents(spark, [])).collect() == []
    rows = [(3, text, "p"), (1, text, "q"), (1, text, "q"), (None, text, "r"), (4, None, "s"), (5, "", "t"), (6, "one two", "u"), (7, "One  two", "v")]
    odd = documents(spark, rows, "doc_id long, text string, component_id string")
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id) for r in J.joined(odd).collect()), key=repr)
    assert got == sorted([(3, 26, 1), (1, 26, 1), (1, 26, 1), (0, 26, None), (4, 0, 4), (5, 0, 5), (6, 1, 6), (7, 1, 6)], key=repr)
    kept = J.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 4, 5, 6]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(200, 100 + i) for i in range(1, 30)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 101 for i in [*range(101, 130), 200]}


def test_a_unique_text_of_a_repeated_id_stays(spark):
    t, u = (" ".join(f"{c}{i}" for i in range(60)) for c in "tu")
    kept = lambda rows: sorted((r.doc_id, r.text) for r in J.deduplicated(documents(spark, rows)).collect())
    assert kept([(1, t), (1, u)]) == [(1, t), (1, u)]
    assert kept([(0, t + " x"), (5, t), (5, u)]) == [(0, t + " x"), (5, u)]
    again = kept([(3, t), (3, t), (3, t + " x"), (2, u), (2, u)])
    assert again in ([(2, u), (3, t)], [(2, u), (3, t + " x")])
    odd = J.deduplicated(documents(spark, [(None, t), (None, t), (1, t), (1, None), (1, ""), (2, None)])).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in odd) == [(False, 1), (False, 1), (False, 1), (False, 2), (True, 0), (True, 0)]
