from __future__ import annotations

import hashlib

import time

import numpy as np
import pytest
from helpers import alphanumeric, documents

from tidemark.llm import decontaminate as D
from tidemark.llm.automaton import SuffixAutomaton

ITEM = "item_id long, text string"


def _brute(text, items, window=13):
    words, hit, owners = alphanumeric(text), set(), set()
    for item, body in items:
        run = alphanumeric(body)
        if not run:
            continue
        size = min(window, len(run))
        windows = {tuple(run[i : i + size]) for i in range(len(run) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                owners.add("" if item is None else str(item))
    return len(words), len(hit), sorted(owners)


@pytest.fixture(scope="module")
def case():
    rng = np.random.default_rng(9)
    vocabulary = [f"v{i}" for i in range(12)]
    pick = lambda n: [vocabulary[i] for i in rng.integers(0, 12, n)]
    items = [(i, " ".join(pick(int(n)))) for i, n in enumerate([40, 13, 12, 60, 5, 30, 30, 8])]
    items += [(8, items[0][1]), (8, items[0][1]), (None, "Rare, Öne! two"), (9, None), (10, "?!")]
    docs = []
    for i in range(40):
        words = pick(int(rng.integers(0, 120)))
        for _, body in items[: 8 : int(rng.integers(1, 5))]:
            run, at = alphanumeric(body), int(rng.integers(0, len(words) + 1))
            a = int(rng.integers(0, max(1, len(run) - 14)))
            words[at:at] = run[a : a + int(rng.integers(10, 30))]
        docs.append((i, " -".join(words).upper()))
    return [*docs, (40, None), (41, ""), (42, "x rare öne TWO y"), (42, "x rare öne TWO y")], items


@pytest.mark.parametrize("shard_bytes", [1 << 20, 60])
def test_hits_and_owners(spark, case, shard_bytes):
    docs, items = case
    found = D.judged(D.matches(documents(spark, docs), documents(spark, items, ITEM), shard_bytes=shard_bytes))
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.items, r.items_sha256, r.contaminated) for r in found.collect()), key=repr)
    want = []
    for i, text in docs:
        n, hit, owners = _brute(text, items)
        digest = hashlib.sha256(",".join(owners).encode()).hexdigest()
        want.append((i, n, hit, owners, digest, hit > 0 and 20 * hit >= n))
    assert got == sorted(want, key=repr)
    assert {w[5] for w in want} == {True, False}


def test_contaminated_documents_go_and_spans_are_cut(spark):
    item = " ".join(f"q{i}" for i in range(20))
    filler = " ".join(f"f{i}" for i in range(500))
    rows = [(1, f"a {item} b", 5), (2, f"{filler} {item}, end", 5), (3, "clean", 5)]
    docs = documents(spark, rows, "doc_id long, text string, n_words long")
    kept = D.decontaminated(docs, documents(spark, [(1, item)], ITEM))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    cut = {r.doc_id: r.text for r in D.spans_removed(docs, documents(spark, [(1, item)], ITEM)).collect()}
    assert cut == {1: "a  b", 2: f"{filler} , end", 3: "clean"}


def test_without_items_or_documents(spark):
    none = documents(spark, [], ITEM)
    clash = documents(spark, [(1, "a b", 9)], "doc_id long, text string, spans long")
    row = D.judged(D.matches(clash, none)).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated, row.items_sha256) == (2, 0, 0, False, hashlib.sha256(b"").hexdigest())
    assert D.matches(documents(spark, []), none).collect() == []


def test_long_repeats_cost_time_in_proportion():
    words = [0] * 100_000
    began = time.process_time()
    automaton = SuffixAutomaton(13)
    automaton.add(words)
    automaton.name("x", words)
    assert automaton.found(words) == ([(0, len(words))], {"x"})
    assert automaton.found(words[:12]) == ([], set())
    assert time.process_time() - began < 5


@pytest.mark.parametrize("shard_bytes", [1 << 20, 2_000])
def test_repeated_words_and_very_long_texts(spark, shard_bytes):
    items = [("a", "x " * 900), ("b", "x " * 12 + "y"), ("c", "x x x"), ("d", "x y " * 40), ("e", "z " * 30 + "x " * 30)]
    texts = ["x " * 12, "x " * 13 + "y", "q " * 20_000 + "x " * 20_000 + "y", "y x " * 3_000, "z x", "", None, "x x x y x x x y", "z " * 14 + "q"]
    found = D.judged(D.matches(documents(spark, list(enumerate(texts))), documents(spark, items, "item_id string, text string"), shard_bytes=shard_bytes))
    got = sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect())
    assert got == [(i, *_brute(t, items)) for i, t in enumerate(texts)]


def test_the_driver_reads_addresses_only(spark):
    items = documents(spark, [(i, " ".join(f"w{i}x{j}" for j in range(40))) for i in range(30)], ITEM)
    addresses = D._shards(items, "item_id", "text", 13, 1_000)
    assert addresses.columns == ["address"] and addresses.count() > 5
