"""Exact duplicates against grouping in plain Python, with tries of any size."""

from __future__ import annotations

import random

import pytest
from helpers import documents, folded, prose

from tidemark.llm import owners
from tidemark.llm.trie import Patricia


def expected(rows, largest=True):
    """(id, keep, size) of each row and how many rows stay."""
    groups: dict = {}
    for name, text in rows:
        groups.setdefault(folded(text), []).append(name)

    def best(names):
        known = [n for n in names if n is not None]
        return (max(known) if largest else min(known)) if known else None

    return sorted(((n, best(groups[folded(t)]), len(groups[folded(t)])) for n, t in rows), key=repr), len(groups)


def mixed_rows(rng, n=400):
    base = [" ".join(prose(rng, int(k))) for k in rng.integers(1, 60, 25)]
    base += ["", "A", "a", "ab", "abc", "Ünï", "ünï", "x" * 5000, "x" * 5000 + "y", "x" * 4999 + "z"]
    rows = [(int(i), base[int(rng.integers(0, len(base)))]) for i in rng.permutation(n)]
    return rows + [(n + i, base[0].upper()) for i in range(n // 2)] + [(None, base[1]), (None, None), (3, None), (3, base[2]), (3, base[2]), (None, "only null"), (None, "only null")]


@pytest.mark.parametrize("trie_bytes", [owners.TRIE_BYTES, 30_000, 2_000])
@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_against_grouping(spark, trie_bytes, keep):
    import numpy as np

    rows = mixed_rows(np.random.default_rng(5))
    docs = documents(spark, rows).repartition(5)
    found = owners.owners(docs, keep=keep, trie_bytes=trie_bytes).collect()
    want, groups = expected(rows, keep == "largest")
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=repr) == want
    kept = [r for r in found if r.kept]
    assert len(kept) == groups and all(r.doc_id == r.keep_id for r in kept)
    assert len({r.text_sha256 for r in found}) == groups == len({r.text_sha256 for r in kept})


def test_kept_rows_are_whole_and_in_their_own_case(spark):
    docs = spark.createDataFrame(
        [(1, "Same text", "a", 5), (2, "same TEXT", "b", 6), (3, "other", None, 7), (3, "Other", "c", 8), (4, None, "d", 9)],
        "doc_id long, text string, kept string, group_size int",
    )
    found = owners.deduplicated(docs)
    assert found.columns == docs.columns
    rows = sorted(tuple(r) for r in found.collect())
    assert rows[0] == (2, "same TEXT", "b", 6) and rows[2] == (4, None, "d", 9) and rows[1][0] == 3 and len(rows) == 3


def test_empty_table_and_text_ids(spark):
    assert owners.owners(documents(spark, [])).collect() == []
    docs = documents(spark, [("b", "t"), ("a", "T"), (None, "t")], "doc_id string, text string")
    assert {r.keep_id for r in owners.owners(docs).collect()} == {"b"}
    assert {r.keep_id for r in owners.owners(docs, keep="smallest").collect()} == {"a"}


def test_one_hot_text_moves_once_a_task(spark):
    docs = documents(spark, [(i, "hot " * 500) for i in range(3000)] + [(3000 + i, f"cold {i}") for i in range(30)]).repartition(6)
    found = owners.owners(docs).collect()
    assert sum(r.group_size == 3000 and r.keep_id == 2999 for r in found) == 3000 and len(found) == 3030


def test_very_long_texts(spark):
    long = "A long line of text that goes on. " * 90_000
    found = owners.owners(documents(spark, [(1, long), (2, long.lower()), (3, long + "!")]), trie_bytes=100_000).collect()
    assert {(r.doc_id, r.keep_id, r.group_size) for r in found} == {(1, 2, 2), (2, 2, 2), (3, 3, 1)}


def test_trie_holds_strings_and_gives_subtrees_away():
    rng = random.Random(3)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 14))) for _ in range(3000)]
    trie, away, counts = Patricia(), {}, {}
    for number, text in enumerate(strings):
        node = trie.place(text)
        if node.away is not None:
            away[node.away][text] = away[node.away].get(text, 0) + 1
        else:
            node.value = (node.value or 0) + 1
        if number % 300 == 299 and (heavy := trie.heaviest()):
            taken, inside = trie.cut(*heavy, number)
            away[number] = dict(taken)
            for earlier in inside:
                away[number] |= away.pop(earlier)
    for text, n in [*trie.strings(), *(item for file in away.values() for item in file.items())]:
        assert text not in counts
        counts[text] = n
    assert counts == {t: strings.count(t) for t in set(strings)}
    assert len(away) >= 2
