from __future__ import annotations

import numpy as np
import pytest
from helpers import documents, prose

from tidemark.llm import toxicity as X

LABEL = "doc_id long, quality int, toxic int"


def _case(seed: int, n: int):
    rng = np.random.default_rng(seed)
    docs, labels = [], []
    for i in range(n):
        words, toxic = prose(rng, int(rng.integers(40, 300))), i % 5 == 0
        if toxic:
            for _ in range(max(2, len(words) * int(rng.integers(2, 9)) // 100)):
                words.insert(int(rng.integers(0, len(words))), ["vile", "nasty", f"stemmed{rng.integers(0, 999)}"][int(rng.integers(0, 3))])
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_documents_are_graded(spark):
    docs, labels = _case(1, 500)
    model = X.fit(documents(spark, docs), documents(spark, labels, LABEL))
    assert (np.diff(model.thresholds) > 0).all() and (model.weights >= 0).all()
    held, truth = _case(2, 300)
    got = {r.doc_id: r for r in X.scored(documents(spark, held), model).collect()}
    right = [(got[i].grade > 0) == bool(t) for i, _, t in truth]
    assert np.mean(right) > 0.97
    few, many = "fine " * 97 + "vile " * 3, "fine " * 80 + "vile " * 20
    low, high = X.scored(documents(spark, [(1, few), (2, many)]), model).sort("doc_id").collect()
    assert 0 < low.severity < high.severity <= X.GRADES and low.toxic_chance <= high.toxic_chance


def test_fits_agree_and_are_bounded(spark):
    docs, labels = _case(3, 200)
    a, b = (X.fit(documents(spark, docs), documents(spark, labels, LABEL), per_class=30) for _ in range(2))
    assert (a.features == b.features).all() and np.allclose(a.weights, b.weights)
    assert X._sample(documents(spark, docs), documents(spark, labels, LABEL), 30, "text", "doc_id").count() == 60


def test_gradient_descends_to_the_true_order():
    rng = np.random.default_rng(5)
    x = rng.exponential(1, (3000, 2))
    score = x @ np.array([2.0, 0.5]) + rng.logistic(0, 1, 3000)
    y = np.searchsorted([1.0, 2.5, 4.0], score)
    w, cuts = X._descend(x, y, np.ones(3000), 3, steps=1500, l2=0)
    assert np.allclose(w, [2.0, 0.5], atol=0.25) and np.allclose(cuts, [1.0, 2.5, 4.0], atol=0.3)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(None, 1, 1), (1, None, None)]])
def test_without_both_classes_nothing_is_toxic(spark, labels):
    docs = documents(spark, [(1, "vile words"), (2, None), (None, ""), (2, None)])
    model = X.fit(docs, documents(spark, labels, LABEL))
    rows = X.scored(docs, model).collect()
    assert sorted(r.n_words for r in rows) == [0, 0, 0, 2] and all(r.severity == 0 and r.grade == 0 for r in rows)


def test_odd_tables_and_clashing_names(spark):
    docs, labels = _case(4, 200)
    model = X.fit(documents(spark, docs), documents(spark, [*labels, (0, 1, 0), (0, 1, None)], LABEL))
    clash = documents(spark, [(1, "vile " * 9, "mine"), (2, None, "x"), (3, " ", "y")], "doc_id long, text string, grade string")
    rows = {r.doc_id: r for r in X.scored(clash, model).collect()}
    assert rows[1].grade > 0 and rows[2].grade == rows[3].grade == 0
    assert X.scored(documents(spark, []), model).collect() == []
