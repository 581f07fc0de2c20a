"""Toxicity: severity grades by cumulative-link ordinal regression on sparse text features.

One weight per feature is shared by all grades; ordered thresholds turn the weighted sum into the chances of grade 1 or
more, 2 or more, and so on, whose sum is the expected severity. Features are words and the beginnings of words (three to
six bytes), so that inflected forms of a stem count together.

Labels say toxic or not. Grades are made from them: 0 is not toxic, and toxic documents are cut at even quantiles of
their share of telling words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.tables import lean
from tidemark.llm.words import ALPHANUMERIC, BYTE_VALUE, Words, fold_bytes, mixed, run_hashes, slices, text_bytes, text_ends, word_runs

#: Labelled documents of each class that a model is fitted on, at most, and features it keeps, at most.
SAMPLE_PER_CLASS = 2_000
FEATURES = 512
GRADES = 3
_PREFIXES = (3, 4, 5, 6)
#: A telling feature is in so many toxic documents, so many times as often as in others, with such a log-likelihood ratio.
_LEAST_DOCS, _LEAST_LIFT, _LEAST_RATIO = 4, 4.0, 20.0


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # sorted feature hashes
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one for each grade from 1

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """Chances of each grade or more, a column per grade."""
        return _sigmoid(scores[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _features(texts: pa.Array) -> tuple[list[np.ndarray], Words]:
    """For each kind of feature, its hash at every word; and the words."""
    data, bounds = fold_bytes(text_bytes(texts)), np.concatenate(([0], text_ends(texts)))
    if not len(data):
        return [np.zeros(0, np.uint64)] * (len(_PREFIXES) + 1), Words(np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64))
    first, last = word_runs(data, bounds, ALPHANUMERIC)
    whole = run_hashes(data, first, last, BYTE_VALUE)
    kinds = [whole]
    for n in _PREFIXES:
        start = run_hashes(data, first, np.minimum(first + n - 1, last), BYTE_VALUE)
        kinds.append(mixed(start + np.uint64(n)))
    return kinds, Words(whole, np.searchsorted(first, bounds))


def _document_counts(kinds: list[np.ndarray], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) pairs, each once."""
    doc = np.repeat(np.arange(len(words.offsets) - 1), words.counts)
    pairs = np.stack([np.concatenate([doc.astype(np.uint64)] * len(kinds)), np.concatenate(kinds)])
    order = np.lexsort(pairs)
    pairs = pairs[:, order]
    fresh = np.ones(pairs.shape[1], bool)
    fresh[1:] = (pairs[:, 1:] != pairs[:, :-1]).any(axis=0)
    return pairs[0, fresh].astype(np.int64), pairs[1, fresh]


def _known(model_features: np.ndarray, kinds: list[np.ndarray], words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, feature number and x = log(1 + occurrences per hundred words) of features that occur."""
    doc = np.repeat(np.arange(len(words.offsets) - 1), words.counts)
    docs, numbers = [], []
    for hashes in kinds:
        at = np.minimum(np.searchsorted(model_features, hashes), len(model_features) - 1)
        hit = model_features[at] == hashes
        docs.append(doc[hit])
        numbers.append(at[hit])
    key = np.concatenate(docs) * len(model_features) + np.concatenate(numbers)
    key, times = np.unique(key, return_counts=True)
    doc, number = key // len(model_features), key % len(model_features)
    return doc, number, np.log1p(100 * times / words.counts[doc])


def _sample(docs: DataFrame, labels: DataFrame, per_class: int, text: str, doc_id: str) -> DataFrame:
    """Texts of at most ``per_class`` labelled documents of each class, those of the lowest hashes of their ids."""
    named = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    picked = [named.where(F.col("toxic") == side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for side in (True, False)]
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return texts.join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")  # 2 x per_class ids


def _telling(sample: DataFrame, most: int) -> np.ndarray:
    """Features that toxic documents of the sample have far more often than others, by the log-likelihood ratio."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                kinds, words = _features(part.column("text"))
                doc, feature = _document_counts(kinds, words)
                toxic = part.column("toxic").to_numpy(zero_copy_only=False)[doc]
                distinct, inverse = np.unique(feature, return_inverse=True)
                sides = [np.bincount(inverse[toxic == s], minlength=len(distinct)) for s in (True, False)]
                columns = [pa.array(c.astype(np.int64)) for c in (distinct.view(np.int64), *sides)]
                yield pa.RecordBatch.from_arrays(columns, ["feature", "t", "f"])

    totals = sample.groupBy().agg(F.count(F.when(F.col("toxic"), 1)), F.count(F.when(~F.col("toxic"), 1))).first()
    if not all(totals):
        return np.zeros(0, np.uint64)
    counts = sample.mapInArrow(lean(count), "feature long, t long, f long").groupBy("feature").agg(F.sum("t").alias("t"), F.sum("f").alias("f"))
    n_toxic, n_other = totals
    with_it, without = F.col("t") + F.col("f"), F.lit(n_toxic + n_other) - F.col("t") - F.col("f")
    term = lambda seen, row, column: F.when(seen > 0, seen * F.log(seen * (n_toxic + n_other) / (row * column))).otherwise(0.0)
    ratio = 2 * (
        term(F.col("t"), with_it, F.lit(n_toxic))
        + term(F.col("f"), with_it, F.lit(n_other))
        + term(F.lit(n_toxic) - F.col("t"), without, F.lit(n_toxic))
        + term(F.lit(n_other) - F.col("f"), without, F.lit(n_other))
    )
    lift = F.col("t") * n_other >= F.col("f") * n_toxic * F.lit(_LEAST_LIFT)
    good = counts.where((F.col("t") >= _LEAST_DOCS) & lift).withColumn("ratio", ratio).where(F.col("ratio") >= _LEAST_RATIO)
    rows = good.orderBy(F.desc(F.round("ratio", 6)), "feature").limit(most).collect()
    return np.sort(np.array([r.feature for r in rows], np.int64).view(np.uint64))


def _matrix(sample: DataFrame, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sample's features, a row per document in the order of hashes, and who is toxic."""

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                doc, number, x = _known(features, *_features(part.column("text")))
                at = np.searchsorted(doc, np.arange(part.num_rows + 1))
                lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(v)) for v in (number.astype(np.int64), x)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), *lists], ["doc_id", "toxic", "number", "x"])

    rows = sample.select("doc_id", "toxic", "text").mapInArrow(lean(sparse), "doc_id long, toxic boolean, number array<long>, x array<double>").collect()
    rows.sort(key=lambda r: (r.doc_id, r.toxic, r.number, r.x))
    table = np.zeros((len(rows), len(features)))
    for i, r in enumerate(rows):
        table[i, r.number] = r.x
    return table, np.array([r.toxic for r in rows])


def _graded(table: np.ndarray, toxic: np.ndarray, grades: int) -> np.ndarray:
    load = np.expm1(table).sum(axis=1)
    cuts = np.quantile(load[toxic], np.arange(1, grades) / grades)
    return np.where(toxic, 1 + np.searchsorted(cuts, load, side="right"), 0)


def _descend(x: np.ndarray, y: np.ndarray, weight: np.ndarray, grades: int, steps: int = 400, l2: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood of the cumulative-link model: weights not below 0, thresholds kept in order by log gaps."""
    w, t = np.full(x.shape[1], 0.1), np.concatenate(([1.0], np.zeros(grades - 1)))
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, t)]
    share = weight / weight.sum()
    for step in range(1, steps + 1):
        cuts = t[0] + np.concatenate(([0.0], np.cumsum(np.exp(t[1:]))))
        p = _sigmoid((x @ w)[:, None] - cuts[None, :])
        bounds = np.concatenate((np.ones((len(x), 1)), p, np.zeros((len(x), 1))), axis=1)
        slope = bounds * (1 - bounds)
        rows = np.arange(len(x))
        chance = np.maximum(bounds[rows, y] - bounds[rows, y + 1], 1e-12)
        upper, lower = slope[rows, y] / chance * share, slope[rows, y + 1] / chance * share
        d_cuts = np.zeros(grades)
        np.add.at(d_cuts, y[y > 0] - 1, upper[y > 0])
        np.add.at(d_cuts, y[y < grades], -lower[y < grades])
        gaps = np.exp(t[1:])
        d_t = np.concatenate(([d_cuts.sum()], [d_cuts[i + 1 :].sum() * g for i, g in enumerate(gaps)]))
        d_w = -(x.T @ (upper - lower)) + l2 * w
        for parameter, slope_of, (m, v) in zip((w, t), (d_w, d_t), moments, strict=True):
            m += 0.1 * (slope_of - m)
            v += 0.001 * (slope_of**2 - v)
            parameter -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
        np.maximum(w, 0, out=w)
    return w, t[0] + np.concatenate(([0.0], np.cumsum(np.exp(t[1:]))))


def fit(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", per_class: int = SAMPLE_PER_CLASS,
    features: int = FEATURES, grades: int = GRADES,
) -> Model:
    """A model from ``labels`` (doc_id, toxic) of at most ``per_class`` documents of each class.

    Classes are weighted by their numbers among the labels. Labels without id or value are left out, of several for
    one id a toxic one counts, and null texts have no words. Without both classes, or without features that tell them apart, the
    model has no features and finds nothing toxic.
    """
    sample = _sample(docs, labels, per_class, text, doc_id)
    telling = _telling(sample, features)
    if not len(telling):
        return Model(telling, np.zeros(0), np.full(grades, np.inf))
    table, toxic = _matrix(sample, telling)
    counted = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").agg(F.count(F.when(F.col("toxic") > 0, 1)), F.count("*")).first()
    share = counted[0] / counted[1]
    weight = np.where(toxic, share / toxic.sum(), (1 - share) / max(1, (~toxic).sum()))
    y = _graded(table, toxic, grades)
    return Model(telling, *_descend(table, y, weight, grades))


NAMES = ("n_words", "severity", "toxic_chance", "grade")


def scored(docs: DataFrame, model: Model, text: str = "text", names: tuple[str, str, str, str] = NAMES) -> DataFrame:
    """``docs`` with ``n_words, severity`` (expected grade), ``toxic_chance`` (of grade 1 or more) and ``grade``.

    ``names`` are the names of these columns; columns of ``docs`` that have one of them are replaced.

    ``grade`` is the highest grade that is reached with a chance of one half or more; 0 is not toxic. Texts without
    words, null ones too, have severity 0. Whole texts are scored where they lie.
    """
    docs = docs.drop(*names)
    kinds_of = (T.LongType(), T.DoubleType(), T.DoubleType(), T.IntegerType())
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, t in zip(names, kinds_of, strict=True))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                chances = np.zeros((part.num_rows, len(model.thresholds)))
                kinds, words = _features(part.column(text))
                if len(model.features):
                    doc, number, x = _known(model.features, kinds, words)
                    score = np.bincount(doc, model.weights[number] * x, part.num_rows)
                    chances = model.at_least(score) * (np.bincount(doc, minlength=part.num_rows) > 0)[:, None]
                added = [words.counts.astype(np.int64), chances.sum(axis=1), chances[:, 0], (chances >= 0.5).sum(axis=1).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*part.columns, *map(pa.array, added)], [*part.schema.names, *names])

    return docs.mapInArrow(lean(task), schema)
