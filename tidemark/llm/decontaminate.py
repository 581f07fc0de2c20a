"""Benchmark decontamination: longest matches of training words in a suffix automaton of all benchmark items."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import files
from tidemark.llm.automaton import SuffixAutomaton
from tidemark.llm.tables import lean, stored
from tidemark.llm.words import ALPHANUMERIC, Words, hashed_words, shingles, slices

WINDOW = 13
#: Text bytes of benchmark items that one automaton takes; a larger benchmark becomes several, applied in turn.
SHARD_BYTES = 1 << 20
#: Text bytes of documents that a task holds while it goes through several automata.
HELD_BYTES = 1 << 25
_GRAM = 4
_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


@dataclass(frozen=True)
class _Shard:
    automaton: SuffixAutomaton
    vocabulary: np.ndarray  # sorted word hashes; a word's number is its place
    gram: int
    grams: np.ndarray  # sorted hashes of all runs of ``gram`` words
    least: int  # length of the shortest window


def _shard(items: list[tuple[str, str]], window: int) -> _Shard | None:
    words = hashed_words(pa.array([text for _, text in items], pa.large_string()), ALPHANUMERIC)
    counts = words.counts
    if not counts.sum():
        return None
    vocabulary = np.unique(words.hashes)
    numbers = np.searchsorted(vocabulary, words.hashes)
    automaton = SuffixAutomaton(window)
    runs = [
        (item, numbers[words.offsets[i] : words.offsets[i + 1]].tolist()) for i, (item, _) in enumerate(items) if counts[i]
    ]
    for _, run in runs:
        automaton.add(run)
    for item, run in runs:
        automaton.name(item, run)
    least = int(min(window, counts[counts > 0].min()))
    gram = min(_GRAM, least)
    return _Shard(automaton, vocabulary, gram, np.unique(shingles(words, gram).hashes), least)


def _contains(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


def _stretches(words: Words, shard: _Shard) -> Iterator[tuple[int, int, int]]:
    """(text, first word, end) of stretches whose runs of ``gram`` words all occur in some item; no match is outside."""
    k, counts = shard.gram, words.counts
    whole = Words(words.hashes, words.offsets)
    grams = shingles(whole, k)
    live = _contains(shard.grams, grams.hashes)
    live &= np.repeat(counts >= k, grams.counts)
    at = np.flatnonzero(live)
    if not len(at):
        return
    text = np.searchsorted(grams.offsets, at, side="right") - 1
    breaks = np.flatnonzero((np.diff(at) > 1) | (np.diff(text) > 0)) + 1
    for a, b in zip(np.concatenate(([0], breaks)), np.concatenate((breaks, [len(at)])), strict=True):
        size = int(b - a) + k - 1
        if size >= shard.least:
            i = int(text[a])
            start = int(at[a] - grams.offsets[i])
            yield i, start, start + size


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and out[-1][1] >= start:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


@dataclass
class _Found:
    """What is known so far of the texts of a batch: numbers of words, hit spans, owners."""

    words: Words
    spans: list[list[tuple[int, int]]]
    items: list[set[str]]

    @classmethod
    def of(cls, texts: pa.Array) -> _Found:
        words = hashed_words(texts, ALPHANUMERIC)
        return cls(words, [[] for _ in range(len(texts))], [set() for _ in range(len(texts))])

    def scan(self, shard: _Shard) -> None:
        words = self.words
        for i, start, end in _stretches(words, shard):
            numbers = np.searchsorted(shard.vocabulary, words.hashes[words.offsets[i] + start : words.offsets[i] + end])
            found, who = shard.automaton.found(numbers.tolist())
            self.spans[i] += [(start + a, start + b) for a, b in found]
            self.items[i] |= who

    def columns(self) -> list[pa.Array]:
        return [
            pa.array(self.words.counts, pa.int64()),
            pa.array([[{"start": a, "end": b} for a, b in _merged(x)] for x in self.spans], _ARROW_SPAN),
            pa.array([sorted(x) for x in self.items], pa.list_(pa.string())),
        ]


#: The automaton that a worker read last, by its address.
_READ: dict[str, _Shard] = {}


def _read(address: str) -> _Shard:
    if address not in _READ:
        _READ.clear()
        with files.opened(address) as out:
            _READ[address] = pickle.loads(out.read())
    return _READ[address]


def matches(
    docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, shard_bytes: int = SHARD_BYTES, names: tuple[str, str, str] = ("n_words", "spans", "items"),
) -> DataFrame:
    """``docs`` with its number of words, the word spans inside benchmark windows, and the items that own the windows.

    Words are runs of ASCII letters and digits and of all that is not ASCII, A-Z as a-z. A window is ``window``
    consecutive words of an item; an item of fewer words, but not none, is one window. ``spans`` are disjoint
    ``[start, end)`` word numbers in order; ``items`` are distinct ids as strings, sorted.

    Tasks build the automata, each of ``shard_bytes`` of item texts (one item at least), and write them to the shared
    folder; the driver holds their addresses. Documents are scanned where they lie, without a shuffle; a task holds one
    automaton and some documents at a time. Null texts have no words; an item without an id goes by ''; repeated items
    count once; without items nothing matches. Long items and documents, also of one word repeated, cost time in
    proportion to their words. Columns of ``docs`` that have one of ``names`` are replaced.
    """
    docs = docs.drop(*names)
    schema = T.StructType(
        [*docs.schema.fields, *(T.StructField(n, t) for n, t in zip(names, (T.LongType(), _SPAN, T.ArrayType(T.StringType())), strict=True))]
    )
    addresses = [r.address for r in _shards(items, item, item_text, window, shard_bytes).collect()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _blocks((part for batch in batches for part in slices(batch, text)), text, HELD_BYTES if len(addresses) > 1 else 0):
            found = [_Found.of(part.column(text)) for part in held]
            for address in addresses:
                shard = _read(address)
                for one in found:
                    one.scan(shard)
            for part, one in zip(held, found, strict=True):
                yield pa.RecordBatch.from_arrays([*part.columns, *one.columns()], schema.names)

    return docs.mapInArrow(lean(scan), schema)


def _blocks(parts: Iterator[pa.RecordBatch], text: str, least_bytes: int) -> Iterator[list[pa.RecordBatch]]:
    held: list[pa.RecordBatch] = []
    size = 0
    for part in parts:
        held.append(part)
        size += part.column(text).nbytes
        if size >= least_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def _shards(items: DataFrame, item: str, item_text: str, window: int, shard_bytes: int) -> DataFrame:
    """``address`` of each automaton in the shared folder. Items are dealt to as many tasks as there are automata by bytes."""
    rows = items.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("i"), F.col(item_text).alias("t"))
    distinct = stored(rows.where("t IS NOT NULL").distinct(), "benchmark-items")
    size = distinct.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    folder = files.folder(items.sparkSession, "automata")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, str]] = []
        total = 0

        def written() -> pa.RecordBatch:
            shard = _shard(held, window)
            address, out = files.created(folder, ".automaton") if shard else (None, None)
            if shard:
                with out:
                    out.write(pickle.dumps(shard, pickle.HIGHEST_PROTOCOL))
            return pa.RecordBatch.from_arrays([pa.array([address] if shard else [], pa.string())], ["address"])

        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["t"].encode())
                if held and total + n > shard_bytes:
                    yield written()
                    held, total = [], 0
                held.append((row["i"], row["t"]))
                total += n
        if held:
            yield written()

    return stored(distinct.repartition(1 + size // shard_bytes).mapInArrow(lean(task), "address string"), "automata-addresses")


def _hit(spans: str) -> F.Column:
    return F.aggregate(F.col(spans), F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def judged(matched: DataFrame, share: int = 20) -> DataFrame:
    """Adds n_hit, n_items, items_sha256 and ``contaminated``: 1 / ``share`` of the words or more are hit."""
    hit = _hit("spans")
    return matched.withColumns(
        {
            "n_hit": hit,
            "n_items": F.size("items").cast("long"),
            "items_sha256": F.sha2(F.concat_ws(",", F.array_sort("items")), 256),
            "contaminated": (hit > 0) & (share * hit >= F.col("n_words")),
        }
    )


def decontaminated(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW, share: int = 20) -> DataFrame:
    """The documents that are not contaminated by the rule of :func:`judged`, with the columns of ``docs``."""
    names = tuple(f"__{n}" for n in ("n_words", "spans", "items"))
    found = matches(docs, items, text, window=window, names=names)
    hit = _hit("__spans")
    return found.where((hit == 0) | (share * hit < F.col("__n_words"))).select(*(F.col(f"`{c}`") for c in docs.columns))


def spans_removed(docs: DataFrame, items: DataFrame, text: str = "text", least_words: int = WINDOW, window: int = WINDOW) -> DataFrame:
    """``docs`` with spans of ``least_words`` or more matched words cut out of the text; other texts stay as they are."""
    from tidemark.llm.words import word_places

    names = tuple(f"__{n}" for n in ("n_words", "spans", "items"))
    found = matches(docs, items, text, window=window, names=names).drop("__n_words", "__items")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(text)
            texts = batch.column(place).to_pylist()
            for i, spans in enumerate(batch.column("__spans").to_pylist()):
                if spans := [s for s in spans if s["end"] - s["start"] >= least_words]:
                    data = texts[i].encode()
                    first, last = word_places(data, ALPHANUMERIC)
                    kept, at = [], 0
                    for s in spans:
                        kept.append(data[at : first[s["start"]]])
                        at = last[s["end"] - 1] + 1
                    texts[i] = b"".join([*kept, data[at:]]).decode()
            yield batch.drop_columns(["__spans"]).set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return found.mapInArrow(cut, docs.schema)
