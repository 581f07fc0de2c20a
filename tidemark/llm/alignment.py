"""Token alignment of two tokenizers over the same bytes, and how usual each pair of linked ids is in the corpus.

Both sequences are given by where their tokens end. While the two end arrays agree at the current shift between token
numbers, one-to-one stretches are jumped by comparing slices of doubling length; where they part, tokens are stepped
through one by one until both end at the same byte again, which settles the shift of what follows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidemark.llm.tables import small_batches, stored
from tidemark.llm.tokens import _WHITE, Encoder
from tidemark.llm.words import BYTE_VALUE, run_hashes, slices, text_bytes

#: How a link ends: both tokens end (and so a group does), the first one's alone, the second one's alone.
BOTH, FIRST, SECOND = 0, 1, 2
#: Pairs that are sent to all tasks at most, 17 bytes each; the others meet their links in a join.
BROADCAST_PAIRS = 2_000_000
#: Texts that are encoded at a time: their tokens are Python numbers for a while.
SLICE_BYTES = 1 << 19
#: Pairs that a task counts before it passes them on.
TASK_PAIRS = 1_000_000


def path_of(a_ends: list[int], b_ends: list[int]) -> np.ndarray:
    """How each link ends, in order, for two non-empty end arrays with the same last end.

    Links are the pairs of tokens whose byte ranges overlap. From a place where both sides begin a token, slices of 1, 2,
    4 ... ends are compared at the shift of the two token numbers, then halves of the first that differs: all that agrees
    is one link a token. Then the side that ends first goes on until both end together.
    """
    path = bytearray()
    i = j = 0
    n, m = len(a_ends), len(b_ends)
    while i < n:
        if a_ends[i] == b_ends[j]:
            step = run = 1
            most = min(n - i, m - j)
            while run < most and a_ends[i + run : i + run + step] == b_ends[j + run : j + run + step]:
                run += min(step, most - run)
                step *= 2
            while run < most and step > 1:  # the slice of `step` ends behind `run` differs somewhere
                step //= 2
                if a_ends[i + run : i + run + step] == b_ends[j + run : j + run + step]:
                    run += min(step, most - run)
            path += bytes(run)  # BOTH
            i, j = i + run, j + run
            continue
        a, b = a_ends[i], b_ends[j]
        while a != b:
            if a < b:
                path.append(FIRST)
                i += 1
                a = a_ends[i]
            else:
                path.append(SECOND)
                j += 1
                b = b_ends[j]
        path.append(BOTH)
        i, j = i + 1, j + 1
    return np.frombuffer(bytes(path), np.uint8)


def _byte_level() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones for themselves, the others in order from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass(frozen=True)
class Vocabulary:
    """The bytes of each token, and their number."""

    pieces: list[bytes]
    lengths: np.ndarray

    @classmethod
    def of(cls, pieces: list[bytes]) -> Vocabulary:
        return cls(pieces, np.array([len(p) for p in pieces], np.int64))

    def joined(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids.tolist()))


#: Distinct pieces of text that a worker remembers the tokens of, and bytes of new ones that are encoded as one text.
CACHE_PIECES = 500_000
CHUNK_BYTES = 1 << 13
#: What stands in front of the pieces of a chunk, so that none of them is at the beginning.
_LEAD = b" a"


_ENDS_WHITE = frozenset(np.flatnonzero(_WHITE).tolist())


def _among(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


class _ByteLevel(Encoder):
    """The first tokenizer: its ids of whole texts, and whether texts may be cut in front of blanks."""

    @property
    def in_pieces(self) -> bool:
        return self._cut

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return self._library(texts)


class Pair:
    """Both tokenizers of a worker: byte-level ids of a blank and the text, and pieces of the text, which begin with a blank.

    Neither joins what stands before a blank with the blank, unless white space stands before it: the first by its rule,
    the second if no piece of its vocabulary has a blank behind something else. So texts are cut in front of such blanks and
    every distinct piece is encoded once, many in one text, whose tokens are dealt to the pieces by their bytes. Pieces
    whose tokens have other bytes are known as such, and texts with one go to the libraries whole.
    """

    def __init__(self, byte_level: str, pieces: str) -> None:
        self._first = _ByteLevel(byte_level, special_as_text=True)
        tokenizer, values = Tokenizer.from_file(byte_level), _byte_level()
        names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]
        added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
        self.a = Vocabulary.of([n.encode() if n in added else bytes(values[c] for c in n) for n in names])
        self._second = sentencepiece.SentencePieceProcessor(model_file=pieces)
        named = [(i, self._second.id_to_piece(i)) for i in range(self._second.get_piece_size())]
        self.b = Vocabulary.of([bytes([int(p[3:5], 16)]) if self._second.is_byte(i) else p.replace("▁", " ").encode() for i, p in named])
        plain = self._second.normalize(" a  b ") == "▁▁a▁▁b▁"
        self._cut = self._first.in_pieces and plain and not any("▁" in p.lstrip("▁") for _, p in named)
        self.forget()

    def forget(self) -> None:
        self._keys, self._slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # hashes in order, and the pieces' numbers
        self._good = np.zeros(0, bool)
        self._ids = [np.zeros(0, np.int32) for _ in "ab"]
        self._at = [np.zeros(1, np.int64) for _ in "ab"]

    def _both(self, texts: list[str]) -> list[list[np.ndarray]]:
        """Ids of whole texts that begin with a blank, which the second tokenizer adds itself."""
        second = self._second.encode([t[1:] for t in texts], num_threads=1)
        return [[x.astype(np.int32) for x in self._first.whole(texts)], [np.array(x, np.int32) for x in second]]

    def _learn(self, groups: list[list[tuple[int, bytes]]]) -> None:
        """Remember the tokens of pieces (hash, bytes), those of a group encoded as one text."""
        again = []
        chunks = [b"".join([_LEAD, *(p for _, p in group)]) for group in groups]
        kept: list[list[np.ndarray]] = [[], []]
        counts: list[list[np.ndarray]] = [[], []]
        good, hashes = [], []
        for group, chunk, *both in zip(groups, chunks, *self._both([c.decode() for c in chunks]), strict=True):
            ends = np.cumsum([len(_LEAD), *(len(p) for _, p in group)])
            cuts = []
            for vocabulary, ids in zip((self.a, self.b), both, strict=True):
                at = np.cumsum(vocabulary.lengths[ids])
                place = np.minimum(np.searchsorted(at, ends), max(len(at) - 1, 0))
                right = len(at) > 0 and bool((at[place] == ends).all()) and vocabulary.joined(ids) == chunk
                cuts.append(place + 1 if right else None)
            whole = all(c is not None for c in cuts)
            if not whole and len(group) > 1:
                again += [[one] for one in group]
                continue
            for k, (ids, cut) in enumerate(zip(both, cuts, strict=True)):
                cut = cut if whole else np.zeros(len(group) + 1, np.int64)
                kept[k].append(ids[cut[0] : cut[-1]])
                counts[k].append(np.diff(cut))
            good += [whole] * len(group)
            hashes += [h for h, _ in group]
        fresh = np.array(hashes, np.uint64)
        order = np.argsort(fresh)
        place = np.searchsorted(self._keys, fresh[order])
        self._keys, self._slots = np.insert(self._keys, place, fresh[order]), np.insert(self._slots, place, order + len(self._good))
        self._good = np.concatenate((self._good, np.array(good, bool)))
        for k in range(2):
            self._ids[k] = np.concatenate((self._ids[k], *kept[k]))
            self._at[k] = np.concatenate((self._at[k], self._at[k][-1] + np.cumsum(np.concatenate([np.zeros(0, np.int64), *counts[k]]))))
        if again:
            self._learn(again)

    def _met(self, data: np.ndarray, bounds: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """Ids and offsets of both for texts that begin with a blank, and which of them have only pieces of the right bytes."""
        starts = data == 0x20
        starts[1:] &= ~_WHITE[data[:-1]]
        starts[bounds[:-1][bounds[:-1] < len(data)]] = True
        first = np.flatnonzero(starts)
        last = np.append(first[1:], len(data)) - 1
        distinct, example, inverse = np.unique(run_hashes(data, first, last, BYTE_VALUE), return_index=True, return_inverse=True)
        if len(self._keys) > CACHE_PIECES:
            self.forget()
        new = np.flatnonzero(~_among(self._keys, distinct))
        groups: list[list[tuple[int, bytes]]] = [[]]
        size = 0
        whole = data.tobytes()
        for h, a, b in zip(distinct[new].tolist(), first[example[new]].tolist(), last[example[new]].tolist(), strict=True):
            one = h, whole[a : b + 1]
            if one[1][-1] in _ENDS_WHITE:  # the next piece's blank would follow white space
                groups.insert(0, [one])
                continue
            groups[-1].append(one)
            size += len(one[1])
            if size >= CHUNK_BYTES:
                groups.append([])
                size = 0
        if len(new):
            self._learn([g for g in groups if g])
        slot = self._slots[np.searchsorted(self._keys, distinct)][inverse]
        before = np.searchsorted(first, bounds)  # pieces before each text
        out = []
        for ids, at in zip(self._ids, self._at, strict=True):
            lengths = at[slot + 1] - at[slot]
            ends = np.cumsum(lengths)
            out.append((ids[np.repeat(at[slot] - (ends - lengths), lengths) + np.arange(ends[-1])].astype(np.int64), np.concatenate(([0], ends))[before]))
        wrong = np.concatenate(([0], np.cumsum(~self._good[slot])))
        return out, np.diff(wrong[before]) == 0

    def _whole(self, texts: list[str]) -> list[list[np.ndarray]]:
        """Ids by whole texts; none where the tokens' bytes are not the text."""
        both = self._both(texts)
        nothing = np.zeros(0, np.int32)
        right = [all(v.joined(ids) == t.encode() for v, ids in zip((self.a, self.b), pair, strict=True)) for t, *pair in zip(texts, *both, strict=True)]
        return [[x if ok else nothing for x, ok in zip(side, right, strict=True)] for side in both]

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and offsets of both; texts without tokens, or whose tokens' bytes are not a blank and the text, have none."""
        spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts.cast(pa.large_string()), pa.scalar("", pa.large_string()))
        sizes = pc.fill_null(pc.binary_length(spaced), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        some = sizes > 1
        nothing = np.zeros(0, np.int64), np.zeros(len(sizes) + 1, np.int64)
        sides, right = [nothing, nothing], ~some
        if self._cut and some.any():
            sides, good = self._met(text_bytes(spaced), np.concatenate(([0], np.cumsum(sizes))))
            right |= good
            sides = [_chosen(*side, some & good) for side in sides]
        at = np.flatnonzero(~right)
        if len(at):
            for k, parts in enumerate(self._whole(spaced.take(pa.array(at)).to_pylist())):
                ids, offsets = sides[k]
                each = [ids[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
                for i, part in zip(at.tolist(), parts, strict=True):
                    each[i] = part
                sides[k] = np.concatenate(each).astype(np.int64), np.concatenate(([0], np.cumsum([len(e) for e in each])))
        return *sides[0], *sides[1]


def _chosen(ids: np.ndarray, offsets: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the texts that are kept, and none of the others."""
    counts = np.diff(offsets)
    return ids[np.repeat(kept, counts)], np.concatenate(([0], np.cumsum(np.where(kept, counts, 0))))


_PAIRS: dict[tuple[str, str], Pair] = {}


def _pair(byte_level: str, pieces: str) -> Pair:
    key = (byte_level, pieces)
    if key not in _PAIRS:
        _PAIRS[key] = Pair(byte_level, pieces)
    return _PAIRS[key]


_LISTS = {"a_ids": pa.list_(pa.int32()), "b_ids": pa.list_(pa.int32()), "path": pa.list_(pa.int8())}


def _listed(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind.value_type))


def aligned(docs: DataFrame, byte_level: str, pieces: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, a_ids, b_ids, path`` for each row of ``docs``, written to the shared folder, with a number ``row`` of its own.

    ``a_ids`` are the tokens of a blank and the text by a byte-level vocabulary file, ``b_ids`` those of the text by a
    sentencepiece model that puts a blank in front, special tokens' strings being plain text in both. ``path`` tells for each
    link (pair of tokens with a byte in common) how it ends: 0 both tokens, 1 the first one's alone, 2 the second one's
    alone; a 0 ends a group. Null and empty texts, and texts whose tokens' bytes are not a blank and the text, have empty
    lists. Whole texts are encoded where they lie. Rows of equal id and text come out equal; an empty table has no rows.
    """
    wanted = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kinds = (T.IntegerType(), T.IntegerType(), T.ByteType())
    fields = [T.StructField("row", T.LongType()), wanted.schema["doc_id"]]
    schema = T.StructType([*fields, *(T.StructField(n, T.ArrayType(k)) for n, k in zip(_LISTS, kinds, strict=True))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, row = _pair(byte_level, pieces), TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                a, a_at, b, b_at = pair.encoded(part.column("text"))
                a_ends, b_ends = np.cumsum(pair.a.lengths[a]).tolist(), np.cumsum(pair.b.lengths[b]).tolist()
                paths = [
                    path_of(a_ends[a_at[i] : a_at[i + 1]], b_ends[b_at[i] : b_at[i + 1]]) if a_at[i] < a_at[i + 1] else np.zeros(0, np.uint8)
                    for i in range(part.num_rows)
                ]
                offsets = np.concatenate(([0], np.cumsum([len(p) for p in paths])))
                lists = [(a, a_at), (b, b_at), (np.concatenate([np.zeros(0, np.uint8), *paths]).astype(np.int8), offsets)]
                columns = [_listed(v, o, k) for (v, o), k in zip(lists, _LISTS.values(), strict=True)]
                numbers = pa.array(np.arange(row, row + part.num_rows), pa.int64())
                row += part.num_rows
                yield pa.RecordBatch.from_arrays([numbers, part.column("doc_id"), *columns], ["row", "doc_id", *_LISTS])
        pair.forget()

    with small_batches(docs.sparkSession):
        return stored(wanted.mapInArrow(task, schema), "aligned")


@dataclass(frozen=True)
class Links:
    """The links of several documents: the document, both token numbers (over all of them), and whether a group ends."""

    doc: np.ndarray
    first: np.ndarray
    second: np.ndarray
    ends: np.ndarray
    a: np.ndarray
    b: np.ndarray

    @property
    def pairs(self) -> np.ndarray:
        return (self.a[self.first] << 32) | self.b[self.second]


def _values(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def links(batch: pa.RecordBatch) -> Links:
    """Links of rows of :func:`aligned`: paths of one document after another make one path."""
    path = _values(batch.column("path"))
    counts = pc.list_value_length(batch.column("path")).to_numpy(zero_copy_only=False)
    on_first, on_second = path != SECOND, path != FIRST
    first, second = (np.cumsum(moved) - moved for moved in (on_first, on_second))
    a, b = (_values(batch.column(c)).astype(np.int64) for c in ("a_ids", "b_ids"))
    return Links(np.repeat(np.arange(batch.num_rows), counts), first, second, path == BOTH, a, b)


#: Documents are read back in parts of so many links.
PART_LINKS = 1 << 18


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(pc.list_value_length(batch.column("path")).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PART_LINKS, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _in_documents(found: Links) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of each document, with the document and how many links have them."""
    pairs, code = np.unique(found.pairs, return_inverse=True)
    both, counts = np.unique(found.doc * len(pairs) + code, return_counts=True)
    return (both // len(pairs), pairs[both % len(pairs)], counts) if len(pairs) else (both, both, counts)


def pair_counts(met: DataFrame) -> DataFrame:
    """``a, b, docs, best``: in how many documents of :func:`aligned` the ids are linked, and whether that is the most of ``a``.

    Tasks count before anything is moved, so a pair that every document has is moved once a task.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting: list[np.ndarray] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            pairs, inverse = np.unique(np.concatenate([held[0], *waiting]), return_inverse=True)
            weights = np.concatenate([held[1], np.ones(size, np.int64)])
            return pairs, np.bincount(inverse, weights, len(pairs)).astype(np.int64)

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held[0] >> 32), pa.array(held[0] & 0xFFFFFFFF), pa.array(held[1])], ["a", "b", "n"])

        for batch in batches:
            for part in _parts(batch):
                waiting.append(_in_documents(links(part))[1])
                size += len(waiting[-1])
                if size >= TASK_PAIRS:
                    held, waiting, size = merged(), [], 0
                if len(held[0]) >= TASK_PAIRS:
                    yield told()
                    held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held = merged()
        if len(held[0]):
            yield told()

    counted = met.select(*_LISTS).mapInArrow(task, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("docs"))
    with small_batches(met.sparkSession):
        written = stored(counted, "pair-counts")
    most = written.groupBy(F.col("a").alias("__a")).agg(F.max("docs").alias("__most"))
    return written.join(most, F.col("a") == F.col("__a")).select("a", "b", "docs", (F.col("docs") == F.col("__most")).alias("best"))


def _grouped(group: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of one side, and whether it is its group's last."""
    nothing = np.zeros(0, bool)
    begins = np.concatenate(([True], tokens[1:] != tokens[:-1])) if len(tokens) else nothing
    of = group[begins]
    return of, np.concatenate((of[1:] != of[:-1], [True])) if len(of) else nothing


_NAMES: dict[str, np.ndarray] = {}


def _names(last: str, ids: np.ndarray) -> np.ndarray:
    """Ids as text, each followed by a comma and by what follows a group's last one; kept for a worker."""
    n = int(ids.max()) + 1 if len(ids) else 0
    if last not in _NAMES or len(_NAMES[last]) < 2 * n:
        _NAMES[last] = np.array([f"{i}{c}" for i in range(n + 1000) for c in (",", last)], object)
    return _NAMES[last]


def _printed(found: Links, batch: pa.RecordBatch) -> list[str]:
    """Each document's groups as ``a1,a2|b1;a3|b2,b3``."""
    group = np.cumsum(found.ends) - found.ends
    a, b = found.a, found.b
    (ga, a_closes), (gb, b_closes) = (_grouped(group, tokens) for tokens in (found.first, found.second))
    n_a, n_b = len(a), len(b)
    groups = int(group[-1]) + 1 if len(group) else 0
    a_before, b_before = (np.concatenate(([0], np.cumsum(np.bincount(g, minlength=groups)))) for g in (ga, gb))
    place_a, place_b = np.arange(n_a) + b_before[ga], np.arange(n_b) + a_before[gb + 1]
    texts = np.empty(n_a + n_b, object)
    texts[place_a], texts[place_b] = _names("|", a)[2 * a + a_closes], _names(";", b)[2 * b + b_closes]
    counts = sum(pc.list_value_length(batch.column(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("a_ids", "b_ids"))
    ends_at = np.concatenate(([0], np.cumsum(counts))).tolist()
    listed = texts.tolist()
    return ["".join(listed[s:e])[:-1] for s, e in zip(ends_at, ends_at[1:], strict=False)]


def scored(met: DataFrame, counts: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of each row of :func:`aligned`.

    ``n_best`` are links whose pair has the highest count of its first id, ties included; ``count_sum`` adds up the counts
    of all links. The ``broadcast_pairs`` most frequent pairs go to all tasks; where there are more, the links of the others
    leave the tasks as distinct pairs of a document and meet their counts in a join.
    """
    spark = met.sparkSession
    counts = stored(counts, "counted-pairs")
    many = counts.count() > broadcast_pairs
    sent = counts.orderBy(F.desc("docs"), "a", "b").limit(broadcast_pairs) if many else counts
    table = sent.select(F.shiftleft("a", 32).bitwiseOR(F.col("b")).alias("pair"), "docs", "best").toArrow().sort_by("pair")
    known = tuple(table.column(c).to_numpy() for c in ("pair", "docs", "best"))
    shipped = spark.sparkContext.broadcast(known)

    def looked_up(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each pair among the shipped ones, and whether it is there."""
        place = np.minimum(np.searchsorted(shipped.value[0], pairs), max(len(shipped.value[0]) - 1, 0))
        return place, shipped.value[0][place] == pairs if len(shipped.value[0]) else np.zeros(len(pairs), bool)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                found, n = links(part), part.num_rows
                doc, pairs, times = _in_documents(found)
                place, there = looked_up(pairs)
                doc, place, times = doc[there], place[there], times[there]
                sums = np.zeros((2, n), np.int64)
                for total, weight in zip(sums, (shipped.value[1][place], shipped.value[2][place]), strict=True):
                    before = np.concatenate(([0], np.cumsum(times * weight)))  # rows of a document lie together
                    at = np.searchsorted(doc, np.arange(n + 1))
                    total[:] = before[at[1:]] - before[at[:-1]]
                sizes = [pc.list_value_length(part.column(c)).cast(pa.int64()) for c in ("a_ids", "b_ids", "path")]
                groups = np.bincount(found.doc[found.ends], minlength=n).astype(np.int64)
                shas = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in _printed(found, part)]
                columns = [part.column("row"), part.column("doc_id"), sizes[0], sizes[1], groups, sizes[2], sums[1], sums[0], shas]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    kinds = [T.LongType(), met.schema["doc_id"].dataType, *[T.LongType()] * 6, T.StringType()]
    out = met.mapInArrow(task, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]))
    with small_batches(spark):
        out = stored(out, "scored-links")
    if not many:
        return out.drop("row")

    def left_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                doc, pairs, times = _in_documents(links(part))
                out = ~looked_up(pairs)[1]
                rows = part.column("row").to_numpy()[doc[out]]
                columns = [rows, pairs[out] >> 32, pairs[out] & 0xFFFFFFFF, times[out].astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["__row", "a", "b", "times"])

    rare = met.drop("doc_id").mapInArrow(left_over, "__row long, a long, b long, times long").join(counts, ["a", "b"])
    added = rare.groupBy("__row").agg(
        F.sum(F.col("times") * F.col("docs")).alias("__sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("__best")
    )
    joined = out.join(added, F.col("row") == F.col("__row"), "left")
    more = {"n_best": F.col("n_best") + F.coalesce("__best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("__sum", F.lit(0))}
    return joined.withColumns(more).select(*names[1:])
