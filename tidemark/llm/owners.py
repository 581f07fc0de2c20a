"""Exact duplicates by radix tries: of equal texts one row owns the others.

Every task inserts the normalised texts of its rows into a trie and passes on each distinct one once, with its best row
and its count; however many copies a text has, no more than one a task (and one more for each subtree given away) is
moved. Distinct texts are dealt by length and content hash, and a second trie compares them by all their bytes: its
terminal nodes hold the owner. A trie that outgrows its memory writes its heaviest subtree to the shared folder; later
texts that begin like it are added to that file, which gets a trie of its own at the end.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import files
from tidemark.llm.tables import stored
from tidemark.llm.trie import Patricia
from tidemark.llm.words import slices

#: What a trie may hold before it gives a subtree away, and how much text goes to one task at most on average.
TRIE_BYTES = 1 << 26
TASK_BYTES = 1 << 26
NAMES = ("keep_id", "group_size", "kept", "text_sha256")
_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BATCH_BYTES = 1 << 20


def folded(text: bytes) -> bytes:
    """A-Z as a-z, all else as it is."""
    return text.translate(_FOLD)


@dataclass
class Owner:
    """The best row of a text so far, as (id is set, id, -row), its copies, and the local groups it was seen in."""

    best: tuple
    count: int
    groups: list[int] = field(default_factory=list)

    def met(self, best: tuple, count: int, groups: Sequence[int] = ()) -> None:
        self.best, self.count = max(self.best, best), self.count + count
        self.groups.extend(groups)


def _rank(name: object, row: int, largest: bool) -> tuple:
    """What grows with how good a row is as an owner; a null id is worse than any, and of equal ids the first row wins."""
    return (False, 0, -row) if name is None else (True, name if largest else _Reversed(name), -row)


class _Reversed:
    """An id that compares the other way round."""

    __slots__ = ("name",)

    def __init__(self, name: object) -> None:
        self.name = name

    def __eq__(self, other: object) -> bool:
        return self.name == other.name

    def __lt__(self, other: _Reversed) -> bool:
        return other.name < self.name


def _id_of(best: tuple) -> object:
    if not best[0]:
        return None
    return best[1].name if isinstance(best[1], _Reversed) else best[1]


class _Limit:
    """When to look for a subtree again: what one look could not free is not looked for at every row."""

    def __init__(self, most: int) -> None:
        self.most = self.next = most

    def reached(self, trie: Patricia) -> bool:
        return trie.size > self.next

    def looked(self, trie: Patricia) -> None:
        self.next = max(self.most, 2 * trie.size)


def _rows_schema(kind: pa.DataType, carried: pa.DataType) -> pa.Schema:
    """A row with its local group, or a local group with its text, best row and count."""
    fields = [
        ("row", pa.int64()), ("id", kind), ("carried", carried), ("sha", pa.string()), ("group", pa.int64()),
        ("text", pa.binary()), ("length", pa.int64()), ("key", pa.int64()), ("n", pa.int64()),
    ]
    return pa.schema(fields)


def _content_key(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _grouped(batches: Iterator[pa.RecordBatch], largest: bool, most: int) -> Iterator[pa.RecordBatch]:
    """Rows of one task with the number of their local group, and the local groups themselves."""
    first = TaskContext.get().partitionId() << 33
    rows = groups = 0
    trie, limit, schema = Patricia(), _Limit(most), None

    def given(strings: list[tuple[bytes, Owner]]) -> Iterator[pa.RecordBatch]:
        """Local groups as they leave the trie."""
        at = 0
        while at < len(strings):
            held, size = [], 0
            while at < len(strings) and (size < _BATCH_BYTES or not held):
                held.append(strings[at])
                size += len(strings[at][0])
                at += 1
            texts = [t for t, _ in held]
            columns = {
                "row": [-o.best[2] for _, o in held], "id": [_id_of(o.best) for _, o in held], "group": [o.groups[0] for _, o in held],
                "text": texts, "length": [len(t) for t in texts], "key": [_content_key(hashlib.sha256(t).digest()) for t in texts],
                "n": [o.count for _, o in held],
            }
            nothing = [None] * len(held)
            yield pa.RecordBatch.from_arrays([pa.array(columns.get(f.name, nothing), f.type) for f in schema], schema=schema)

    for batch in batches:
        if schema is None:
            schema = _rows_schema(batch.schema.field("id").type, batch.schema.field("carried").type)
        for part in slices(batch, "text"):
            texts = pc.fill_null(part.column("text"), "").cast(pa.large_binary()).to_pylist()
            names = part.column("id").to_pylist()
            shas, local = [], []
            for name, raw in zip(names, texts, strict=True):
                text = folded(raw)
                shas.append(hashlib.sha256(text).hexdigest())
                node = trie.place(text)
                best = _rank(name, first + rows, largest)
                if node.value is None:
                    node.value = Owner(best, 1, [first + groups])
                    groups += 1
                else:
                    node.value.met(best, 1)
                local.append(node.value.groups[0])
                rows += 1
            numbers = pa.array(range(first + rows - len(texts), first + rows), pa.int64())
            columns = {"row": numbers, "id": part.column("id"), "carried": part.column("carried"), "sha": pa.array(shas), "group": pa.array(local, pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(len(texts), f.type) for f in schema], schema=schema)
            while limit.reached(trie):
                if heavy := trie.heaviest():
                    yield from given(trie.cut(*heavy)[0])
                limit.looked(trie)
    if schema is not None:
        yield from given(list(trie.strings()))


class _Away:
    """A file of the strings of a subtree that has left the trie, and the files of those that left from ``inside`` it."""

    def __init__(self, base: str, kind: pa.DataType) -> None:
        self.schema = pa.schema(
            [("text", pa.binary()), ("id", kind), ("row", pa.int64()), ("n", pa.int64()), ("groups", pa.list_(pa.int64()))]
        )
        self.address, self._out = files.created(base, ".arrows")
        self._writer = pa.ipc.new_stream(self._out, self.schema)
        self.inside: list[_Away] = []
        self._held: list[tuple] = []
        self._size = 0

    def add(self, text: bytes, best: tuple, count: int, groups: Sequence[int]) -> None:
        self._held.append((text, _id_of(best), -best[2], count, list(groups)))
        self._size += len(text)
        if self._size > _BATCH_BYTES:
            self._write()

    def _write(self) -> None:
        if self._held:
            columns = [pa.array(values, f.type) for values, f in zip(zip(*self._held, strict=True), self.schema, strict=True)]
            self._writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self._held, self._size = [], 0

    def strings(self, largest: bool) -> Iterator[tuple[bytes, tuple, int, list[int]]]:
        self._write()
        self._writer.close()
        self._out.close()
        with files.opened(self.address) as source, pa.ipc.open_stream(source) as reader:
            for batch in reader:
                for r in batch.to_pylist():
                    yield r["text"], _rank(r["id"], r["row"], largest), r["n"], r["groups"]
        for file in self.inside:
            yield from file.strings(largest)


def _owned(strings: Iterator[tuple[bytes, tuple, int, Sequence[int]]], base: str, kind: pa.DataType, largest: bool, most: int) -> Iterator[Owner]:
    """The owner of each distinct string; a subtree beyond ``most`` bytes waits in a file until the others are done."""
    trie, limit, away = Patricia(), _Limit(most), []
    for text, best, count, groups in strings:
        node = trie.place(text)
        if node.away is not None:
            node.away.add(text, best, count, groups)
        elif node.value is None:
            node.value = Owner(best, count, list(groups))
        else:
            node.value.met(best, count, groups)
        while limit.reached(trie):
            if heavy := trie.heaviest():
                file = _Away(base, kind)
                taken, file.inside = trie.cut(*heavy, file)
                for string, owner in taken:
                    file.add(string, owner.best, owner.count, owner.groups)
                away = [f for f in away if f not in file.inside] + [file]
            limit.looked(trie)
    for _, owner in trie.strings():
        yield owner
    del trie
    for file in away:
        yield from _owned(file.strings(largest), base, kind, largest, most)


def owners(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "largest", carry: Sequence[str] | None = None,
    trie_bytes: int = TRIE_BYTES, names: Sequence[str] = NAMES,
) -> DataFrame:
    """A row for each row of ``docs``: the ``carry`` columns (the id) and ``keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are, A-Z as a-z; null is the empty text. The row of the ``largest`` (or
    ``smallest``) id stays; a null id is worse than any, and of rows of that id, or of null ones only, the first read
    stays: one row of each group is ``kept``. ``text_sha256`` is of the normalised text. Carried columns that have one
    of ``names`` are replaced. An empty table has no rows.

    The rows with their local groups, and each task's distinct texts, are written once to the shared folder.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep is largest or smallest, not {keep!r}")
    largest = keep == "largest"
    spark = docs.sparkSession
    carry = [c for c in ([doc_id] if carry is None else carry) if c not in names]
    id_type = docs.schema[doc_id].dataType
    wanted = docs.select(
        F.col(f"`{doc_id}`").alias("id"),
        F.col(f"`{text}`").alias("text"),
        F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in carry)).alias("carried"),
    )
    long, string = T.LongType(), T.StringType()
    fields = [("row", long), ("id", id_type), ("carried", wanted.schema["carried"].dataType), ("sha", string), ("group", long)]
    fields += [("text", T.BinaryType()), ("length", long), ("key", long), ("n", long)]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    met = stored(wanted.mapInArrow(lambda batches: _grouped(batches, largest, trie_bytes), schema), "owners")

    groups = met.where("text IS NOT NULL").select("group", "row", "id", "text", "length", "key", "n")
    total = groups.agg(F.sum("length")).first()[0] or 0
    tasks = math.ceil(total / TASK_BYTES)
    wide = [tasks] if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else []
    base = files.folder(spark, "subtrees")

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, tuple, int, list[int]]]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("text", "id", "row", "n", "group"))
            for value, name, row, n, group in zip(*columns, strict=True):
                yield value, _rank(name, row, largest), n, [group]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        kind = first.schema.field("id").type

        def chained() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        held: list[tuple] = []
        for owner in _owned(strings(chained()), base, kind, largest, trie_bytes):
            held += [(group, _id_of(owner.best), -owner.best[2], owner.count) for group in owner.groups]
            if len(held) >= 50_000:
                yield _table(held, kind)
                held = []
        if held:
            yield _table(held, kind)

    result = T.StructType([T.StructField(n, t) for n, t in (("__group", long), ("__id", id_type), ("__row", long), ("__n", long))])
    found = groups.repartition(*wide, "length", "key").mapInArrow(task, result)
    rows = met.where("text IS NULL").select("row", "sha", "group", "carried")
    keep_id, size, kept, sha = names
    return rows.join(found, F.col("group") == F.col("__group")).select(
        *(F.col(f"carried.`{c}`") for c in carry),
        F.col("__id").alias(keep_id),
        F.col("__n").alias(size),
        (F.col("row") == F.col("__row")).alias(kept),
        F.col("sha").alias(sha),
    )


def _table(held: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = (pa.int64(), kind, pa.int64(), pa.int64())
    columns = [pa.array(values, k) for values, k in zip(zip(*held, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["__group", "__id", "__row", "__n"])


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, whole and in its columns."""
    names = tuple(f"__{n}" for n in NAMES)
    found = owners(docs, doc_id, text, keep, docs.columns, names=names)
    return found.where("__kept").select(*(F.col(f"`{c}`") for c in docs.columns))
