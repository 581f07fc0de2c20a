"""Token files in planes: fixed-size blocks of ids, transposed into byte or bit planes, each compressed by itself.

A file is MAGIC, the planes of all blocks, a footer, the footer's length (8 bytes, little-endian) and MAGIC again. The
footer, a zstandard frame of JSON, has the chunk index (for each block its place, its number of ids and the length of
each plane) and the place of the document index: ids, validity and token counts of the documents, in file order.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import files
from tidemark.llm.tables import lean, stored
from tidemark.llm.tokens import Ids, encoder
from tidemark.llm.words import slices

MAGIC = b"IDPLANE1"
BLOCK_IDS = 1 << 16
DOCS_PER_FILE = 20_000
_TAIL = 8 + len(MAGIC)


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Planes of little-endian 32-bit ids: byte j of all ids, or bit j of all ids from the lowest, eight ids in a byte."""
    columns = np.ascontiguousarray(ids.astype("<u4", copy=False)).view(np.uint8).reshape(-1, 4)
    if bits:
        columns = np.unpackbits(columns, axis=1, bitorder="little")
        return [np.packbits(c, bitorder="little").tobytes() for c in columns.T]
    return [np.ascontiguousarray(c).tobytes() for c in columns.T]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    columns = [np.frombuffer(p, np.uint8) for p in planes]
    if len(planes) == 32:
        table = np.stack([np.unpackbits(c, count=n, bitorder="little") for c in columns], axis=1)
        return np.packbits(table, axis=1, bitorder="little").view("<u4").ravel()
    return np.ascontiguousarray(np.stack(columns, axis=1)).view("<u4").ravel()


class PlaneWriter:
    def __init__(self, base: str, bits: bool = False, block_ids: int = BLOCK_IDS, level: int = 3) -> None:
        self.address, self._out = files.created(base, ".planes")
        self._bits, self._block = bits, block_ids
        self._zstd = zstandard.ZstdCompressor(level=level)
        self._at = self._out.write(MAGIC)
        self._chunks: list[list] = []
        self._held: list[np.ndarray] = []
        self._held_ids = 0
        self._docs: list[int | None] = []
        self._counts: list[int] = []
        self.n_ids = 0

    def add(self, doc_ids: list[int | None], texts: Ids) -> None:
        self._docs += doc_ids
        self._counts += texts.counts.tolist()
        self._held.append(texts.ids)
        self._held_ids += len(texts.ids)
        if self._held_ids >= self._block:
            self._flush(whole=False)

    def _frames(self, ids: np.ndarray) -> list[int]:
        frames = [self._zstd.compress(p) for p in to_planes(ids, self._bits)]
        self._out.write(b"".join(frames))
        return [len(f) for f in frames]

    def _flush(self, whole: bool) -> None:
        ids = np.concatenate([np.zeros(0, np.uint32), *self._held])
        stop = len(ids) if whole else len(ids) - len(ids) % self._block
        for i in range(0, stop, self._block):
            block = ids[i : min(i + self._block, stop)]
            lengths = self._frames(block)
            self._chunks.append([self._at, len(block), lengths])
            self._at += sum(lengths)
        self.n_ids += stop
        self._held, self._held_ids = [ids[stop:]], len(ids) - stop

    def close(self) -> tuple[int, int]:
        """Numbers of documents and of ids in the file."""
        self._flush(whole=True)
        index = np.array([[d or 0, d is not None, n] for d, n in zip(self._docs, self._counts, strict=True)], "<i8").reshape(-1, 3)
        packed = self._zstd.compress(np.ascontiguousarray(index.T).tobytes())
        self._out.write(packed)
        footer = {"chunks": self._chunks, "docs": [self._at, len(packed)], "n_docs": len(self._docs), "n_ids": self.n_ids}
        packed = self._zstd.compress(json.dumps(footer).encode())
        self._out.write(packed + len(packed).to_bytes(8, "little") + MAGIC)
        self._out.close()
        return len(self._docs), self.n_ids


class PlaneReader:
    """Random access by block, and documents one after another in bounded memory."""

    def __init__(self, address: str) -> None:
        self._in = files.opened(address)
        size = self._in.size()
        tail = self._in.read_at(_TAIL, size - _TAIL)
        if tail[8:] != MAGIC:
            raise ValueError(f"not a file of id planes, or not written to its end: {address}")
        n = int.from_bytes(tail[:8], "little")
        self._zstd = zstandard.ZstdDecompressor()
        self.footer = json.loads(self._zstd.decompress(self._in.read_at(n, size - _TAIL - n)))

    def block(self, i: int) -> np.ndarray:
        at, n, lengths = self.footer["chunks"][i]
        data = self._in.read_at(sum(lengths), at)
        ends = np.cumsum([0, *lengths])
        return from_planes([self._zstd.decompress(data[a:b]) for a, b in zip(ends, ends[1:], strict=False)], n)

    def documents(self) -> Iterator[tuple[int | None, list[np.ndarray]]]:
        """Document id and its ids, in pieces that blocks cut."""
        at, n = self.footer["docs"]
        index = np.frombuffer(self._zstd.decompress(self._in.read_at(n, at)), "<i8").reshape(3, -1)
        block, i, place = np.zeros(0, "<u4"), 0, 0
        for doc, valid, count in index.T.tolist():
            pieces = []
            while count:
                if place == len(block):
                    block, i, place = self.block(i), i + 1, 0
                piece = block[place : place + count]
                pieces.append(piece)
                place, count = place + len(piece), count - len(piece)
            yield (doc if valid else None), pieces


def write(
    docs: DataFrame, tokenizer: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text", bits: bool = False,
    block_ids: int = BLOCK_IDS, special_as_text: bool = False, order: Sequence[Column] = (),
) -> DataFrame:
    """Encode every text, put ``end_id`` behind it, and write the ids into plane files, in ascending document id or by
    the columns of ``order`` instead, such as ``tables.written_order``.

    Returns the manifest, a written table with a row per file: ``file`` (its place in the order), ``address``, ``docs``,
    ``ids`` and ``start``, the ids of all earlier files. Null texts are empty; a null id comes first; rows that are equal
    in the order are sorted by id and text, and repeated rows are all written. Each file is one task's range of the order.
    """
    spark = docs.sparkSession
    base = files.folder(spark, "planes")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.count() // DOCS_PER_FILE)
    doc = F.col(f"`{doc_id}`").cast("long").alias("doc")
    keys = [c.alias(f"key{i}") for i, c in enumerate(order or (doc,))]
    rows, by = docs.select(doc, F.col(f"`{text}`").alias("text"), *keys), [f"key{i}" for i in range(len(keys))]
    sorted_ = rows.repartitionByRange(n, *by).sortWithinPartitions(*by, "doc", "text")
    ordered = sorted_.select("doc", "text", F.spark_partition_id().alias("file"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, file = None, None
        encode = encoder(tokenizer, special_as_text).encode
        for batch in batches:
            for part in slices(batch, "text"):
                if to is None:
                    to, file = PlaneWriter(base, bits, block_ids), part.column("file")[0].as_py()
                to.add(part.column("doc").to_pylist(), encode(part.column("text")).ended(end_id))
        if to is not None:
            n_docs, n_ids = to.close()
            yield pa.RecordBatch.from_pydict({"file": pa.array([file], pa.int64()), "address": [to.address], "docs": [n_docs], "ids": [n_ids]})

    manifest = stored(ordered.mapInArrow(lean(task), "file long, address string, docs long, ids long"), "planes-manifest")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read(manifest: DataFrame) -> DataFrame:
    """A row per document, read from the files: ``doc_id, start`` (ids of all documents before), ``n_tokens, ids_crc32``.

    The checksum is that of the ids as little-endian unsigned 32-bit integers. A file is one task, block after block.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                start, out = row["start"], []
                for doc, pieces in PlaneReader(row["address"]).documents():
                    crc = n = 0
                    for p in pieces:
                        crc = zlib.crc32(p, crc)
                        n += len(p)
                    out.append((doc, start, n, crc))
                    start += n
                columns = zip(*out, strict=True) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return manifest.select("address", "start").repartition(max(1, manifest.count())).mapInArrow(lean(task), "doc_id long, start long, n_tokens long, ids_crc32 long")

