"""N-gram Jaccard join: exact links between documents whose sets of word shingles are alike.

Sets are sorted arrays of 64-bit shingle hashes. Linked documents share one of the first shingles of both sets in a common
order, so documents meet in tiles of a shingle and a band of set sizes. In a tile, parity bitmaps decide first: the bits in
which two bitmaps differ are at most the shingles in which the sets differ, which bounds the overlap from above. What
passes is decided by intersecting the sorted arrays. Shingles that the same documents have, as those of a shared passage,
make one tile.

Three things keep hot groups from being multiplied out. Equal sets are one node. Documents that share a minimum hash are
first compared with one leader each, and tiles pair only documents that these links leave apart. And shingles that many
documents have go last in the common order, so that they make tiles only where nothing rarer is left; tiles beyond a
number of rows are cut into pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.tables import lean, likely, released, small_batches, stored
from tidemark.llm.words import SPACED, hashed_words, mixed, shingles, slices

SHINGLE_WORDS = 5
#: Leaders a document is compared with at most, one for each minimum hash.
LEADERS = 4
#: A shingle that so many documents have among their first goes behind rarer ones; so many such shingles at most.
FREQUENT, MOST_FREQUENT = 64, 1 << 17
BLOCK_ROWS = 1024
_LEAST_BITS = 64
_SEEDS = mixed(np.arange(1, LEADERS + 3, dtype=np.uint64))


def _sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Each text's distinct shingle hashes, ascending."""
    runs = shingles(hashed_words(texts, SPACED), k)
    for a, b in zip(runs.offsets, runs.offsets[1:], strict=False):
        yield np.unique(runs.hashes[a:b])


def _bits(n: int) -> int:
    return max(_LEAST_BITS, 4 << (n - 1).bit_length()) if n else _LEAST_BITS


def _parity(values: np.ndarray) -> bytes:
    """Bit i is the parity of the number of hashes that fall on it; four bits or more for each hash, a power of two.

    With fewer bits, differences cancel out so often that sets of 0.65 pass for 0.75.
    """
    width = _bits(len(values))
    odd = np.bincount((values & np.uint64(width - 1)).astype(np.int64), minlength=width).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").tobytes()


def _folded(bitmap: bytes, words: int) -> np.ndarray:
    bits = np.frombuffer(bitmap, "<u8")
    return np.bitwise_xor.reduce(bits.reshape(-1, words), axis=0)


def _mapped(docs: DataFrame, task, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield task(part)

    return docs.mapInArrow(lean(run), schema)


def sketches(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, n`` (set size), ``d1, d2`` (a digest of the set), ``keys`` (minimum hashes) and the parity ``bitmap``."""

    def task(part: pa.RecordBatch) -> pa.RecordBatch:
        n, digests, keys, bitmaps = [], [], [], []
        for s in _sets(part.column("text"), k):
            n.append(len(s))
            hashed = [mixed(s ^ seed) for seed in _SEEDS]
            digests.append([int(h.sum().view(np.int64)) if len(s) else 0 for h in hashed[LEADERS:]])
            keys.append([int(h.min().view(np.int64)) for h in hashed[:LEADERS]] if len(s) else [])
            bitmaps.append(_parity(s))
        d1, d2 = zip(*digests, strict=True)
        columns = [pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(bitmaps, pa.binary())]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", "n", "d1", "d2", "keys", "bitmap"])

    return _mapped(docs, task, "doc_id long, n long, d1 long, d2 long, keys array<long>, bitmap binary")


def _prefixes(docs: DataFrame, frequent: np.ndarray, k: int) -> DataFrame:
    """``doc_id, token`` of the first shingles in the common order: frequent ones last, else ascending hashes.

    n - ceil(0.75 n) + 1 of n are enough: sets without one of these in common share fewer than 0.75 n.
    """

    def task(part: pa.RecordBatch) -> pa.RecordBatch:
        first, counts = [], []
        for s in _sets(part.column("text"), k):
            keep = len(s) // 4 + 1 if len(s) else 0
            if len(frequent) and keep:
                at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                late = frequent[at] == s
                s = np.concatenate((s[~late], s[late]))
            first.append(s[:keep])
            counts.append(keep)
        docs_of = np.repeat(np.arange(part.num_rows), counts)
        tokens = np.concatenate([np.zeros(0, np.uint64), *first]).view(np.int64)
        return pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(docs_of)), pa.array(tokens)], ["doc_id", "token"])

    return _mapped(docs, task, "doc_id long, token long")


def _linked(pairs: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """The pairs ``a, b`` with 100 * intersection >= 75 * union, by their whole texts."""
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    texts = stored(likely(docs, ids), "pair-texts")
    left, right = (texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"{c}_text")) for c in "ab")
    both = pairs.join(right, "b").join(left, "a")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for outer in slices(batch, "a_text"):
                for part in slices(outer, "b_text"):
                    names, where = np.unique(part.column("a").to_numpy(), return_index=True)
                    own = zip(part.column("a").to_pylist(), _sets(part.column("b_text"), k), strict=True)
                    keep = []
                    if len(names) * 2 < part.num_rows:  # leaders recur; a repeated id may have several texts
                        texts_of = part.column("a_text").dictionary_encode()
                        lefts = list(_sets(texts_of.dictionary, k))
                        chosen = (lefts[i] for i in texts_of.indices.to_pylist())
                    else:
                        chosen = _sets(part.column("a_text"), k)
                    for x, (_, y) in zip(chosen, own, strict=True):
                        shared = len(np.intersect1d(x, y, assume_unique=True))
                        keep.append(shared > 0 and 7 * shared >= 3 * (len(x) + len(y)))
                    yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "a_text", "b_text").mapInArrow(lean(task), "a long, b long").distinct()


def _led(nodes: DataFrame) -> DataFrame:
    """Candidates ``a, b``: each document with the smallest id of those that share a minimum hash and a size band."""
    keyed = nodes.select("doc_id", "band", F.posexplode("keys").alias("j", "key"))
    leaders = keyed.groupBy("j", "key", "band").agg(F.min("doc_id").alias("a"), F.count("*").alias("c")).where("c > 1").drop("c")
    return keyed.join(leaders, ["j", "key", "band"]).where("a <> doc_id").select("a", F.col("doc_id").alias("b")).distinct()


def _tiles(apart: DataFrame, block_rows: int) -> DataFrame:
    """Rows of documents dealt to tiles ``token, tile, i, j``; side 0 is block i, side 1 block j, 2 both at once.

    A set of band b may link with band b + 1, so it also visits that tile. Tiles of more than ``block_rows`` rows are
    cut into blocks, and each pair of blocks is a tile.
    """
    visits = F.explode(F.array(F.struct(F.col("band").alias("tile"), F.lit(True).alias("home")), F.struct((F.col("band") + 1).alias("tile"), F.lit(False).alias("home"))))
    dealt = apart.select("token", "doc_id", "component", visits.alias("v")).select("token", "doc_id", "component", "v.*")
    tile = Window.partitionBy("token", "tile")
    busy = dealt.withColumns(
        {"rows": F.count("*").over(tile), "homes": F.count(F.when(F.col("home"), 1)).over(tile), "lo": F.min("component").over(tile), "hi": F.max("component").over(tile)}
    ).where("homes > 0 AND rows > 1 AND lo <> hi")
    blocks = F.ceil(F.col("rows") / block_rows).cast("int")
    block = F.pmod(F.xxhash64("doc_id"), blocks).cast("int")
    cut = busy.withColumns({"g": blocks, "x": block}).withColumn("y", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    return cut.select("token", "tile", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), (F.col("x") > F.col("y")).alias("second"), "home", "doc_id", "component")


def _passing(rows: list[np.ndarray], bitmaps: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one tile in different components, not both visitors, whose bitmaps allow 0.75."""
    doc, n, component, home, second = rows
    words = min(len(b) for b in bitmaps) // 8
    bits = np.stack([_folded(b, words) for b in bitmaps])
    halves = (np.flatnonzero(~second), np.flatnonzero(second)) if second.any() and not second.all() else None
    left, right = halves or (np.arange(len(doc)),) * 2
    step = max(1, (1 << 20) // (len(right) * words))
    for at in range(0, len(left), step):
        some = left[at : at + step]
        differ = np.bitwise_count(bits[some, None, :] ^ bits[None, right, :]).sum(axis=2, dtype=np.int64)
        fits = 7 * differ <= n[some, None] + n[None, right]
        fits &= (component[some, None] != component[None, right]) & (home[some, None] | home[None, right])
        a, b = np.nonzero(fits)
        yield doc[some[a]], doc[right[b]]


def _candidates(tiles: DataFrame) -> DataFrame:
    """Distinct pairs ``a < b`` that pass the bitmaps of some tile."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
            key = np.stack([held.column(c).to_numpy() for c in ("token", "tile", "i", "j")])
            starts = np.concatenate(([0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1))
            if len(starts) > 1:  # the last tile may go on in the next batch
                yield from paired(held.slice(0, starts[-1]), starts[:-1])
                held = held.slice(starts[-1])
        if held is not None and held.num_rows:
            yield from paired(held.combine_chunks(), np.array([0]))

    def paired(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        columns = [table.column(c).to_numpy() for c in ("doc_id", "n", "component", "home", "second")]
        bitmaps = table.column("bitmap").to_pylist()
        found: list[np.ndarray] = []
        for a, b in zip(starts, [*starts[1:], table.num_rows], strict=True):
            for x, y in _passing([c[a:b] for c in columns], bitmaps[a:b]):
                if len(x):
                    found.append(np.stack([np.minimum(x, y), np.maximum(x, y)]))
        if found:
            pairs = np.unique(np.concatenate(found, axis=1), axis=1)
            pairs = pairs[:, pairs[0] < pairs[1]]
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    spread = tiles.repartition("token", "tile", "i", "j").sortWithinPartitions("token", "tile", "i", "j")
    return spread.mapInArrow(lean(task), "a long, b long").distinct()


def _links(docs: DataFrame, k: int, frequent: int, block_rows: int) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    shape = stored(sketches(docs, k), "sketches")
    sized = shape.where("n > 0 AND doc_id IS NOT NULL")
    copies = sized.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("first"), F.count("*").alias("c")).where("c > 1").drop("c")
    marked = sized.join(copies, ["d1", "d2", "n"], "left")
    same = marked.where("first <> doc_id").select(F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct()
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4 / 3))).cast("long").alias("band")
    nodes = stored(marked.where("first IS NULL OR first = doc_id").select("doc_id", "n", band, "keys", "bitmap").distinct(), "nodes")
    same = stored(same, "copies")
    led = stored(_linked(stored(_led(nodes), "led"), docs, k), "led-links")
    released(spark)
    joined = stored(components(led), "led-components")
    stars = joined.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))
    counts = _prefixes(docs, np.zeros(0, np.uint64), k).groupBy("token").count().where(F.col("count") >= frequent)
    often = counts.orderBy(F.desc("count"), "token").limit(MOST_FREQUENT).collect()
    late = np.sort(np.array([r.token for r in often], np.int64).view(np.uint64))
    released(spark)
    shared = F.count("*").over(Window.partitionBy("token"))
    met = stored(_prefixes(docs.where("doc_id IS NOT NULL"), late, k).withColumn("c", shared).where("c > 1").drop("c"), "met")
    about = nodes.select("doc_id", "band").join(joined, F.col("doc_id") == F.col("node"), "left")
    about = about.select("doc_id", "band", F.coalesce("component", "doc_id").alias("component")).distinct()
    token = Window.partitionBy("token")
    members = F.struct(F.bit_xor(F.xxhash64("doc_id")).over(token).alias("digest"), F.count("*").over(token).alias("members"))
    apart = met.join(about, "doc_id").withColumns({"lo": F.min("component").over(token), "hi": F.max("component").over(token), "of": members})
    groups = apart.where("lo <> hi").select(F.col("of").alias("token"), "doc_id", "band", "component").distinct()
    tiles = _tiles(groups.withColumn("token", F.xxhash64("token")), block_rows)
    drawn = tiles.join(nodes.select("doc_id", "n", "bitmap"), "doc_id")
    pairs = stored(_candidates(drawn), "candidates")
    released(spark)
    exact = stored(_linked(pairs, docs, k), "links")
    released(spark)
    return shape.select("doc_id", "n"), reduce(DataFrame.unionByName, [same, stars, exact])


def links(docs: DataFrame, k: int = SHINGLE_WORDS, frequent: int = FREQUENT, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """``doc_id, n`` of each row of ``docs`` (doc_id, text), and links ``a, b`` that have the join's components.

    All links between different sets that the leaders' links do not already join are found; null ids link nothing.
    """
    with small_batches(docs.sparkSession):
        return _links(docs, k, frequent, block_rows)


def joined(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row: set size, and the smallest id reachable by links.

    Words are runs of anything but ASCII white space, A-Z as a-z; a text of fewer than ``k`` words, but not none, has one
    shingle. Null and empty texts have none and link with nothing. A null id has a null component and links nothing;
    rows of one id are one document with the links of each of its texts.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    sizes, edges = links(rows, k)
    found = components(edges)
    out = sizes.join(found, F.col("doc_id") == F.col("node"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def deduplicated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = SHINGLE_WORDS) -> DataFrame:
    """One row of each component, of its smallest id; null ids link nothing and all stay.

    Rows of one id with different texts are documents of their own (known by a 64-bit hash of id and text), each dropped
    only where its own text is linked to one that stays; of rows with equal id and text one stays.
    """
    name = F.col(f"`{doc_id}`").cast("long")
    known = docs.where(name.isNotNull())
    repeats = stored(known.groupBy(name.alias("__again")).count().where("count > 1").select("__again"), "repeated-ids")
    if repeats.isEmpty():
        gone = joined(docs, text, doc_id, k).where("component_id <> doc_id").select(F.col("doc_id").alias("__gone")).distinct()
        return docs.join(gone, name == F.col("__gone"), "left_anti")
    own = F.xxhash64("__again", f"`{text}`")
    node = F.when(F.col("__again").isNull(), name).otherwise(F.when(own > 0, -own).otherwise(own))
    marked = known.join(repeats, name == F.col("__again"), "left").withColumn("__node", node)
    _, edges = links(marked.select(F.col("__node").alias("doc_id"), F.col(f"`{text}`").alias("text")), k)
    placed = marked.select("__node", name.alias("__name")).join(components(edges), F.col("__node") == F.col("node"), "left")
    best = placed.groupBy(F.coalesce("component", "__node")).agg(F.min(F.struct("__name", "__node")).alias("__best"))
    kept = marked.join(best.select(F.col("__best.__node").alias("__keep")), F.col("__node") == F.col("__keep"), "left_semi")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return kept.dropDuplicates(["__node"]).select(*columns).unionAll(docs.where(name.isNull()))
