"""Document fingerprints: threshold-scaled sketches of word shingles, in native expressions only.

A sketch keeps every shingle hash below a fixed fraction of the hash range, whatever the size of its document. So the
sketch of a union is the union of sketches, and the share of one document's sketch found in another's estimates how much
of it the other contains, also when the two differ in length by orders of magnitude.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
#: One in so many shingle hashes is kept.
SCALE = 4
ROWS_PER_RANGE = 4_000
MOST_RANGES = 1 << 14
_SMALLEST = -(1 << 63)


def with_sketch(frame: DataFrame, text: Column, name: str, scale: int = SCALE, k: int = SHINGLE_WORDS) -> DataFrame:
    """``frame`` with ``name``: struct of ``hashes`` (the sketch, ascending) and ``whole`` (a hash of all words).

    Words are runs of anything but ASCII white space, lower-cased. A text of fewer than ``k`` words, but not none, has
    one shingle, its whole sequence; null and empty texts have none. ``whole`` tells texts with empty sketches apart.
    """
    words, keys = f"__{name}_words", f"__{name}_keys"
    split = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D]+"), "")
    out = frame.withColumn(words, split).withColumn(keys, F.transform(words, lambda w: F.xxhash64(w))).drop(words)
    key = F.col(keys)
    run = F.transform(F.sequence(F.lit(0), F.size(key) - k), lambda i: F.xxhash64(*(key[i + j] for j in range(k))))
    all_hashes = F.when(F.size(key) >= k, run).when(F.size(key) > 0, F.array(F.xxhash64(key)))
    limit = (1 << 63) // scale - 1
    kept = F.filter(all_hashes, lambda h: F.shiftrightunsigned(h, 1) <= F.lit(limit))
    hashes = F.coalesce(F.array_sort(F.array_distinct(kept)), F.array().cast("array<bigint>"))
    return out.withColumn(name, F.struct(hashes.alias("hashes"), F.xxhash64(key).alias("whole"))).drop(keys)


def printed(sketch: Column) -> Column:
    """The sketch as text: its hashes in hexadecimal; if it is empty, ``-`` and the hash of all words."""
    digits = F.transform(sketch["hashes"], lambda h: F.lpad(F.lower(F.hex(h)), 16, "0"))
    return F.when(F.size(sketch["hashes"]) > 0, F.concat_ws("", digits)).otherwise(
        F.concat(F.lit("-"), F.lpad(F.lower(F.hex(sketch["whole"])), 16, "0"))
    )


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two documents' shingles; of two empty sketches, whether their words are equal."""
    shared = F.size(F.array_intersect(a["hashes"], b["hashes"]))
    either = F.size(a["hashes"]) + F.size(b["hashes"]) - shared
    return F.when(either > 0, shared / either).otherwise((a["whole"] == b["whole"]).cast("double"))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; null if the sketch of ``a`` is empty."""
    size = F.size(a["hashes"])
    return F.when(size > 0, F.size(F.array_intersect(a["hashes"], b["hashes"])) / size)


def merged(frame: DataFrame, *keys: str, sketch: str = "sketch") -> DataFrame:
    """Sketches of the unions of documents by key, as rows ``keys, hash``: a union grows with its documents."""
    return frame.select(*keys, F.explode(f"{sketch}.hashes").alias("hash")).distinct()


def _below(cuts: list[int], key: Column) -> Column:
    """How many of the ascending cuts are at or below the key: first over every so many cuts, then over those between."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts)) + 1
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    heads = F.lit([g[0] for g in groups])
    group = F.size(F.filter(heads, lambda c: c <= key))
    inner = F.element_at(F.lit(groups), F.greatest(group, F.lit(1)))
    return F.when(group > 0, (group - 1) * step + F.size(F.filter(inner, lambda c: c <= key))).otherwise(F.lit(0))


def _ranges(rows: DataFrame) -> list[int]:
    """Cuts of the ids into ranges of about equally many rows; their number is bounded."""
    n = min(MOST_RANGES, max(1, rows.count() // ROWS_PER_RANGE, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    shares = [i / n for i in range(1, n)]
    if not shares:
        return []
    found = rows.agg(F.percentile_approx("__key", shares, max(10_000, 10 * n))).first()[0]
    return sorted(set(found or ()))


def beside_next(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, Window]:
    """Rows and a window in which ``lead`` reaches the next document in ascending id, and from the last the first.

    Ids are cut into ranges, each one task's sort, so that texts are shuffled once. The documents of a range's first id
    are copied behind the range before it (``__copy``; drop these rows at the end). A null id comes first, rows of one
    id follow in the order of a hash of their texts.
    """
    key = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_SMALLEST))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), key.alias("__key"))
    cuts = _ranges(rows.select("__key"))
    ranged = rows.withColumn("__range", _below(cuts, F.col("__key")))
    firsts = {r[0]: r[1] for r in ranged.groupBy("__range").agg(F.min("__key")).collect()}  # one per range
    used = sorted(firsts)
    before = {r: used[i - 1] for i, r in enumerate(used)}
    here = F.struct(F.col("__range").alias("range"), F.lit(0).alias("copy"))
    places = F.array(here)
    if used:
        targets = F.element_at(F.lit([before.get(r, 0) for r in range(used[-1] + 1)]), F.col("__range") + 1)
        first = F.col("__key").isin(list(firsts.values()))
        places = F.when(first, F.array(here, F.struct(targets.alias("range"), F.lit(1).alias("copy")))).otherwise(places)
    copied = ranged.withColumn("__place", F.explode(places)).select(
        "doc_id", "text", "__key", F.col("__place.range").alias("__range"), F.col("__place.copy").alias("__copy"),
        F.xxhash64("text").alias("__hash"),
    )
    return copied, Window.partitionBy("__range").orderBy("__copy", "__key", "__hash")


def compared(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", scale: int = SCALE) -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and how alike they are.

    The edited text has its last quarter (rounded down, in code points) replaced by the first as many code points, or
    all, of the next document. Columns: doc_id, n_chars, edited (text), sketch, edited_sketch, next_sketch. Null texts
    count as empty; a document by itself is its own next; no rows give no rows.
    """
    rows, order = beside_next(docs, text, doc_id)
    own = F.coalesce(F.col("text"), F.lit(""))
    following = F.coalesce(F.lead("text").over(order), F.lit(""))
    both = rows.withColumns({"__next": following, "n_chars": F.char_length(own).cast("long")})
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.left(own, (F.col("n_chars") - quarter).cast("int")), F.left(F.col("__next"), quarter))
    texts = both.withColumn("edited", edited).drop("__next")
    sketched = with_sketch(with_sketch(texts, F.col("text"), "sketch", scale), F.col("edited"), "edited_sketch", scale)
    result = sketched.withColumn("next_sketch", F.lead("sketch").over(order)).where("__copy = 0")
    return result.select("doc_id", "n_chars", "edited", "sketch", "edited_sketch", "next_sketch")
