"""Plain Python versions of what the operators compute, and small documents to compute it on."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def folded(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", folded(text))


def alphanumeric(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded(text))


def shingle_set(text: str | None, k: int = 5) -> set[tuple[str, ...]]:
    words = spaced(text)
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def documents(spark: SparkSession, rows: list[tuple], schema: str = "doc_id long, text string") -> DataFrame:
    return spark.createDataFrame(rows, schema)


def prose(rng, n: int, vocabulary: int = 4000) -> list[str]:
    return [f"w{i}" for i in rng.integers(0, vocabulary, n)]


def linked_components(sets: dict[int, set], linked) -> dict[int, int]:
    """Smallest id reachable; ``linked`` decides on two sets."""
    root = {i: i for i in sets}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if linked(sets[a], sets[b]):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {i: find(i) for i in ids}
