"""Fill-in-the-middle texts: a text cut into prefix, middle and suffix at unit borders, the middle moved to the end.

One fullmatch of ``(unit)*`` with the regex library keeps every repetition of its group, so ``match.ends(1)`` is the
number of units and all places where a cut may fall. The repetition is possessive and its unit atomic: units are taken
from left to right, as a search would find them, and no state is kept to take one back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import slices

#: A line with its end, or a last line without one.
UNIT = r"[^\n]*\n|[^\n]+"
#: What stands before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
NAMES = ("n", "form", "prefix_chars", "middle_chars", "output")
_KINDS = (T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType())


def unit_ends(pattern: regex.Pattern, text: str) -> list[int] | None:
    """The end of each unit, in code points; None where units do not make up the text."""
    match = pattern.fullmatch(text)
    return None if match is None else match.ends(1)


def draws(seed: int, name: object) -> list[int]:
    """Four numbers below 2^32 that a document's id decides; a null id goes by the empty string."""
    digits = hashlib.sha256(f"{seed}:{'' if name is None else name}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def infilled(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: str = UNIT, seed: int = 7, percent: int = 100,
    spm_percent: int = 50, marks: Sequence[str] = MARKS, names: Sequence[str] = NAMES,
) -> DataFrame:
    """``docs`` with the number of units ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Both cuts are drawn from the id among the n + 1 places between units. ``psm`` puts prefix, suffix, middle after
    their marks, ``spm`` suffix, prefix, middle; ``spm_percent`` of a hundred are spm. ``plain`` texts stay as they are and
    have no prefix or middle: empty and null ones (null is the empty text), those in which a mark stands, those that
    ``unit`` does not make up (n is 0), and all but ``percent`` of a hundred. Rows of equal id and text come out equal;
    a null id goes by the empty string. Columns of ``docs`` that have one of ``names`` are replaced. Whole texts are
    cut where they lie, without a shuffle, one after another.
    """
    docs = docs.drop(*names)
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, t in zip(names, _KINDS, strict=True))])
    p_mark, s_mark, m_mark = marks

    def one(pattern: regex.Pattern, name: object, value: str) -> tuple:
        ends = unit_ends(pattern, value)
        n = len(ends) if ends is not None else 0
        h1, h2, h3, h4 = draws(seed, name)
        if not value or ends is None or h3 % 100 >= percent or any(mark in value for mark in marks):
            return n, "plain", None, None, value
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        cut, again = (ends[k - 1] if k else 0 for k in (low, high))
        prefix, middle, suffix = value[:cut], value[cut:again], value[again:]
        if h4 % 100 < spm_percent:
            return n, "spm", cut, again - cut, f"{s_mark}{suffix}{p_mark}{prefix}{m_mark}{middle}"
        return n, "psm", cut, again - cut, f"{p_mark}{prefix}{s_mark}{suffix}{m_mark}{middle}"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = regex.compile(f"((?>{unit}))*+")
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        for batch in batches:
            for part in slices(batch, text):
                rows = zip(part.column(doc_id).to_pylist(), part.column(text).to_pylist(), strict=True)
                found = list(zip(*(one(pattern, name, value or "") for name, value in rows), strict=True))
                added = [pa.array(values, kind) for values, kind in zip(found, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], [*part.schema.names, *names])

    return docs.mapInArrow(task, schema)


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text as it was, from the output alone; marks stand in it once each unless it is plain."""
    parts = F.split(output, "|".join(map(re.escape, marks)), -1)
    prefix, suffix = F.when(form == "psm", parts[1]).otherwise(parts[2]), F.when(form == "psm", parts[2]).otherwise(parts[1])
    return F.when(form == "plain", output).otherwise(F.concat(prefix, parts[3], suffix))
