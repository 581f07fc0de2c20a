"""Fill-in-the-middle texts against plain cutting, and back."""

from __future__ import annotations

import hashlib
import re

import pytest
from helpers import documents
from pyspark.sql import functions as F

from tidemark.llm import infill

TEXTS = [
    None, "", "\n", "\n\n\n", "one line", "one\ntwo\n", "one\ntwo", "a <P> b\nc", "x<S>y", "<M>", "ünï\ncödé 🙂\n\n🙂", "\r\nwindows\r\n", " <\nS>",
    "".join(f"line {i} {'w' * (i % 7)}\n" for i in range(400)), "x" * 300_000, ("y" * 9 + "\n") * 60_000,
]


def expected(name, text):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if name is None else name}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h4 % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_against_plain_cutting_and_back(spark):
    rows = [(i * 7, t) for i, t in enumerate(TEXTS * 3)] + [(None, "no id\nat all"), (3, "same\n"), (3, "same\n")]
    made = infill.infilled(documents(spark, rows)).withColumn("back", infill.restored(F.col("output"), F.col("form")))
    got = [tuple(r) for r in made.collect()]
    want = [(i, t, *expected(i, t), t or "") for i, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {r[3] for r in got} == {"plain", "psm", "spm"}


def test_columns_of_the_same_names_are_replaced_and_others_stay(spark):
    docs = spark.createDataFrame([(1, "a\nb\n", "x", "keep")], "doc_id long, text string, output string, other string")
    made = infill.infilled(docs)
    assert made.columns == ["doc_id", "text", "other", *infill.NAMES]
    (row,) = made.collect()
    assert row.other == "keep" and row.output == expected(1, "a\nb\n")[4]


def test_empty_table(spark):
    assert infill.infilled(documents(spark, [])).collect() == []


def test_other_units_marks_and_shares(spark):
    docs = documents(spark, [(i, "one two three four") for i in range(60)] + [(99, "no-blank ")])
    made = infill.infilled(docs, unit=r"\S+\s*", percent=50, spm_percent=0, marks=("[[", "]]", "{{")).collect()
    assert {r.form for r in made} == {"plain", "psm"}
    assert all(r.output.startswith("[[") == (r.form == "psm") for r in made)
    assert all(r.n == (1 if r.doc_id == 99 else 4) for r in made)


def test_texts_that_units_do_not_make_up_stay_plain(spark):
    (row,) = infill.infilled(documents(spark, [(1, "abc1")]), unit="[a-z]").collect()
    assert (row.n, row.form, row.output) == (0, "plain", "abc1")


@pytest.mark.parametrize("unit", [infill.UNIT, r"\S+\s*|\s+"])
def test_ends_are_those_of_a_search(unit):
    pattern = infill.regex.compile(f"((?>{unit}))*+")
    for text in TEXTS:
        if text:
            assert infill.unit_ends(pattern, text) == [m.end() for m in re.finditer(unit, text)]
