"""Alignment of two tokenizers against whole-text encoding by the libraries and comparison of all token pairs."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import pytest
from helpers import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import alignment, queries

TEXTS = [
    None, "", " ", "a", "a b", " lead", "trail ", "two  blanks\n\nand\tmore   ", "<s> </s> <unk> <0x0A> <|endoftext|> x", "ünï cödé 🙂🙂 漢字かな",
    "has ▁ in it", "\x00zero", "ﬁne ligature", "12345678901234567890 0x1F", "  \n  ", "word " * 300, "word " * 300, "　wide", "x" * 5000,
]
LONG = "Tokenization of a rather long text, with números, Übergrößen and 漢字. " * 3000


@pytest.fixture(scope="module")
def paths():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def brute(paths):
    """Tokens of a text on both sides as (id, bytes), by the libraries on the whole text."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    first = Tokenizer.from_file(paths[0])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=paths[1])
    names = sorted(set(range(0x21, 0x7F)) | set(range(0xA1, 0xAD)) | set(range(0xAE, 0x100)))
    chars, extra = {chr(b): b for b in names}, 0
    for b in range(256):
        if b not in names:
            chars[chr(256 + extra)] = b
            extra += 1
    assert decoders.ByteLevel().decode([c for c in chars if chars[c] < 128]) == "".join(chr(v) for c, v in chars.items() if v < 128)

    def tokens(text):
        if not text:
            return [], []
        a = [(i, bytes(chars[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in second.encode(text):
            piece = second.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
        want = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else ([], [])

    return tokens


def ranges(tokens):
    out, at = [], 0
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def expected(rows, tokens):
    linked, counts = {}, Counter()
    for n, (_, text) in enumerate(rows):
        a, b = (ranges(t) for t in tokens(text))
        found, j0 = [], 0
        for x, s, e in a:
            while b[j0][2] <= s:
                j0 += 1
            j = j0
            while j < len(b) and b[j][1] < e:
                found.append((x, b[j][0]))
                j += 1
        linked[n] = a, b, found
        counts.update(set(found))
    best: dict = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for n, (name, _) in enumerate(rows):
        a, b, found = linked[n]
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        within = [{}, {}]
        for side, held in zip((a, b), within, strict=True):
            for i, _, e in side:
                held.setdefault(cuts[bisect_left(cuts, e)], []).append(str(i))
        groups = [",".join(within[0][cut]) + "|" + ",".join(within[1][cut]) for cut in cuts]
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((name, len(a), len(b), len(cuts), len(found), sum(counts[p] == best[p[0]] for p in found), sum(counts[p] for p in found), sha))
    return out


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def got(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("broadcast_pairs", [alignment.BROADCAST_PAIRS, 40, 0])
def test_against_all_token_pairs(spark, paths, brute, broadcast_pairs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (1, "twice"), (1, "twice"), (None, None)]
    rows += [(1000 + r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(25).collect()]
    met = alignment.aligned(documents(spark, rows).repartition(3), *paths)
    assert got(alignment.scored(met, alignment.pair_counts(met), broadcast_pairs)) == sorted(expected(rows, brute), key=repr)


def test_very_long_text(spark, paths, brute):
    rows = [(1, LONG), (2, "short")]
    met = alignment.aligned(documents(spark, rows), *paths)
    found = got(alignment.scored(met, alignment.pair_counts(met)))
    assert [r[1:5] for r in found] == [r[1:5] for r in expected([(1, LONG), (2, "short")], brute)]
    assert found[0][7] == expected([(1, LONG)], brute)[0][7]


def test_links_in_parts_are_those_of_the_whole(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(alignment, "PART_LINKS", 3)
    ids = pa.array([[1, 2, 8], [], [3], [4, 5, 6], [7]], pa.list_(pa.int32()))
    path = pa.array([[0, 1, 0], [], [2, 0], [0, 0, 0], [0]], pa.list_(pa.int8()))
    seconds = pa.array([[1, 2], [], [1, 2], [1, 2, 3], [9]], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([ids, seconds, path], ["a_ids", "b_ids", "path"])
    parts = list(alignment._parts(batch))
    assert len(parts) > 2 and sum(p.num_rows for p in parts) == 5
    assert np.concatenate([alignment.links(p).pairs for p in parts]).tolist() == alignment.links(batch).pairs.tolist()


def test_empty_table_and_other_columns(spark, paths):
    met = alignment.aligned(documents(spark, []), *paths)
    assert alignment.scored(met, alignment.pair_counts(met)).collect() == []
    docs = spark.createDataFrame([(1, "a b", "x", 5)], "doc_id long, text string, path string, row int")
    met = alignment.aligned(docs, *paths)
    assert [(r.n_a, r.n_groups) for r in alignment.scored(met, alignment.pair_counts(met)).collect()] == [(2, 2)]


def test_query_on_the_whole_table(spark, brute):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(queries.op11_alignment(spark, sf)) == sorted(expected(rows, brute), key=repr)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 80), st.data())
def test_path_against_overlaps(n, data):
    inner = st.lists(st.integers(1, n), unique=True)
    common = set(data.draw(inner))
    a, b = (sorted(common | set(data.draw(inner)) | {n}) for _ in range(2))
    path = alignment.path_of(a, b)
    links = []
    i = j = 0
    for step in path:
        links.append((i, j))
        i, j = i + (step != alignment.SECOND), j + (step != alignment.FIRST)
    starts = [0, *a], [0, *b]
    assert links == [(x, y) for x in range(len(a)) for y in range(len(b)) if max(starts[0][x], starts[1][y]) < min(a[x], b[y])]
    assert int(np.sum(path == alignment.BOTH)) == len(set(a) & set(b))
