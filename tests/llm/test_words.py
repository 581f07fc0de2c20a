from __future__ import annotations

import pyarrow as pa
from helpers import alphanumeric, shingle_set, spaced
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import words as W

TEXT = st.text(alphabet="aAbBzZé ß\t\n-0\x1f\x85　", max_size=40)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_hashes_stand_for_words(texts):
    for table, split in ((W.SPACED, spaced), (W.ALPHANUMERIC, alphanumeric)):
        found = W.hashed_words(pa.array(texts, pa.string()), table)
        names: dict[str, int] = {}
        for i, text in enumerate(texts):
            hashes = found.hashes[found.offsets[i] : found.offsets[i + 1]]
            assert len(hashes) == len(split(text))
            for word, value in zip(split(text), hashes.tolist()):
                assert names.setdefault(word, value) == value
        assert len(set(names.values())) == len(names)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_shingles_of_each_text(texts):
    found = W.shingles(W.hashed_words(pa.array(texts, pa.string()), W.SPACED))
    for i, text in enumerate(texts):
        assert len(set(found.hashes[found.offsets[i] : found.offsets[i + 1]].tolist())) == len(shingle_set(text))


def test_cutting_does_not_matter(monkeypatch):
    texts = pa.array([" ".join(f"word{i}" for i in range(500)), "x" * 5000, "a b"])
    whole = W.hashed_words(texts, W.SPACED).hashes
    monkeypatch.setattr(W, "SEGMENT_BYTES", 64)
    assert (W.hashed_words(texts, W.SPACED).hashes == whole).all()
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    assert [part.num_rows for part in W.slices(batch, "text", 6000)] == [1, 2]
    assert sum(p.num_rows for p in W.slices(batch, "text", 1)) == 3
