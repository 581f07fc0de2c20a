from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import flatfiles, planes
from tidemark.llm.queries import byte_bpe
from tidemark.llm.tokens import Encoder, encoder

TEXTS = [
    "", None, " ", "   ", "a", " a  b", "a \n b\n c", "foo\n bar  baz\t x", "it's we're 12 3", "x<|endoftext|>y <|endoftext|>", " trail ",
    "é  è\r\n\r\n z", "\x85 a b", "à la à", "𝕏 y", "wide　 space", "word " * 5000,
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_bpe())


def _ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab Z9'!\n\t\r é\x85\xa0　<|endoftext>", max_size=30), max_size=6))
def test_pieces_give_what_the_library_gives(library, texts):
    got = encoder(byte_bpe()).encode(pa.array([*texts, *TEXTS], pa.string()))
    for i, text in enumerate([*texts, *TEXTS]):
        assert got.ids[got.offsets[i] : got.offsets[i + 1]].tolist() == _ids(library, text)


def test_forgetting_and_other_rules(library, monkeypatch):
    monkeypatch.setattr("tidemark.llm.tokens.CACHE_PIECES", 1)
    small = Encoder(byte_bpe())
    for _ in range(3):
        got = small.encode(pa.array(["one two three", "four five"]))
        assert got.ids.tolist() == _ids(library, "one two three") + _ids(library, "four five")
    monkeypatch.setattr(small, "_cut", False)
    assert small.encode(pa.array(["one two", None])).counts.tolist() == [len(_ids(library, "one two")), 0]


def test_known_pieces_are_few_bytes_and_come_in_small_batches(library, monkeypatch):
    import gc
    import tracemalloc

    words = [f" w{i * 7919 % 100_003}x" for i in range(60_000)]
    texts = pa.array(["".join(words[i : i + 1000]) for i in range(0, len(words), 1000)] + ["".join(words[::-7])])
    small, most = Encoder(byte_bpe()), 0

    class Counting:
        def encode_batch_fast(self, given, **how):
            nonlocal most
            most = max(most, len(given))
            return library.encode_batch_fast(given, **how)

    monkeypatch.setattr(small, "_tokenizer", Counting())
    Encoder(byte_bpe()).encode(texts)  # what all encoders share
    tracemalloc.start()
    got = small.encode(texts)
    same = small.encode(texts)
    want = [i for t in texts.to_pylist() for i in _ids(library, t)]
    assert got.ids.tolist() == want and same.ids.tolist() == want
    del got, same, want
    gc.collect()
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert most <= 4096 and held < 80 * len(words)


def _counting(library, given):
    class Counting:
        def encode_batch_fast(self, texts, **how):
            given.append(len(texts))
            return library.encode_batch_fast(texts, **how)

    return Counting()


def test_new_pieces_go_to_the_library_many_in_one_text(library, monkeypatch):
    some, given = Encoder(byte_bpe()), []
    monkeypatch.setattr(some, "_tokenizer", _counting(library, given))
    texts = [" ".join(f"w{i}é, x{i}ß" for i in range(a, a + 100)) for a in range(0, 1000, 100)] + ["ends white\n", "\xa0 b", " "]
    got = some.encode(pa.array(texts))
    assert got.ids.tolist() == [i for t in texts for i in _ids(library, t)]
    assert sum(given) < 40 and len(some._hashes) > 2000  # letters that end in a byte of white space are no white space


def test_pieces_beside_white_space_and_letters_like_it(library):
    white = [*map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])]
    like = ["à", "é", "ß", "Р", "р", "ࠀ", "老", "䀀", "\u1fa0", "\u200b", "\u205e", "\u16a0", "𐀀", "𝂠"]
    texts = [t for c in [*white, *like] for d in ("b", c, *white[:3]) for t in (f"a{c} {d}", f"{c} {d}{c}", f" {c}{d} c {c}", f"{d}{c}  {c} c")]
    some = Encoder(byte_bpe())
    for _ in range(2):
        got = some.encode(pa.array(texts))
        for i, text in enumerate(texts):
            assert got.ids[got.offsets[i] : got.offsets[i + 1]].tolist() == _ids(library, text)


@pytest.mark.parametrize("added", ["one two", "wo", " two", None])
def test_tokens_of_other_bytes_than_the_pieces(tmp_path, added):
    """A vocabulary without some bytes, and added tokens that would be found in texts put together of pieces."""
    from tokenizers import AddedToken, Tokenizer, models, pre_tokenizers

    letters = {c: i for i, c in enumerate("Ġonetwx")}
    small = Tokenizer(models.BPE({**letters, "on": 7}, [("o", "n")]))
    small.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    if added:
        small.add_tokens([AddedToken(added, lstrip=True, rstrip=True)])
    small.save(str(tmp_path / "small.json"))
    texts = ["x one", "x two", "one", "two one", "zz one zz", "one\n two", "wz two x", "", "zz", "x one two"]
    got = Encoder(str(tmp_path / "small.json")).encode(pa.array(texts))
    assert [got.ids[a:b].tolist() for a, b in zip(got.offsets, got.offsets[1:], strict=False)] == [_ids(small, t) for t in texts]


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_planes_are_undone(bits, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n).astype("<u4")
    made = planes.to_planes(ids, bits)
    assert len(made) == (32 if bits else 4)
    assert (planes.from_planes(made, n) == ids).all()


@pytest.mark.parametrize(("bits", "block"), [(False, 1 << 16), (True, 5)])
def test_plane_files_give_the_documents_back(spark, library, bits, block):
    rows = [(3 * i - 5, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (4, "twice"), (4, "twice")]
    manifest = planes.write(documents(spark, rows), byte_bpe(), end_id=2, bits=bits, block_ids=block)
    got = sorted(tuple(r) for r in planes.read(manifest).select("start", "n_tokens", "ids_crc32", "doc_id").collect())
    want, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*_ids(library, text), 2], "<u4")
        want.append((start, len(ids), zlib.crc32(ids), doc))
        start += len(ids)
    assert got == want
    reader = planes.PlaneReader(manifest.first().address)
    assert all(len(reader.block(i)) == c[1] for i, c in enumerate(reader.footer["chunks"]))


def test_no_documents_no_files(spark):
    assert planes.read(planes.write(documents(spark, []), byte_bpe())).collect() == []
    written = flatfiles.write(documents(spark, []), byte_bpe(), 50256)
    assert flatfiles.scan(written.select("address", "size"), 50256).collect() == []


@pytest.mark.parametrize("block_bytes", [2, 6, 1 << 20])
def test_scan_stitches_blocks(spark, tmp_path, block_bytes, monkeypatch):
    monkeypatch.setattr(flatfiles, "_GROUP", 3)
    rng = np.random.default_rng(block_bytes)
    files, want = [], []
    for f, last in enumerate((9, 1, 9, 9)):
        ids = np.concatenate((np.where(rng.random(f * 25) < 0.2, 9, 1), [last] * (f > 0))).astype("<u2")
        path = tmp_path / f"{f}.ids"
        path.write_bytes(ids.tobytes())
        files.append((path.as_uri(), len(ids) * 2))
        start, ordinal = 0, 0
        for i, value in enumerate(ids.tolist()):
            if value == 9:
                want.append((path.as_uri(), ordinal, start, i - start))
                start, ordinal = i + 1, ordinal + 1
        if start < len(ids):
            want.append((path.as_uri(), ordinal, start, len(ids) - start))
    got = flatfiles.scan(spark.createDataFrame(files, "address string, size long"), 9, block_bytes=block_bytes)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_flat_counts_by_document(spark, library):
    rows = [(i, t) for i, t in enumerate(TEXTS) if not t or "<|" not in t] + [(None, "no id"), (3, "again")]
    written = flatfiles.write(documents(spark, rows), byte_bpe(), 50256)
    got = flatfiles.named(flatfiles.scan(written.select("address", "size"), 50256, block_bytes=64), written)
    assert sorted(((r.doc_id, r.n_tokens) for r in got.collect()), key=repr) == sorted(((i, len(_ids(library, t))) for i, t in rows), key=repr)
    with pytest.raises(OverflowError):
        flatfiles.write(documents(spark, rows), byte_bpe(), 70_000)


def test_tasks_give_freed_memory_back_and_keep_their_rows(monkeypatch):
    import pyarrow as pa

    from tidemark.llm import tables

    seen = []
    library = type("Library", (), {"malloc_trim": staticmethod(lambda pad: seen.append(("trim", pad)))})
    monkeypatch.setattr(tables.ctypes, "CDLL", lambda name: library)

    def task(batches):
        for batch in batches:
            seen.append(batch.num_rows)
            yield batch

    batches = [pa.RecordBatch.from_pydict({"doc_id": list(range(n))}) for n in (2, 0, 3)]
    assert list(tables.lean(task)(iter(batches))) == batches
    assert seen == [2, 0, 3, ("trim", 0)]


def test_batches_of_few_rows_hold_for_frames_that_run_later(spark):
    from tidemark.llm import tables

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    try:
        spark.conf.set(name, "5000")
        frame = spark.range(0, 4000, 1, 1).mapInArrow(sizes, "n long")
        tables.few_rows(spark)
        assert max(r.n for r in frame.collect()) == 1000
        spark.conf.set(name, "200")
        tables.few_rows(spark)
        assert spark.conf.get(name) == "200"
    finally:
        spark.conf.set(name, before)
