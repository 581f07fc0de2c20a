"""Token ids of whole texts through the tokenizers library, with an exact cache of what words become."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from tidemark.llm.words import BYTE_VALUE, run_hashes, text_bytes, text_ends

#: Pieces kept; beyond that the cache starts anew.
CACHE_PIECES = 1_000_000
#: Pieces that the library encodes at a time; what it returns takes far more memory than their ids.
LEARN_PIECES = 4096


def _may_end_white_space() -> np.ndarray:
    """Bytes that white space may end in: ASCII white space, and last bytes of wider white space."""
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
    table[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
    return table


_WHITE = _may_end_white_space()
_BEFORE = np.zeros(256, bool)  # bytes before the last one of wider white space
_BEFORE[[0x80, 0x81, 0x9A, 0xC2]] = True


def _after_white(data: np.ndarray) -> np.ndarray:
    """For each byte but the first, whether white space may end before it; a letter with such a last byte is none."""
    white = _WHITE[data[:-1]]
    white[1:] &= (data[1:-1] < 0x80) | _BEFORE[data[:-2]]
    return white


@dataclass(frozen=True)
class Ids:
    """Token ids of several texts; those of text i are ``ids[offsets[i]:offsets[i + 1]]``."""

    ids: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def ended(self, end_id: int) -> Ids:
        """With ``end_id`` behind each text."""
        n = len(self.offsets) - 1
        out = np.empty(len(self.ids) + n, self.ids.dtype)
        ends = self.offsets[1:] + np.arange(n)
        inner = np.ones(len(out), bool)
        inner[ends] = False
        out[ends], out[inner] = end_id, self.ids
        return Ids(out, self.offsets + np.arange(n + 1))


def _joined(parts: list[np.ndarray]) -> Ids:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
    return Ids(np.concatenate([np.zeros(0, np.uint32), *parts]).astype(np.uint32), offsets)


class Encoder:
    """Ids as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    The byte-level rule without prefix blank never joins what stands before a blank with the blank, unless white space
    stands before it. So a text is cut in front of such blanks, every distinct piece (known by a 64-bit hash of its
    bytes) is encoded once by the library, many pieces in one text, and the ids are put together. Texts with a special
    token, and all texts under any other rule, go to the library whole.
    """

    def __init__(self, path: str, special_as_text: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = special_as_text
        added = self._tokenizer.get_added_tokens_decoder().values()
        self._special = [] if special_as_text else [t.content.encode() for t in added]
        self._cut = self._by_pieces()
        self._sizes = self._token_bytes() if self._cut else np.zeros(0, np.int64)
        self._forget()

    def _token_bytes(self) -> np.ndarray:
        """Bytes of each token by its id: a character of a byte-level token is a byte, added tokens are plain text."""
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        sizes = np.full(max(vocabulary.values(), default=-1) + 1, 1 << 40, np.int64)
        for token, i in vocabulary.items():
            sizes[i] = len(token) or 1 << 40
        for i, token in self._tokenizer.get_added_tokens_decoder().items():
            sizes[i] = len(token.content.encode())
        return sizes

    def _by_pieces(self) -> bool:
        rules = json.loads(self._tokenizer.to_str())
        pre = rules.get("pre_tokenizer") or {}
        plain = not any(rules.get(k) for k in ("normalizer", "truncation", "padding"))
        return plain and pre.get("type") == "ByteLevel" and pre.get("use_regex") is True and pre.get("add_prefix_space") is False

    def _forget(self) -> None:
        self._hashes = np.zeros(0, np.uint64)  # of the pieces known, in order
        self._starts, self._lengths = np.zeros(0, np.int64), np.zeros(0, np.int32)  # of their ids in the pool
        self._pool, self._used = np.zeros(4096, np.uint32), 0

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one piece after another, and how many each has.

        Pieces are put together to texts that would be cut into them again, and their tokens dealt to them by their bytes.
        Where the tokens have other bytes than the pieces, each piece is encoded by itself.
        """
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        starts = ends[:-1]
        cuts = starts[(data[starts] != 0x20) | _after_white(data)[starts - 1]].tolist()
        joined = data.tobytes()
        ids, _ = self._flat([joined[a:b].decode() for a, b in zip([0, *cuts], [*cuts, len(joined)], strict=True)])
        reached = np.cumsum(self._sizes[ids])
        place = np.searchsorted(reached, ends)
        if len(ids) and reached[-1] == ends[-1] and (reached[place] == ends).all():
            return ids, np.diff(place, prepend=-1)
        return self._flat([p.decode() for p in pieces])

    def _flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one text after another, and how many each has."""
        lists = [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.uint32, counts.sum()), counts

    def _learn(self, hashes: np.ndarray, data: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        """Encode the pieces from ``first`` to ``last``, both included; ``hashes`` are in order, and none is known yet."""
        starts, lengths = np.empty(len(hashes), np.int64), np.empty(len(hashes), np.int32)
        buffer = data.tobytes()
        for i in range(0, len(hashes), LEARN_PIECES):
            these = slice(i, i + LEARN_PIECES)
            pieces = [buffer[a : b + 1] for a, b in zip(first[these].tolist(), last[these].tolist(), strict=True)]
            ids, counts = self._encoded(pieces)
            if self._used + len(ids) > len(self._pool):
                self._pool = np.concatenate((self._pool[: self._used], np.empty(len(ids) + self._used // 4, np.uint32)))
            starts[these], lengths[these] = self._used + np.cumsum(counts) - counts, counts
            self._pool[self._used : self._used + len(ids)] = ids
            self._used += len(ids)
        place = np.searchsorted(self._hashes, hashes)
        self._hashes, self._starts = np.insert(self._hashes, place, hashes), np.insert(self._starts, place, starts)
        self._lengths = np.insert(self._lengths, place, lengths)

    def _known(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self._hashes):
            return np.zeros(len(hashes), bool)
        return self._hashes[np.minimum(np.searchsorted(self._hashes, hashes), len(self._hashes) - 1)] == hashes

    def encode(self, texts: pa.Array) -> Ids:
        """The ids of each text; null is encoded as the empty text."""
        if not self._cut:
            return _joined(self._library([t or "" for t in texts.to_pylist()]))
        data = text_bytes(texts)
        buffer = data.tobytes() if self._special else b""
        if any(s in buffer for s in self._special):
            return self._apart(texts.to_pylist())
        return self._pieced(data, np.concatenate(([0], text_ends(texts))))

    def _apart(self, texts: list[str | None]) -> Ids:
        """Texts with special tokens by themselves, the others in pieces."""
        special = [s.decode() for s in self._special]
        whole = [any(s in t for s in special) if t else False for t in texts]
        rest = pa.array([None if w else t for w, t in zip(whole, texts, strict=True)], pa.large_string())
        cut = self._pieced(text_bytes(rest), np.concatenate(([0], text_ends(rest))))
        parts = [cut.ids[a:b] for a, b in zip(cut.offsets, cut.offsets[1:], strict=False)]
        at = [i for i, w in enumerate(whole) if w]
        for i, ids in zip(at, self._library([texts[i] for i in at]), strict=True):
            parts[i] = ids
        return _joined(parts)

    def _pieced(self, data: np.ndarray, bounds: np.ndarray) -> Ids:
        if not len(data):
            return Ids(np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64))
        starts = data == 0x20
        starts[1:] &= ~_after_white(data)
        starts[bounds[:-1][bounds[:-1] < len(data)]] = True
        first = np.flatnonzero(starts)
        last = np.append(first[1:], len(data)) - 1
        distinct, example, inverse = np.unique(run_hashes(data, first, last, BYTE_VALUE), return_index=True, return_inverse=True)
        if len(self._hashes) > CACHE_PIECES:
            self._forget()
        new = np.flatnonzero(~self._known(distinct))
        if len(new):
            self._learn(distinct[new], data, first[example[new]], last[example[new]])
        slot = np.searchsorted(self._hashes, distinct)[inverse]
        lengths = self._lengths[slot].astype(np.int64)
        ends = np.cumsum(lengths)
        ids = self._pool[np.repeat(self._starts[slot] - (ends - lengths), lengths) + np.arange(ends[-1])]
        before = np.concatenate(([0], ends))
        return Ids(ids, before[np.searchsorted(first, bounds)])


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """One encoder for a Python worker, kept from task to task."""
    key = (path, special_as_text)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, special_as_text)
    return _ENCODERS[key]
