"""Token ids of whole texts, every distinct piece of a task encoded once.

Texts are cut before a single space that follows another sign and precedes an ASCII sign or a
Latin-1 letter. No token of the vocabularies below crosses such a place, so the ids of a
text are those of its pieces one after another; what does not fit these conditions stays in
one piece and is encoded whole. Pieces are told apart by their bytes. Tokenizers are loaded
from a file whose path is a parameter, once per worker.
"""

from __future__ import annotations

import functools
import json
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex

from inspectstar.llm.words import Slice, slices

#: Text bytes handled at once, and what a worker remembers between slices: distinct parts of
#: pieces, and distinct pieces.
SLICE_BYTES = 4_000_000
REMEMBERED_PARTS = 600_000
REMEMBERED_PIECES = 300_000

_OPENS = np.zeros(256, dtype=bool)  # bytes after a space that starts a piece
_OPENS[0x21:0x7F] = True
_OPENS[0xC3] = True

# How byte-level vocabularies cut a text.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_SPLIT = regex.compile(SPLIT)
_LATIN = re.compile(rb"(?:[\n\x20-\x7e]|\xc3[\x80-\xbf])*")
_LETTERS = rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+"
#: A word and the marks after it: two parts for ``_SPLIT``.
_WORD = re.compile(rb"(" + _LETTERS + rb")([!-&(-/:-@\[-`{-~]*)")


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def byte_signs() -> list[str]:
    """The sign that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 signs stand for themselves, other bytes for the signs from 256 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class ByteLevel:
    """A byte-level BPE file of the ``tokenizers`` library, without added special tokens.

    ``special``: whether the strings of special tokens inside a text count as these tokens.
    """

    def __init__(self, path: str, special: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        cut, added = form["pre_tokenizer"] or {}, form["added_tokens"]
        self.by_piece = (
            form["normalizer"] is None
            and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut["add_prefix_space"]
            and not any(x["lstrip"] or x["rstrip"] or " " in x["content"] for x in added)
        )
        strings = [re.escape(x["content"].encode()) for x in added] if special else []
        self.added = re.compile(b"|".join(strings)) if strings else None
        self.signs = {b: ord(s) for b, s in enumerate(byte_signs())}
        self.known: dict[bytes, bytes] = {}

    @property
    def size(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _whole(self, pieces: list[bytes]) -> list[bytes]:
        texts = [p.decode("utf-8") for p in pieces]
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [_packed(x.ids) for x in found]

    def _part(self, part: bytes) -> bytes:
        ids = self.known.get(part)
        if ids is None:
            shown = part.decode("latin-1").translate(self.signs)
            ids = self.known[part] = _packed([t.id for t in self.tokenizer.model.tokenize(shown)])
        return ids

    def ids(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as 32-bit numbers. Forgetting costs time, never a result."""
        if not self.by_piece:
            return self._whole(pieces)
        if len(self.known) > REMEMBERED_PARTS:
            self.known = {}
        out, rest = [], []
        for i, piece in enumerate(pieces):
            word = _WORD.fullmatch(piece)
            if word and not (self.added and self.added.search(piece)):
                letters, marks = word.groups()
                out.append(self._part(letters) + self._part(marks) if marks else self._part(letters))
            elif _LATIN.fullmatch(piece) and not (self.added and self.added.search(piece)):
                parts = _SPLIT.findall(piece.decode("utf-8"))
                out.append(b"".join([self._part(p.encode()) for p in parts]))
            else:
                rest.append(i)
                out.append(b"")
        for i, ids in zip(rest, self._whole([pieces[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def token_bytes(self) -> list[bytes]:
        """The bytes of each id."""
        back = {s: b for b, s in enumerate(byte_signs())}
        out = [b""] * self.size
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            known = all(s in back for s in token)
            out[i] = bytes(back[s] for s in token) if known else token.encode()
        return out


class Pieces:
    """A ``sentencepiece`` model that puts a space before a text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.size)]
        self.by_piece = not any("▁" in name.lstrip("▁") for name in names)
        self.known: dict[bytes, bytes] = {}

    @property
    def size(self) -> int:
        return self.model.get_piece_size()

    def ids(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as 32-bit numbers; it begins with the space that the model
        adds by itself. Forgetting costs time, never a result."""
        if len(self.known) > REMEMBERED_PIECES:
            self.known = {}
        fresh = [p for p in pieces if p not in self.known]
        found = self.model.encode([p[1:].decode("utf-8") for p in fresh], num_threads=1)
        self.known.update(zip(fresh, map(_packed, found), strict=True))
        return [self.known[p] for p in pieces]

    def token_bytes(self) -> list[bytes]:
        out = []
        for i in range(self.size):
            name = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                out.append(bytes([int(name[3:-1], 16)]))
            else:
                out.append(name.replace("▁", " ").encode())
        return out


@functools.lru_cache(maxsize=4)
def byte_level(path: str, special: bool) -> ByteLevel:
    return ByteLevel(path, special)


@functools.lru_cache(maxsize=4)
def sentence_pieces(path: str) -> Pieces:
    return Pieces(path)


def cut(data: np.ndarray, bounds: np.ndarray, by_piece: bool) -> np.ndarray:
    """Where the pieces of the texts ``bounds`` of ``data`` begin; empty texts have none."""
    begins = np.zeros(len(data), dtype=bool)
    if by_piece and len(data) > 2:
        space = data == 0x20
        begins[1:-1] = space[1:-1] & ~space[:-2] & _OPENS[data[2:]]
        # What opens a piece must lie in the same text.
        ends = bounds[1:-1] - 1
        begins[ends[(ends >= 0) & (ends < len(data))]] = False
    first = bounds[:-1]
    begins[first[first < bounds[1:]]] = True
    return np.flatnonzero(begins)


@dataclass
class Ids:
    """The ids of the texts of a slice, text i from ``offset[i]`` to ``offset[i + 1]``."""

    piece: Slice
    ids: np.ndarray
    offset: np.ndarray


class PieceTable:
    """The pieces of a slice, each distinct one once."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, by_piece: bool):
        start = cut(data, bounds, by_piece)
        self.first = np.searchsorted(start, bounds)
        places = np.append(start, len(data)).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(start), [None, pa.py_buffer(places), pa.py_buffer(data)]
        ).dictionary_encode()
        self.distinct = pieces.dictionary.to_pylist()
        self.index = pieces.indices.to_numpy()

    def distinct_ids(self, encoder: ByteLevel | Pieces) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the distinct pieces one after another, how many each has)."""
        found = encoder.ids(self.distinct)
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        return np.frombuffer(b"".join(found), dtype=np.uint32), size

    def spread(self, flat: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the texts, offset by text), given those of the distinct pieces."""
        base = np.cumsum(size) - size
        count = size[self.index]
        ends = np.concatenate([[0], np.cumsum(count)])
        at = np.arange(ends[-1]) + np.repeat(base[self.index] - ends[:-1], count)
        return flat[at], ends[self.first]


def encoded(texts: pa.Array | pa.ChunkedArray, encoder: ByteLevel | Pieces) -> Iterator[Ids]:
    """The ids of ``texts``, slice by slice; null counts as empty."""
    for piece in slices(texts, SLICE_BYTES):
        table = PieceTable(piece.data, piece.bounds, encoder.by_piece)
        yield Ids(piece, *table.spread(*table.distinct_ids(encoder)))
