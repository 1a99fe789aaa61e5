"""Byte-level pre-tokens and the memory of what each encodes to.

The pattern of the byte-level vocabularies cuts a text into pre-tokens that are
encoded independently of each other. A single space between two other characters
always begins a pre-token, and a single line feed there is one of its own, so most
texts can be cut at spaces and looked up piece by piece. A text with any other
white space takes the pattern itself.
"""

from __future__ import annotations

import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex

# The pattern of the vocabularies, with white space spelled as the Unicode property
# (Python's own \s also takes four control characters).
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
_split = regex.compile(PATTERN).findall
_odd_space = regex.compile(r"\p{White_Space}").search

_SPACE, _FEED = 32, 10

# Bytes of texts whose pieces are looked up together: in more of them, fewer pieces are new.
BYTES_AT_ONCE = 8 << 20
# Longer pre-tokens are not remembered: they hardly ever come twice.
LONGEST_KEPT = 64
# One of these after letters is a pre-token of its own.
STOPS = tuple(".,;:!?")


class _OddSpacing(Exception):
    """A piece that only the whole pattern can cut."""


class _Memory(dict):
    """Looks up a key and computes it when it is new.

    When it is full, its content becomes the older half; of that, what is asked for
    again moves over, and the rest is forgotten when the newer half is full too.
    """

    def __init__(self, compute: Callable[[str], bytes], size: int):
        super().__init__()
        self._compute, self._size = compute, size
        self._older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        value = self._older.get(key)
        if value is None:
            value = self._compute(key)
            if len(key) > LONGEST_KEPT:
                return value
        if len(self) >= self._size:
            self._older = dict(self)
            self.clear()
        self[key] = value
        return value


class TextEncoder:
    """Texts to token ids as little-endian unsigned 32-bit integers.

    ``encode_pretoken`` maps one pre-token to its ids. Up to twice ``size`` pieces
    are remembered.
    """

    def __init__(self, encode_pretoken: Callable[[str], list[int]], size: int = 400_000):
        self._encode_pretoken = encode_pretoken
        self._pretokens = _Memory(self._ids, size // 4)
        self._pieces = _Memory(lambda piece: self._piece(" ", piece, self._pieces), size)
        self._heads = _Memory(lambda piece: self._piece("", piece, self._heads), size // 8)
        self._feed = self._ids("\n")

    def _ids(self, pretoken: str) -> bytes:
        ids = self._encode_pretoken(pretoken)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, before: str, piece: str, alike: _Memory) -> bytes:
        """Ids of a run of characters without a space that follows ``before``."""
        if piece.isalpha():  # letters are one pre-token
            return self._ids(before + piece)
        if piece[-1:] in STOPS and piece[:-1].isalpha():
            return alike[piece[:-1]] + self._pretokens[piece[-1]]
        if not piece or _odd_space(piece):
            raise _OddSpacing  # also where white space meets white space
        return b"".join(map(self._pretokens.__getitem__, _split(before + piece)))

    def encode(self, text: str | None) -> bytes:
        return self.encode_all(pa.array([text], pa.large_string()))[0]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text. Each distinct piece of all of them is looked up once."""
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        held = texts.buffers()[2]
        raw = np.frombuffer(held, dtype=np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
        if not len(raw):
            return [b""] * len(texts)
        offsets = offsets - offsets[0]
        # A piece begins at a space, a line feed or a text, and holds it.
        begins = (raw == _SPACE) | (raw == _FEED)
        begins[offsets[:-1][offsets[:-1] < len(raw)]] = True
        bounds = np.append(np.flatnonzero(begins), len(raw))
        pieces = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(raw)).dictionary_encode()
        ids = [self._found(piece) for piece in pieces.dictionary.to_pylist()]
        first = np.searchsorted(bounds, offsets)
        found = pa.array(ids, pa.large_binary()).take(pieces.indices)
        places = np.frombuffer(found.buffers()[1], dtype=np.int64)[first].tolist()
        data = found.buffers()[2]
        data = memoryview(data) if data is not None else memoryview(b"")
        whole = [bytes(data[a:b]) for a, b in zip(places, places[1:])]
        if found.null_count:
            odd = np.flatnonzero(found.is_null().to_numpy(zero_copy_only=False))
            for at in np.unique(np.searchsorted(first, odd, side="right") - 1).tolist():
                whole[at] = b"".join(map(self._pretokens.__getitem__, _split(texts[at].as_py())))
        return whole

    def _found(self, piece: str) -> bytes | None:
        """Ids of a piece with the space or line feed it begins with; None where only the whole pattern can cut."""
        try:
            if piece[0] == " ":
                return self._pieces[piece[1:]]
            if piece[0] == "\n":
                return self._feed + self._heads[piece[1:]]
            return self._heads[piece]
        except _OddSpacing:
            return None
