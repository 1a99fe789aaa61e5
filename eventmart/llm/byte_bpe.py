"""Whole texts through the tokenizers library, one vocabulary per Python worker."""

from __future__ import annotations

import os
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from eventmart.llm.pretokens import TextEncoder

VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the vocabulary file lies on this machine; executors ask for themselves."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> str:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the rest for characters from 256 upwards.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return "".join(chr(b if b in printable else next(rest)) for b in range(256))


@lru_cache(maxsize=2)
def text_encoder(path: str) -> TextEncoder:
    """Encodes with the library's own model, pre-token by pre-token.

    Special tokens' strings inside a text count as ordinary text.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path).model
    letters = dict(enumerate(byte_letters()))
    tokenize = model.tokenize

    def encode_pretoken(pretoken: str) -> list[int]:
        mapped = pretoken.encode("utf-8").decode("latin-1").translate(letters)
        return [token.id for token in tokenize(mapped)]

    return TextEncoder(encode_pretoken)


class DocumentEncoder:
    """Whole texts as the library encodes them, with the vocabulary's added tokens.

    A text that holds the string of an added token goes through the library as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._plain = text_encoder(path).encode_all
        self._library = Tokenizer.from_file(path)
        added = [token.content for token in self._library.get_added_tokens_decoder().values()]
        self._added = "|".join(map(re.escape, added)) if added else None

    def encode(self, text: str | None) -> bytes:
        return self.encode_all(pa.array([text], pa.large_string()))[0]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        found = self._plain(texts)
        if self._added:
            marked = pc.fill_null(pc.match_substring_regex(texts, self._added), False)
            for at in np.flatnonzero(marked.to_numpy(zero_copy_only=False)).tolist():
                ids = self._library.encode(texts[at].as_py(), add_special_tokens=False).ids
                found[at] = struct.pack(f"<{len(ids)}I", *ids)
        return found


@lru_cache(maxsize=2)
def document_encoder(path: str) -> DocumentEncoder:
    return DocumentEncoder(path)


@lru_cache(maxsize=2)
def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
