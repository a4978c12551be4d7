"""Token ids of whole texts by a public ``tokenizers`` vocabulary, encoded word by word and remembered.

The vocabulary drops white space and never joins across it, so the ids of a text are the ids of its
words in order. Words repeat, so each one is encoded once by the library and kept in a bounded table.
The strings of its special tokens hold no white space; in a text they become these tokens, as the library has it.
"""

from __future__ import annotations

import os
import re

import numpy as np

#: Words remembered by one Python worker; the table starts anew when it is full.
REMEMBERED_WORDS = 700_000
_LONGEST_REMEMBERED = 64
# Lower-case letters of the Latin-1 range in UTF-8, then marks: two units of the vocabulary's own splitting.
_LETTERS_THEN_MARKS = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([.,:;!?()]*)")


def _byte_letters() -> dict[int, int]:
    """Byte-level BPE spells bytes as letters: printable Latin-1 as it is, the others from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: 256 + i for i, b in enumerate(others)}


_LETTERS = _byte_letters()
_encoders: dict[str, "WordIds"] = {}


class WordIds(dict):
    """Word (UTF-8 bytes) to its ids as little-endian unsigned integers of ``width`` bytes."""

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self.width = 2 if self._tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.dtype("<u2" if self.width == 2 else "<u4")
        self._packed = [i.to_bytes(self.width, "little") for i in range(self._tokenizer.get_vocab_size())]

    def _encode(self, word: bytes) -> bytes:
        ids = self._tokenizer.encode(word.decode(), add_special_tokens=False).ids
        return np.array(ids, self.kind).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        parts = _LETTERS_THEN_MARKS.fullmatch(word)
        if parts is None or len(word) > _LONGEST_REMEMBERED:
            ids = self._encode(word)
        elif parts[2]:
            ids = self[parts[1]] + self[parts[2]]
        else:  # letters alone are one unit, which the model takes without the steps before it
            spelled = word.decode() if word.isascii() else word.decode("latin-1").translate(_LETTERS)
            ids = b"".join([self._packed[t.id] for t in self._model.tokenize(spelled)])
        if len(word) <= _LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def of_text(self, text: bytes) -> bytes:
        # The vocabulary lower-cases; doing so here, where the text has one lower-case form only, lets more
        # words be found again. Special tokens are found before that, as they are written.
        if b"<|" in text:
            pass
        elif text.isascii():
            text = text.lower()
        else:
            try:
                text = text.decode().encode("latin-1").decode("latin-1").lower().encode()
            except UnicodeEncodeError:
                pass
        return b"".join(map(self.__getitem__, text.split()))


def encoder(path: str) -> WordIds:
    """The worker's encoder of a vocabulary file, made on first use."""
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def as_u32(ids: bytes, width: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if width == 2 else "<u4").astype("<u4")
