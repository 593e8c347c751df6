"""Token ids of whole texts with the public word-level BPE vocabulary.

The vocabulary's pre-tokenizer drops white space and never joins characters
across it, so a text's ids are its white-space words' ids put together. Words
repeat, so every Python worker keeps a bounded memory of words already encoded;
only new words reach the tokenizer.
"""

from __future__ import annotations

import re
import struct

DOCUMENT_END = 1
MEMORY_ENTRIES = 400_000

# FIXED VALUES: the pre-tokenizer pattern of the vocabulary file.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_plain_word = re.compile("[\x21-\x7e\xa1-\xac\xae-\xff]+").fullmatch
_odd_space = re.compile("[\x1c-\x1f]").search


def _byte_symbols() -> list[str]:
    """The printable stand-in character of each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class _Memory(dict):
    """Known keys and their ids; ``make`` supplies new ones. Bounded: a full memory
    starts anew."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        ids = self.make(key)
        if len(self) >= MEMORY_ENTRIES:
            self.clear()
        self[key] = ids
        return ids


class WordEncoder:
    """``encode(text)`` -> the ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.pieces = regex.compile(PIECES).findall
        self.symbols = _byte_symbols()
        self.by_word = _Memory(self._word)
        self.by_piece = _Memory(self._piece)

    def _piece(self, piece: str) -> bytes:
        # a piece holds no space or control character: ASCII ones stand for themselves
        mapped = piece if piece.isascii() else "".join([self.symbols[b] for b in piece.encode("utf-8")])
        tokens = self.model.tokenize(mapped)
        if len(tokens) == 1:
            return tokens[0].id.to_bytes(4, "little")
        return b"".join([t.id.to_bytes(4, "little") for t in tokens])

    def _word(self, word: str) -> bytes:
        if _plain_word(word) and "<|" not in word:
            lower, known = word.lower(), self.by_piece
            if lower.isalpha():  # one piece
                return known[lower]
            if lower[:-1].isalpha() and "!" <= lower[-1] <= "/":  # and a mark behind it
                return known[lower[:-1]] + known[lower[-1]]
            return b"".join(map(known.__getitem__, self.pieces(lower)))
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _odd_space(text):  # str.split() would drop these, the tokenizer keeps them
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(map(self.by_word.__getitem__, text.split()))


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a vocabulary file (kept between tasks)."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
