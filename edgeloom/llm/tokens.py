"""Token ids of whole texts from a public byte-level BPE vocabulary, by the ``tokenizers`` library.

The vocabulary's pattern never lets a token cross from a non-space character into a single space or newline that
another non-space character follows.  So a text whose only white space is such single characters is encoded piece
by piece, and the library sees each piece once per worker (a bounded cache).  Any other text, and one that holds an
added token's string, goes to the library whole.  Both ways give the same ids; ``tests/llm/test_operators.py`` compares them.
"""

from __future__ import annotations

import functools
import re
from array import array

import numpy as np

#: Pieces in each of the two generations of a worker's cache, about 200 bytes each.
CACHE_PIECES = 350_000
_L = "A-Za-zÀ-ÖØ-öø-ɏ"
_LETTERS = re.compile(f"[{_L}]+")
#: Letters and then signs: the pattern always parts these.
_WORD_SIGNS = re.compile(f"([{_L}]+)([!-/:-@\\[-`{{-~]+)")


#: White space other than the space and the newline, up to U+00FF and beyond.
_SPACES = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
_WIDE_SPACES = re.compile("[\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in for each byte in byte-level vocabularies: itself, or the next unused code point from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Generations(dict):
    """A bounded cache: when it is full it becomes the old generation, from which what is used again comes back."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class PieceEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, as the library gives them by default: added tokens' strings are those tokens."""

    def __init__(self, tokenizer_path: str, cache_pieces: int = CACHE_PIECES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.tokenize = self.tokenizer.model.tokenize
        self.table = _byte_letters()
        self.space = self.table[32]
        self.newline = self.whole("\n")
        self.spaced, self.bare = _Generations(self._spaced, cache_pieces), _Generations(self._bare, cache_pieces // 4)

    def _spaced(self, piece: str) -> bytes:
        """Ids of a piece after a space, or of one that begins with a newline."""
        if piece[0] == "\n":
            return self.newline + self.bare[piece[1:]]
        if _LETTERS.fullmatch(piece):
            return self.word(self.space, piece)
        parts = _WORD_SIGNS.fullmatch(piece)
        return self.spaced[parts[1]] + self.bare[parts[2]] if parts else self.whole(" " + piece)

    def _bare(self, piece: str) -> bytes:
        """Ids of a piece at the start of a text or line, or of signs after letters."""
        if _LETTERS.fullmatch(piece):
            return self.word("", piece)
        parts = _WORD_SIGNS.fullmatch(piece)
        return self.bare[parts[1]] + self.bare[parts[2]] if parts else self.whole(piece)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def word(self, before: str, letters: str) -> bytes:
        """A run of letters, which the pattern keeps together, straight to the library's merges."""
        spelled = letters if letters.isascii() else letters.encode("utf-8").decode("latin-1").translate(self.table)
        return array("I", [t.id for t in self.tokenize(before + spelled)]).tobytes()

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.added and self.added.search(text):  # the library cuts a text at added tokens first
            return self.whole(text)
        pieces = text.replace("\n", " \n").split(" ")
        first = pieces[0]
        # no white space but the single spaces and newlines between the pieces, and none at either end
        if "" in pieces or "\n" in pieces or first[0] == "\n" or any(c in text for c in _SPACES) or not text.isascii() and _WIDE_SPACES.search(text):
            return self.whole(text)
        return self.bare[first] + b"".join(map(self.spaced.__getitem__, pieces[1:]))


@functools.lru_cache(maxsize=2)
def encoder(tokenizer_path: str) -> PieceEncoder:
    """One encoder for each worker process and vocabulary."""
    return PieceEncoder(tokenizer_path)


def as_ids(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<u4")
