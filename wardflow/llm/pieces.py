"""What the byte-level encoders share: their split of texts, and a memory of encoded pieces."""

from __future__ import annotations

import re
from collections.abc import Callable

import regex

#: The split of byte-level BPE; fixed value.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_BYTE_LEVEL = regex.compile(BYTE_LEVEL)

#: The letters and the white space among the characters of Latin texts, spelled out: `re` looks one set up in a table.
_LETTERS = "A-Za-z\xAA\xB5\xBA\xC0-\xD6\xD8-\xF6\xF8-\u024F"
_BLANKS = "\x09-\x0D\x20\x85\xA0"
#: The same split of Latin texts by Python's quicker `re`.
_QUICK = re.compile(
    f" ?[{_LETTERS}]++|'(?:[stmd]|re|ve|ll)| ?[0-9]++| ?[^{_LETTERS}0-9{_BLANKS}]++|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
)
#: A character outside those, Latin and its punctuation, of which both say the same.
_OTHER = re.compile("[^\x00-\x1B\x20-\xB1\xB4-\xB8\xBA\xBB\xBF-\u024F\u2010-\u2027\u2030-\u205E]")

#: Pieces in one generation of a worker's memory.
GENERATION = 300_000


def split_byte_level(text: str) -> list[str]:
    """All matches of BYTE_LEVEL; texts in Latin letters take the quicker way."""
    return (_BYTE_LEVEL if _OTHER.search(text) else _QUICK).findall(text)


class PieceEncoder:
    """Packed ids of whole texts: each match of a pattern is encoded by itself, by `encode`.

    Encoded pieces are remembered in two generations: what is used again survives, the rest goes after a
    while.
    """

    def __init__(self, split: str, encode: Callable[[list[str]], list[bytes]], size: int = GENERATION) -> None:
        self.split, self.encode, self.size = regex.compile(split), encode, size
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        """All ids of the text."""
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}
        found = self.split.findall(text)
        missing = set(found).difference(self.young)
        if missing:
            new = []
            for piece in missing:
                if piece in self.old:
                    self.young[piece] = self.old[piece]
                else:
                    new.append(piece)
            self.young.update(zip(new, self.encode(new), strict=True))
        return b"".join(map(self.young.__getitem__, found))


class _Memory(dict[str, bytes]):
    """Encoded pieces. A missing one is taken from the generation before, or encoded."""

    def __init__(self, encode: Callable[[str], bytes], before: dict[str, bytes]) -> None:
        super().__init__()
        self.encode, self.before = encode, before

    def __missing__(self, piece: str) -> bytes:
        found = self.before.get(piece)
        if found is None:
            found = self.encode(piece)
        self[piece] = found
        return found


class SinglePieceEncoder:
    """As `PieceEncoder`, for an `encode` that is quick for one piece: what is missing is encoded as it is met.

    `split` gives the pieces of a text.
    """

    def __init__(
        self, split: Callable[[str], list[str]], encode: Callable[[str], bytes], size: int = GENERATION
    ) -> None:
        self.split, self.encode, self.size = split, encode, size
        self.young = _Memory(encode, {})

    def ids(self, text: str) -> bytes:
        """All ids of the text."""
        if len(self.young) > self.size:
            self.young.before = {}
            self.young = _Memory(self.encode, self.young)
        return b"".join(map(self.young.__getitem__, self.split(text)))
