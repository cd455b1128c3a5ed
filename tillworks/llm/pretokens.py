"""Splitting texts as the two public vocabularies do, fast where that is certain to agree.

The split patterns of a vocabulary name Unicode classes, and tools differ in the Unicode version
they know. Within the code points of ``COMMON`` the classes are settled, normalisation changes
nothing and lower case is letter by letter; texts made of these only (and without the text of a
special token) are split here with a plain regular expression. Any other text goes to the
tokenizers library as a whole, so results are always the library's.
"""

from __future__ import annotations

import re
import unicodedata
from functools import wraps

#: Latin letters, their punctuation, and common dashes and quotation marks.
_COMMON = [*range(0x00, 0x130), *range(0x131, 0x234), *range(0x2010, 0x2028)]
UNCOMMON = re.compile(r"[^\x00-įı-ȳ‐-‧]|<\|")


def _class(start: str) -> str:
    found = [c for c in map(chr, _COMMON) if unicodedata.category(c).startswith(start)]
    return "".join(map(re.escape, found))


_LETTERS, _NUMBERS, _SPACE = _class("L"), _class("N"), "\\x09-\\x0d\\x20\\x85\\xa0"
_CUTS = "'s|'t|'re|'ve|'m|'ll|'d"

#: Byte-level pieces: a word, number or run of signs, each with the space before it.
BYTE_PIECES = re.compile(
    f"{_CUTS}| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_SPACE}{_LETTERS}{_NUMBERS}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
#: Words of lower-case text without white space; every digit stands alone.
WORD_PIECES = re.compile(f"{_CUTS}|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACE}{_LETTERS}{_NUMBERS}]+")


def common(text: str) -> bool:
    return UNCOMMON.search(text) is None


class Memo(dict):
    """What has been worked out for a piece, for twice ``most`` pieces at most: when it is full, the
    pieces not used since it was last full are forgotten. Pieces over ``longest`` aren't remembered."""

    def __init__(self, make, most: int, longest: int | None = None) -> None:
        super().__init__()
        self.make, self.most, self.longest, self.older = make, most, longest, {}

    def __missing__(self, piece):
        if self.longest is not None and len(piece) > self.longest:
            return self.make(piece)
        value = self.older.get(piece)
        if value is None:
            value = self.make(piece)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[piece] = value
        return value

    def forget(self) -> None:
        self.older = {}
        self.clear()


def forgets(*memos: Memo):
    """For the work of a task: what it has remembered goes with it, so a worker that is used for other
    work next doesn't carry it along."""

    def wrap(work):
        @wraps(work)
        def run(*args, **named):
            try:
                yield from work(*args, **named)
            finally:
                for memo in memos:
                    memo.forget()

        return run

    return wrap


def _byte_letters() -> dict[int, str]:
    """The visible letter that stands for each byte in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the others in turn for the code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()


LETTER_BYTES = {letter: b for b, letter in BYTE_LETTERS.items()}


def from_byte_letters(letters: str) -> str | None:
    """The text that the letters stand for; None if they are no whole characters."""
    try:
        return bytes(map(LETTER_BYTES.__getitem__, letters)).decode()
    except (KeyError, UnicodeDecodeError):
        return None


def in_byte_letters(piece: str) -> str:
    word = piece[1:] if piece[:1] == " " else piece
    if word.isascii() and word.isalnum():
        return piece if word is piece else BYTE_LETTERS[0x20] + word
    return piece.encode().decode("latin-1").translate(BYTE_LETTERS)
