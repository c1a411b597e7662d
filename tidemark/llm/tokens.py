"""Token ids of whole texts by a tokenizer file, with ids of repeated pieces remembered.

Encoding is exact: a text is cut only where the tokenizer cuts too, so the ids of the
pieces put together are the ids of the text. Two kinds of file are known: byte-level
files, where white space belongs to the ids, and files that drop white space.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterable, Iterator

_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
_SIGN = r"!-&(-/:-@\[-`{-~"


def _words(space: str) -> str:
    """Letters up to a character that cannot belong to them; signs up to a letter or white space; any other word."""
    return rf"{space}[{_LETTER}]++(?![^\x00-\x7f])|{space}[{_SIGN}]++(?=[\s{_LETTER}]|\Z)|{space}\S+"


#: With white space: one space goes with the next word, the rest up to it is a piece.
_SPACED = re.compile(_words(" ?") + r"|\s+(?!\S)|\s+")
_UNSPACED = re.compile(_words(""))
_PLAIN_WORD = re.compile(f" ?[{_LETTER}]+").fullmatch
#: White space other than space and line feed, and letters whose lower case depends on or runs into their neighbours.
_ODD = re.compile("[\\t\\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000Σİ]")


def _byte_signs() -> dict[int, str]:
    """Byte-level files write a byte as itself where it is printable, the others as signs from 256 on, in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    signs = [chr(byte if byte in printable else next(others)) for byte in range(256)]
    return {code: "".join(signs[byte] for byte in chr(code).encode()) for code in [0x20, *range(0xC0, 0x250)]}


_BYTE_SIGNS = _byte_signs()
_CUT = re.compile(r"(?<=\S) (?=\S)")
_SEGMENT = 1 << 20


def default_path(name: str) -> str:
    """Where the installed vocabulary package keeps a file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _segments(text: str) -> Iterator[str]:
    """Stretches of a very long text, cut before single spaces between words."""
    start = 0
    while len(text) - start > _SEGMENT:
        found = _CUT.search(text, start + _SEGMENT)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


class _Known(dict):
    """Remembers what ``learn`` gives for a key, but for keys with ``passing`` in them, which hardly come again. ``age``
    keeps what was asked for since the last call and one turn longer."""

    def __init__(self, learn, passing: str = ""):
        super().__init__()
        self._learn, self._older, self._passing = learn, {}, passing

    def __missing__(self, key):
        if self._passing and self._passing in key:
            return self._learn(key)
        value = self._older.get(key)
        if value is None:
            value = self._learn(key)
        self[key] = value
        return value

    def age(self):
        self._older = dict(self)
        self.clear()


class PieceEncoder:
    """Ids as little-endian unsigned integers of ``width`` bytes; about twice ``remembered`` words are kept at most.

    With 2 bytes an id over 65535 is an error.
    """

    def __init__(self, path: str, width: int = 4, remembered: int = 400_000):
        self._kind = {2: "H", 4: "I"}[width]
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._keeps_space = bool(self._direct(" a \n b") != self._direct("a b"))
        self._marks = [token.content for token in self._tokenizer.get_added_tokens_decoder().values()]
        self._model = self._tokenizer.model.tokenize
        self._cut = (_SPACED if self._keeps_space else _UNSPACED).findall
        self._pieces = _Known(self._piece)
        self._words = _Known(self._word, "\n" if self._keeps_space else "")
        self._firsts = _Known(self._joined)
        self._line_end = self._direct("\n")
        self._remembered = remembered

    def _direct(self, text: str) -> bytes:
        return self._raw(self._tokenizer.encode(text, add_special_tokens=False).ids)

    def _raw(self, ids: list[int]) -> bytes:
        raw = array(self._kind, ids)
        if sys.byteorder == "big":
            raw.byteswap()
        return raw.tobytes()

    def _merged(self, word: str) -> bytes:
        """A plain word goes straight to the file's merges, since nothing else would change or cut it."""
        signs = word.replace(" ", _BYTE_SIGNS[0x20]) if word.isascii() else word.translate(_BYTE_SIGNS)
        return self._raw([token.id for token in self._model(signs)])

    def _piece(self, piece: str) -> bytes:
        if not _PLAIN_WORD(piece):
            return self._direct(piece)
        return self._merged(piece if self._keeps_space else piece.lower())

    def _joined(self, text: str) -> bytes:
        return b"".join(map(self._pieces.__getitem__, self._cut(text)))

    def _word(self, word: str) -> bytes:
        """A word without white space at its ends, after one space: often letters, or letters and a sign.

        Between two words a single line feed is a piece of its own.
        """
        if self._keeps_space and "\n" in word and "\n\n" not in word:
            before, *after = word.split("\n")
            if before and after[-1]:
                return self._line_end.join([self._words[before], *map(self._firsts.__getitem__, after)])
        if _PLAIN_WORD(word):
            return self._merged(" " + word if self._keeps_space else word.lower())
        if word[-1] in ".,;:!?" and _PLAIN_WORD(word[:-1]):
            return self._words[word[:-1]] + self._pieces[word[-1]]
        return self._joined(" " + word if self._keeps_space else word)

    def _plain(self, text: str) -> bytes:
        """A text without odd characters. Words between single spaces are looked up whole."""
        if not self._keeps_space:
            return b"".join(map(self._words.__getitem__, text.split()))
        if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " ":
            return self._joined(text)
        first, *words = text.split(" ")
        return self._joined(first) + b"".join(map(self._words.__getitem__, words))

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, in order."""
        for text in texts:
            for known in (self._words, self._pieces, self._firsts):
                if len(known) > self._remembered:
                    known.age()
            if any(mark in text for mark in self._marks) or _ODD.search(text):
                yield self._direct(text)
            elif len(text) > _SEGMENT:
                yield b"".join(map(self._plain, _segments(text)))
            else:
                yield self._plain(text)


_ENCODERS: dict[tuple[str, int], PieceEncoder] = {}


def encoder(path: str, width: int = 4) -> PieceEncoder:
    """One encoder per file and worker process."""
    if (path, width) not in _ENCODERS:
        _ENCODERS[path, width] = PieceEncoder(path, width)
    return _ENCODERS[path, width]
