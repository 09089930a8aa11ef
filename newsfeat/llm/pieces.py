"""Token ids of whole texts from a tokenizer file, through a table of pieces already encoded.

Texts repeat their words, so a text is cut where the tokenizer is known to cut as well, each
distinct piece is encoded once by the tokenizers library, and the ids are joined. A text
with anything unusual around its cuts is encoded whole.
"""

from __future__ import annotations

import os
import re
import unicodedata

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: A generation of the table holds this many pieces of some 0.16 KB; two are kept, so a worker's table stays under 0.12 GB.
GENERATION = 350_000
#: Longer pieces are not kept.
LONGEST_PIECE = 64
#: White space that only some pattern engines call so, and special tokens' beginning.
ODD_ASCII = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")
ODD = (*ODD_ASCII, "\u180e", "\u200b", "\u2060", "\ufeff")
#: White space beside a space: the cut before a word is not certain there.
WIDE_GAP = re.compile(r"\A | \s|\s | \Z")
#: The usual ones, found by plain search; other white space is rare and asks for the pattern.
GAPS = ("  ", " \n", "\n ", " \t", "\t ", " \r", "\r ", " \v", "\v ", " \f", "\f ")
RARE_SPACES = [c for c in map(chr, range(0x80, 0x3001)) if c.isspace()]
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_encoders: dict = {}


def _byte_letters() -> dict[int, str]:
    """Byte-level tokenizers write printable bytes as themselves, the others as letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def odd(text: str) -> bool:
    return any(mark in text for mark in (ODD_ASCII if text.isascii() else ODD))


def wide_gap(text: str) -> bool:
    if text[:1] == " " or text[-1:] == " " or any(gap in text for gap in GAPS):
        return True
    return not text.isascii() and any(c in text for c in RARE_SPACES) and WIDE_GAP.search(text) is not None


class _Pieces(dict):
    """piece -> ids as bytes; a missing piece is encoded and kept, the older generation goes when both are full."""

    def __init__(self, encode):
        self.encode, self.old = encode, {}

    def __missing__(self, piece: str) -> bytes:
        out = self.old.get(piece)
        if out is None:
            out = self.encode(piece)
        if len(piece) <= LONGEST_PIECE:
            if len(self) >= GENERATION:
                self.old = dict(self)
                self.clear()
            self[piece] = out
        return out


class PieceEncoder:
    """ids(text) for tokenizers whose words are independent.

    spaced=True: byte-level tokenizers whose words carry the one space before them.
    spaced=False: tokenizers that drop white space and lower-case.
    """

    def __init__(self, path: str, spaced: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.spaced, self.model = spaced, self.tokenizer.model
        self.letters = _byte_letters()
        self.pieces, self.tails, self.cells = _Pieces(self._encode_piece), {}, {}
        self.line_end = self.whole("\n").tobytes() if spaced else b""

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _cell(self, number: int) -> bytes:
        """The bytes of an id; as many are kept as the vocabulary has tokens."""
        if number not in self.cells:
            self.cells[number] = number.to_bytes(4, "little")
        return self.cells[number]

    def _tail(self, marks: str) -> bytes:
        if marks not in self.tails:
            if len(self.tails) >= 10_000:
                self.tails.clear()
            self.tails[marks] = self.whole(marks).tobytes()
        return self.tails[marks]

    def _encode_piece(self, word: str) -> bytes:
        """A word of letters is one unit of the model; the marks after it are another unit.

        With spaced=True a word carries the space before it, but for one that begins with a line feed: that one
        stands for the word after it, without any space, as words at the beginning of a line or text do.
        """
        if word.isalpha():
            return self._unit(word, self.spaced)
        core = word.rstrip(MARKS)
        if core and core.isalpha():
            return self.pieces[core] + self._tail(word[len(core):])
        if not self.spaced:
            return self.whole(word).tobytes()
        bare, lines = word.startswith("\n"), word.split("\n")
        if bare:
            lines = lines[1:]
            word = word[1:]
        if len(lines) > 1 and lines == word.split():
            first = self.pieces["\n" + lines[0]] if bare else self.pieces[lines[0]]
            return self.line_end.join([first, *(self.pieces["\n" + line] for line in lines[1:])])
        if bare:
            core = word.rstrip(MARKS)
            if core and core.isalpha():
                return self._unit(core, False) + (self._tail(word[len(core):]) if len(core) < len(word) else b"")
            return self.whole(word).tobytes()
        return self.whole(" " + word).tobytes()

    def _unit(self, word: str, space: bool) -> bytes:
        letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return b"".join([self._cell(u.id) for u in self.model.tokenize("\u0120" + letters if space else letters)])

    def ids(self, text: str) -> np.ndarray:
        """uint32 ids of a whole text."""
        if odd(text):
            return self.whole(text)
        get = self.pieces.__getitem__
        if not self.spaced:
            if "\u03a3" not in text and "\u0130" not in text and unicodedata.is_normalized("NFC", text):
                return np.frombuffer(b"".join(map(get, text.lower().split())), "<u4")
            return self.whole(text)
        if not text or text[0].isspace() or wide_gap(text):
            return self.whole(text)
        return np.frombuffer(b"".join(map(get, ("\n" + text).split(" "))), "<u4")


def encoder(path: str, spaced: bool) -> PieceEncoder:
    """The worker's encoder for a file; kept between tasks."""
    if (path, spaced) not in _encoders:
        _encoders[path, spaced] = PieceEncoder(path, spaced)
    return _encoders[path, spaced]
