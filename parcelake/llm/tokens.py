"""Whole texts to token ids with the public tokenizers, fast through a cache of words.

Both vocabularies cut a text into letters, digits, other signs and white space before they merge
bytes, and no piece crosses such a cut. So a text may be cut there, each different piece encoded
once by the tokenizers library, and the ids put together again: the same ids as for the whole text.

A text of ASCII and Latin-1 letters without odd spacing is cut at every end of letters. Any other
text is cut only at blanks that a printable ASCII character follows (or at white space, if the
vocabulary drops it), which holds for every script.

A text that may hold the name of a special token, such as <|endoftext|>, is given to the library
whole: it looks for those names before it cuts, and takes each as one id.

Ids are little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable

CACHE_PIECES = 300_000      # a worker's cache holds at most this many pieces
CACHED_LENGTH = 64          # longer pieces are encoded each time

_LATIN = rb"A-Za-z\x80-\xbf\xc3"        # bytes of the letters of a regular text
_REGULAR = bytes([9, 10, 13, *range(32, 127), *range(0x80, 0xC0), 0xC3])
_CONTRACTION = re.compile(rb"'[" + _LATIN + rb"]")
_LETTERS_OR_REST = {"byte": re.compile(rb" ?[" + _LATIN + rb"]+| ?[^ " + _LATIN + rb"]+| "),
                    "word": re.compile(rb"[" + _LATIN + rb"]+|[^ " + _LATIN + rb"]+")}
_ODD_SPACES = (b"  ", b" \n", b"\n ", b"\n\n", b"\t", b"\r")
_SURE_CUT = re.compile(rb"(?= [!-~])")
_LETTERS = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
# The characters by which a "byte" vocabulary names bytes: printable ones of Latin-1 name themselves, the
# others have those from 256 on, in their order.
_UNPRINTED = [*range(33), *range(127, 161), 173]
_NAMES = {b: chr(256 + n) for n, b in enumerate(_UNPRINTED)}


class Cache(dict):
    """Ids of pieces in two generations of at most `half` pieces: a full one becomes the old one, and a
    piece that is found there moves on, so common pieces stay. An unknown piece is encoded by `encode`."""

    def __init__(self, encode: Callable[[bytes], bytes]):
        super().__init__()
        self.encode, self.half = encode, 0
        self.old: dict[bytes, bytes] = {}

    def __missing__(self, piece: bytes) -> bytes:
        found = self.old.pop(piece, None)
        if found is None:
            found = self.encode(piece)
            if len(piece) > CACHED_LENGTH:
                return found
        if len(self) >= self.half:
            self.old = dict(self) if len(self) <= self.half else {}
            self.clear()
        self[piece] = found
        return found


class Encoder:
    """Encoder of one vocabulary file. `kind` says how the file treats blanks: "word" drops white
    space and marks ends of words, "byte" glues a blank to what follows it."""

    def __init__(self, path: str, kind: str, pieces: int | None = None):
        """`pieces`: how many the cache may hold (default: CACHE_PIECES)."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # how a special name begins, in either case, so that no text is folded to look for it
        self.marks = {m for name in added if name for m in (name[:2], name[:2].lower(), name[:2].upper())}
        self.kind, self.most = kind, pieces
        self.tokenize = self.tokenizer.model.tokenize
        self.cache = Cache(self.encode_piece)

    def regular(self, text: bytes) -> bool:
        """Whether the text may be cut at every end of letters."""
        if text.translate(None, _REGULAR) or b"\xc3\x97" in text or b"\xc3\xb7" in text:
            return False
        if b"'" in text and _CONTRACTION.search(text):
            return False
        return self.kind == "word" or not any(s in text for s in _ODD_SPACES)

    def pieces(self, text: bytes) -> list[bytes]:
        if any(mark in text for mark in self.marks):
            return [text]
        if self.regular(text):
            return _LETTERS_OR_REST[self.kind].findall(text.lower() if self.kind == "word" else text)
        return text.split() if self.kind == "word" else _SURE_CUT.split(text)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of every text. A text's pieces are looked up as soon as it is cut, while they are at hand."""
        self.cache.half = (self.most or CACHE_PIECES) // 2
        known = self.cache.__getitem__
        return [b"".join(map(known, self.pieces(text))) for text in texts]

    def encode_piece(self, piece: bytes) -> bytes:
        """Ids of a piece. One of letters needs no cutting any more and goes to the library's model."""
        if self.kind == "byte" and piece[:1] == b" " and piece[1:].isalpha():      # ASCII, the common case
            name = _NAMES[32] + piece[1:].decode()
        elif _LETTERS.fullmatch(piece):
            if self.kind == "word":
                piece = piece.decode().lower().encode()
            name = piece.decode("latin-1").translate(_NAMES)
        else:
            return self.plain([piece])[0]
        return array("I", [token.id for token in self.tokenize(name)]).tobytes()

    def plain(self, texts: list[bytes]) -> list[bytes]:
        """Ids by the library alone."""
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, kind: str, pieces: int | None = None) -> Encoder:
    """The encoder of this worker."""
    if (path, kind, pieces) not in _encoders:
        _encoders[path, kind, pieces] = Encoder(path, kind, pieces)
    return _encoders[path, kind, pieces]


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)
