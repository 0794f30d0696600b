"""Subword ids of whole texts by a public byte-level BPE, with a bounded cache of what stands between blanks.

Texts of common characters (ASCII, Latin letters, usual punctuation) are cut into the tokenizer's own pieces by one regular
expression over the whole text, and each distinct piece is merged once while it stays in the cache. Other texts are cut before
every blank that a non-blank follows, where the tokenizer cuts too, and their parts are split by it; texts with white space that
it would group otherwise are encoded in one piece. Ids are the tokenizer's own in every case.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable

import numpy as np

#: Entries a cache holds, twice: when the younger half is full, it takes the elder one's place (ids do not depend on it).
CACHE_ROWS = 300_000
LONGEST = 40
#: A blank after white space and before more of it, or before the end.
_GROUPED = re.compile(r"\s (?!\S)")


# Letters, digits and white space below U+0250, as Unicode has them, and what else counts as common.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\\t\\n\\x0b\\x0c\\r \x85\xa0"
_UNCOMMON = re.compile("[^\\t-\\r\\x20-\u024f\u2010-\u2027\u20ac]")
#: The pieces of byte-level vocabularies, for common characters.
PIECES = re.compile(rf"'(?:[sdmt]|ll|ve|re)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
#: On these the pieces are compared with the tokenizer's, once a worker; one that splits otherwise is asked every time.
_PROBES = ("It's  we'll\n\n a1 b22,c... 12é ñandú\t\tx  ", " \n x\xa0y \x85 ½x²3 “q”—z… 5€ 'S '", "\r\n\r\nA  B   c_d #$% ßß\u0130\u01c5")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: ASCII signs that stand in one piece after a word.
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class _Cache(dict):
    def __init__(self, make: Callable[[str], bytes], rows: int = CACHE_ROWS):
        super().__init__()
        self.make, self.rows, self.elder = make, rows, {}

    def __missing__(self, part: str) -> bytes:
        found = self.elder.get(part)
        if found is None:
            found = self.make(part)
        if len(part) <= LONGEST:
            if len(self) >= self.rows:
                self.elder = dict(self)
                self.clear()
            self[part] = found
        return found


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write for bytes: printable Latin-1 as it is, the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts; one for each vocabulary file, size of caches and Python worker."""

    _made: dict[tuple[str, int], Encoder] = {}

    def __init__(self, path: str, rows: int = CACHE_ROWS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.size = self.tokenizer.get_vocab_size()
        plain = self.tokenizer.normalizer is None and self.tokenizer.post_processor is None and isinstance(self.tokenizer.pre_tokenizer, ByteLevel)
        self.splits = self.tokenizer.pre_tokenizer.pre_tokenize_str if plain else None
        self.merge, self.letters = self.tokenizer.model.tokenize, _byte_letters()
        self.piece = _Cache(lambda piece: array("I", [t.id for t in self.merge(piece)]).tobytes(), rows)
        self.head, self.tail = _Cache(self.encode_part, rows), _Cache(self.encode_tail, rows)
        self.common = _Cache(self.encode_piece, rows)
        self.cut = PIECES.findall if self.splits is not None and all(self._agree(x) for x in _PROBES) else None

    @classmethod
    def of(cls, path: str, rows: int = CACHE_ROWS) -> Encoder:
        """The worker's encoder whose caches hold so many entries."""
        if (path, rows) not in cls._made:
            cls._made[path, rows] = cls(path, rows)
        return cls._made[path, rows]

    @classmethod
    def forget(cls) -> None:
        """Free what a worker keeps, where later tasks need no tokenizer."""
        cls._made.clear()

    def _agree(self, probe: str) -> bool:
        """Whether PIECES cuts a text where the tokenizer does."""
        return [probe[a:b] for _, (a, b) in self.splits(probe)] == PIECES.findall(probe)

    def encode_piece(self, piece: str) -> bytes:
        """Ids of one piece as it stands in the text."""
        written = piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.merge(written)]).tobytes()

    def encode_part(self, text: str) -> bytes:
        if self.splits is None:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join([self.piece[piece] for piece, _ in self.splits(text)])

    def encode_tail(self, part: str) -> bytes:
        """Ids of a blank and what follows it. Letters alone, or letters and then signs, are split without the tokenizer."""
        if self.cut is not None and not _UNCOMMON.search(part):
            return b"".join(map(self.common.__getitem__, self.cut(" " + part)))
        word = part.rstrip(SIGNS)
        if self.splits is None or not word.isalpha():
            return self.encode_part(" " + part)
        if not word.isascii():
            written = word.encode().decode("latin-1").translate(self.letters)
        else:
            written = word
        ids = self.piece[self.letters[32] + written]
        return ids if len(word) == len(part) else ids + self.piece[part[len(word) :]]

    def __call__(self, text: str | None) -> np.ndarray:
        """Ids as unsigned 32-bit integers; null is an empty text."""
        if not text:
            return np.zeros(0, "<u4")
        if self.cut is not None and not _UNCOMMON.search(text):
            return np.frombuffer(b"".join(map(self.common.__getitem__, self.cut(text))), "<u4")
        if self.splits is None or _GROUPED.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        parts = text.split(" ")
        return np.frombuffer(self.head[parts[0]] + b"".join(map(self.tail.__getitem__, parts[1:])), "<u4")
