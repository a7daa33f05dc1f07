"""Whole texts to token ids with the ``tokenizers`` library, each distinct piece of text encoded once.

Both vocabularies cut a text into pre-tokens before they merge bytes, and both
always cut it before a single space that is followed by a visible character.
So a text is split there, pieces met before are looked up, and only new ones
are encoded. The word vocabulary drops all blanks, so its texts of the plain
characters below are cut into their pre-tokens at once, and other texts line by
line or by piece. The ids are those of the whole text encoded at once: a special
token's string in a text is that token, and stands between two texts of its own.
"""

from __future__ import annotations

import re
import struct

from tagloom.llm.common import LETTERS, vocabulary

# Entries of one generation of a cache; a cache holds two at most.
CACHE_ENTRIES = 250_000

# Pieces of these characters only are cut into pre-tokens here; all others go through the whole library pipeline.
_SIMPLE = re.compile(rf" ?[{LETTERS}0-9\n!-/:-@\[-`{{-~]*\Z")
# Most pieces: a word, perhaps with a mark behind it. Each is one pre-token in both vocabularies.
_WORD = re.compile(rf"( ?)([{LETTERS}]+)([,.;:!?]?)\Z")
_ODD_SPACE = re.compile(r" (?:\s|\Z)")
_CUT = re.compile(r"(?= \S)")

# The contractions and classes both vocabularies split by, for the simple characters above.
_SPACED_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")
_BARE_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+")
# The same as the last for lower case, but all characters other than the simple ones go to the last class.
_BARE_RUNS = re.compile(rf"[{LETTERS}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^ \n{LETTERS}0-9]+")


class NotSimple(Exception):
    """A pre-token has characters that only the whole library pipeline deals with."""


class Generations(dict):
    """A dictionary that makes missing values and forgets the entries not asked for lately."""

    def __init__(self, make, limit: int = CACHE_ENTRIES):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class TokenIds:
    """Token ids of whole texts, as little-endian unsigned 32-bit integers."""

    def __init__(self, name: str, limit: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary(name))
        self.special = {t.content: struct.pack("<I", i) for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.model = self.tokenizer.model
        self.lowers = self.tokenizer.normalizer is not None  # the word vocabulary: lower case, no spaces kept
        self.letters = byte_letters()
        self.pretokens = Generations(self._pretoken, limit)
        self.runs = Generations(self._run, limit)
        self.pieces = Generations(self.piece, limit)
        self.spaced = Generations(lambda piece: self.piece(" " + piece), limit)

    def whole(self, text: str) -> bytes:
        """The library's own result, without any cache."""
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _pretoken(self, word: str) -> bytes:
        plain = self.lowers and word.isascii()  # each byte stands for itself
        ids = [t.id for t in self.model.tokenize(word if plain else word.encode().decode("latin-1").translate(self.letters))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _run(self, run: str) -> bytes:
        if not _SIMPLE.match(run):
            raise NotSimple
        return self._pretoken(run)

    def piece(self, piece: str) -> bytes:
        """Ids of a piece without blanks but for a first one."""
        found = _WORD.match(piece)
        if found:
            space, word, mark = found.groups()
            ids = self.pretokens[word.lower() if self.lowers else space + word]
            return ids + self.pretokens[mark] if mark else ids
        if not _SIMPLE.match(piece):
            return self.whole(piece)
        words = _BARE_WORDS.findall(piece.lower()) if self.lowers else _SPACED_WORDS.findall(piece)
        return b"".join(map(self.pretokens.__getitem__, words))

    def __call__(self, text: str) -> bytes:
        if any(mark in text for mark in self.special):
            return b"".join(self.special.get(part) or self.plain(part) for part in self.marks.split(text))
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        if self.lowers:
            return self.bare(text)
        if _ODD_SPACE.search(text):
            return b"".join(map(self.pieces.__getitem__, _CUT.split(text)))
        first, *rest = text.split(" ")
        return self.pieces[first] + b"".join(map(self.spaced.__getitem__, rest))

    def bare(self, text: str) -> bytes:
        """The same for the word vocabulary, where spaces and line ends only part pre-tokens."""
        try:
            return b"".join(map(self.runs.__getitem__, _BARE_RUNS.findall(text.lower())))
        except NotSimple:
            lines = text.split("\n")
            return b"".join(map(self.bare, lines) if len(lines) > 1 else map(self.pieces.__getitem__, text.split(" ")))


_ENCODERS: dict[str, TokenIds] = {}


def token_ids(name: str) -> TokenIds:
    """The encoder of a vocabulary; a Python worker makes it once."""
    if name not in _ENCODERS:
        _ENCODERS[name] = TokenIds(name)
    return _ENCODERS[name]


END_ID = 1
END = struct.pack("<I", END_ID)
