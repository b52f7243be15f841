"""Token ids of the public tokenizer files through the tokenizers library, with words as the unit of work.

Neither vocabulary merges across white space, so a text's ids are the ids of its words in a row. A word that was met
before costs a look-up; a new one is split by the vocabulary's own pattern and merged by the library's model. Anything
unusual (characters outside ASCII and Latin-1 letters, special tokens, runs of white space) goes through the library's
whole encoder instead, so that the ids are the library's in every case.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import regex

# The split patterns that the two vocabulary files name.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CACHE_WORDS = 400_000
_USUAL = regex.compile(r"[\n !-~À-ÖØ-öø-ÿ]*")
_RUNS = re.compile(r"[\s\x1c-\x1f]{3}|[\s\x1c-\x1f]{2}$|\x00")
_MARKS = frozenset(".,!?;:|#%&*$")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: the byte's own Latin-1 character
    where it is printable, else the next free one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, free = {b: chr(b) for b in shown}, 0x100
    for value in range(256):
        if value not in letters:
            letters[value] = chr(free)
            free += 1
    return [letters[b] for b in range(256)]


class UnitEncoder:
    """Ids of whole texts as little-endian unsigned 16-bit bytes (both vocabularies have fewer than 65,536 ids)."""

    def __init__(self, path: str, spaced: bool):
        """spaced: the space before a word belongs to it (byte-level vocabulary); else white space is dropped and
        letters become lower case."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 65_536:
            raise ValueError("ids of this vocabulary do not fit 16 bits")
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.spaced = self.tokenizer.model, spaced
        self.pattern = regex.compile(BYTE_PATTERN if spaced else WORD_PATTERN)
        self.letters = dict(enumerate(byte_letters()))
        self.words = _Words(self)

    def encode(self, text: str) -> bytes:
        words = self.words
        if len(words) > CACHE_WORDS:
            words.turn()
        if not self.spaced:
            return b"".join([words[u] for u in text.encode().split()])
        # A word takes the space before it along, a line break stands alone. Only white space of three characters or
        # more, or of two at the end, would be cut differently; where every gap is one character there is none.
        plain = text.split()
        if (len(text) - sum(map(len, plain)) != len(plain) - 1 or "\0" in text) and _RUNS.search(text):
            return self._whole(text)
        return b"".join([words[u] for u in text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")])

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()

    def _unit(self, unit: str) -> bytes:
        space, word = ("\u0120", unit[1:]) if unit[:1] == " " else ("", unit)
        if not self.spaced:
            word = word.lower() if word.isascii() else word
        if word.isalpha():
            if word.isascii():
                return array("H", [t.id for t in self.model.tokenize(space + word)]).tobytes()
        elif word[-1:] in _MARKS and word[:-1].isalpha() and (word.isascii() or _USUAL.fullmatch(word)):
            # Letters and one mark: two pieces, and the word without the mark is worth remembering.
            mark = array("H", [t.id for t in self.model.tokenize(word[-1])]).tobytes()
            return self.words[unit[:-1] if self.spaced else word[:-1].encode()] + mark
        if not _USUAL.fullmatch(unit) or "<|" in unit:
            return self._whole(unit)
        ids = array("H")
        for piece in self.pattern.findall(unit if self.spaced else unit.lower()):
            ids.extend([t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))])
        return ids.tobytes()


class _Words(dict):
    """Ids by word; a word that is asked for the first time is encoded. Of a full cache, what is asked for again stays."""

    def __init__(self, encoder: UnitEncoder):
        super().__init__()
        self.encoder, self.older = encoder, {}

    def __missing__(self, unit: str | bytes) -> bytes:
        ids = self.older.get(unit)
        if ids is None:
            ids = self.encoder._unit(unit if isinstance(unit, str) else unit.decode())
        self[unit] = ids
        return ids

    def turn(self) -> None:
        self.older = dict(self)
        self.clear()


_READY: dict = {}


def unit_encoder(path: str, spaced: bool) -> UnitEncoder:
    """One encoder per worker process and vocabulary; its word cache outlives a task."""
    if (path, spaced) not in _READY:
        _READY[path, spaced] = UnitEncoder(path, spaced)
    return _READY[path, spaced]
