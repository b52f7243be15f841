"""BPE encoding and decoding without a tokenizer library: contiguous rank arrays.

A short word is a row of part ids next to a row of ranks, one for each pair of adjacent parts. Again and again the
smallest rank of the row is found, the boundary it stands on is deleted (the row closes up), and the ranks on both
sides are looked up anew; a row is done when no pair of it can merge. Numpy does this for many words of like length at
once. Words longer than `LONG` parts, where scanning would be quadratic, keep their pairs in a heap instead.

Cases: a null text reads as empty and has no ids; texts of white space only have none either; repeated rows give
repeated results; the text of a special token is that token. Only `doc_id` and `text` are read, so other columns may
have any name. No row leaves its partition: there is no shuffle.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemill.llm.bpe_units import CACHE_WORDS, WORD_PATTERN, byte_letters
from tidemill.llm.common import documents_of, slices

LONG = 128
NO_RANK = np.int32(2**31 - 1)
_PIECES = regex.compile(WORD_PATTERN.replace(r"\s", r"\t-\r \x85\xa0  -     　"))
_SPACES = regex.compile(r"[\t-\r \x85\xa0  -     　]+")


class PairTable:
    """(left id, right id) -> (rank, merged id): an open hash table in arrays, looked up for many pairs at once."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(len(left)).bit_length() + 2)
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.rank = np.full(1 << self.bits, NO_RANK, dtype=np.int32)
        self.merged = np.zeros(1 << self.bits, dtype=np.int32)
        keys = (left.astype(np.int64) << 32) | right
        open_rows = np.arange(len(keys))
        slot = self._slot(keys)
        while len(open_rows):
            free = self.keys[slot] == -1
            first = np.unique(slot[free], return_index=True)[1]
            taken = np.flatnonzero(free)[first]
            self.keys[slot[taken]] = keys[open_rows[taken]]
            self.rank[slot[taken]] = open_rows[taken]
            self.merged[slot[taken]] = merged[open_rows[taken]]
            rest = np.ones(len(open_rows), dtype=bool)
            rest[taken] = False
            open_rows, slot = open_rows[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair; `rank` there is NO_RANK for a pair that never merges."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        slot = self._slot(keys)
        open_rows = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] != -1))
        while len(open_rows):
            slot[open_rows] = (slot[open_rows] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[open_rows]]
            open_rows = open_rows[(there != keys[open_rows]) & (there != -1)]
        return slot


class RankEncoder:
    """Encoder and decoder of a vocabulary file with word ends (lower case, white space dropped)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        vocabulary, merges = stored["model"]["vocab"], stored["model"]["merges"]
        self.end = stored["model"]["end_of_word_suffix"] or ""
        added = {t["content"]: t["id"] for t in stored["added_tokens"]}
        self.text = {i: t for t, i in (vocabulary | added).items()}
        pairs = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges]
        self.table = PairTable(*np.array(pairs, dtype=np.int64).T)
        letters = byte_letters()
        self.inner = np.array([vocabulary[c] for c in letters], dtype=np.int32)
        self.last = np.array([vocabulary[c + self.end] for c in letters], dtype=np.int32)
        self.special = added
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")")
        self.words: dict[bytes, tuple[bytes, str]] = {}

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """Ids (unsigned 32-bit, little-endian) and decoded text of each text."""
        if len(self.words) > CACHE_WORDS:
            self.words.clear()  # a new word costs little here: many are merged at once
        units = [t.encode().split() for t in texts]
        self._learn({u for us in units for u in us}.difference(self.words))
        words = self.words
        for us in units:
            found = [words[u] for u in us]
            yield b"".join([f[0] for f in found]), " ".join([f[1] for f in found if f[1]])

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined with a space, special ones too: the file names no decoder."""
        return " ".join([self.text[i] for i in ids.tolist()])

    def _learn(self, units: set[bytes]) -> None:
        plan, pieces = [], {}
        for unit in units:
            parts = self._pieces(unit.decode())
            for part in parts:
                if isinstance(part, bytes):
                    pieces.setdefault(part, len(pieces))
            plan.append((unit, parts))
        ids = self._merge(list(pieces))
        text = self.text
        for unit, parts in plan:
            if len(parts) == 1 and isinstance(parts[0], bytes):
                row = ids[pieces[parts[0]]]
            else:
                row = np.concatenate([np.zeros(0, np.int32), *[ids[pieces[p]] if isinstance(p, bytes)
                                                                else np.array([p], np.int32) for p in parts]])
            self.words[unit] = (row.astype("<u4").tobytes(), " ".join([text[i] for i in row.tolist()]))

    def _pieces(self, unit: str) -> list[bytes | int]:
        if unit.isascii() and unit.isalpha():
            return [unit.lower().encode()]
        found: list[bytes | int] = []
        for part in self.cut.split(unit) if "<|" in unit else [unit]:
            if part in self.special:
                found.append(self.special[part])
                continue
            part = _SPACES.sub(" ", unicodedata.normalize("NFC", part))
            part = "".join(c.lower() for c in part) if "Σ" in part else part.lower()
            found += [p.encode() for p in _PIECES.findall(part)]
        return found

    def _merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of every piece: rows of like length together."""
        result: list[np.ndarray] = [np.zeros(0, np.int32)] * len(pieces)
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        below = 1
        for width in (1, 4, 6, 8, 10, 12, 16, 24, 32, 64, LONG):
            rows = np.flatnonzero((lengths >= below) & (lengths <= width))
            below = width + 1
            for at in range(0, len(rows), 65_536):
                chunk = rows[at:at + 65_536]
                data = np.frombuffer(b"".join([pieces[r].ljust(width, b"\0") for r in chunk]), dtype=np.uint8)
                ids, kept = self._merge_rows(data.reshape(len(chunk), width), lengths[chunk])
                ends = np.cumsum(kept)
                flat = ids[np.arange(ids.shape[1]) < kept[:, None]]
                for r, begin, end in zip(chunk.tolist(), (ends - kept).tolist(), ends.tolist(), strict=True):
                    result[r] = flat[begin:end]
        for row in np.flatnonzero(lengths > LONG):
            result[row] = self._merge_heap(np.frombuffer(pieces[row], dtype=np.uint8))
        return result

    def _start(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        parts = self.inner[data]
        rows = np.arange(len(data))
        parts[rows, lengths - 1] = self.last[data[rows, lengths - 1]]
        return parts

    def _merge_rows(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts, kept = self._start(data, lengths), lengths.copy()
        width = data.shape[1]
        done, counts = np.zeros_like(parts), lengths.copy()
        if width == 1:
            return parts, counts
        table = self.table
        ranks = table.rank[table.find(parts[:, :-1].ravel(), parts[:, 1:].ravel())].reshape(len(parts), width - 1)
        ranks[np.arange(width - 1) >= (lengths - 1)[:, None]] = NO_RANK
        rows, columns = np.arange(len(parts)), np.arange(width)
        while len(rows):
            at = ranks.argmin(axis=1)
            line = np.arange(len(rows))
            going = ranks[line, at] != NO_RANK
            if not going.all():
                done[rows[~going]], counts[rows[~going]] = parts[~going], kept[~going]
                rows, parts, ranks, kept, at = rows[going], parts[going], ranks[going], kept[going], at[going]
                line = np.arange(len(rows))
                if not len(rows):
                    break
            merged = table.merged[table.find(parts[line, at], parts[line, at + 1])]
            parts[line, at] = merged
            # The boundary behind `at` goes: what stands right of it moves one place to the left.
            source = np.minimum(columns + (columns > at[:, None]), width - 1)
            parts = np.take_along_axis(parts, source, axis=1)
            ranks = np.take_along_axis(ranks, np.minimum(source[:, :-1], width - 2), axis=1)
            kept -= 1
            ranks[line, np.minimum(kept - 1, width - 2)] = NO_RANK
            right = np.flatnonzero(at + 1 < kept)
            ranks[right, at[right]] = table.rank[table.find(parts[right, at[right]], parts[right, at[right] + 1])]
            alone = np.flatnonzero(at + 1 >= kept)
            ranks[alone, np.minimum(at[alone], width - 2)] = NO_RANK
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = table.rank[table.find(parts[left, at[left] - 1], parts[left, at[left]])]
        return done, counts

    def _merge_heap(self, data: np.ndarray) -> np.ndarray:
        """The same merges for one long word: leftmost smallest rank first, pairs kept in a heap."""
        table, size = self.table, len(data)
        parts = self._start(data[None, :], np.array([size]))[0].tolist()
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))

        def pair(a: int, b: int) -> tuple[int, int]:
            slot = table.find(np.array([a]), np.array([b]))[0]
            return int(table.rank[slot]), int(table.merged[slot])

        known: dict[tuple[int, int], tuple[int, int]] = {}

        def look(i: int) -> None:
            if i >= 0 and after[i] < size:
                key = parts[i], parts[after[i]]
                rank = known.setdefault(key, None) or known.__setitem__(key, pair(*key)) or known[key]
                if rank[0] != NO_RANK:
                    heapq.heappush(heap, (rank[0], i, *key, rank[1]))

        heap: list[tuple[int, int, int, int, int]] = []
        for i in range(size - 1):
            look(i)
        gone = [False] * size
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            if gone[i] or after[i] >= size or parts[i] != a or parts[after[i]] != b:
                continue
            j = after[i]
            gone[j], parts[i], after[i] = True, merged, after[j]
            if after[i] < size:
                before[after[i]] = i
            look(before[i])
            look(i)
        return np.array([p for p, g in zip(parts, gone, strict=True) if not g], dtype=np.int32)


_READY: dict[str, RankEncoder] = {}


def rank_encoder(path: str) -> RankEncoder:
    """One encoder per worker process."""
    if path not in _READY:
        _READY[path] = RankEncoder(path)
    return _READY[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """`doc_id`, `ids` (array of int) and `decoded` text of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_encoder(path)
        for batch in batches:
            for part in slices(batch):
                found = list(encoder.encode(part.column("text").to_pylist()))
                sizes = np.cumsum([0, *[len(f[0]) // 4 for f in found]]).astype(np.int32)
                flat = np.frombuffer(b"".join([f[0] for f in found]), dtype="<i4")
                ids = pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), ids, pa.array([f[1] for f in found], pa.string())],
                    names=["doc_id", "ids", "decoded"])

    return documents_of(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """`doc_id`, `n_tokens`, and SHA-256 of the ids (unsigned 32-bit, little-endian) and of the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_encoder(path)
        for batch in batches:
            for part in slices(batch):
                rows = [(len(ids) // 4, sha256(ids).hexdigest(), sha256(text.encode()).hexdigest())
                        for ids, text in encoder.encode(part.column("text").to_pylist())]
                counts, ids, texts = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids), pa.array(texts)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return documents_of(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
