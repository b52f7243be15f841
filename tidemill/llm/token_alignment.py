"""Two tokenizers' ids of the same text held against each other.

Both id sequences are laid over the text's bytes. Where a token of each ends on the same byte a group ends; a link is a
pair of tokens whose bytes overlap. How often a pair of ids is linked in the whole corpus tells which id of one
vocabulary stands for an id of the other.

The counts are kept in vectors under a minimal perfect hash of the distinct pairs:

1. The first pass aligns every document; a task keeps the pairs it has seen and their counts, split into `BUCKETS` by
   a hash. The distinct pairs of a bucket are gathered over a tree of `FAN` tasks a node.
2. A bucket's pairs get a minimal perfect hash: pairs that are alone in their slot of a level keep it, the others go on
   to the next level; a pair's index is the number of taken slots up to its own. The pairs are stored in that order,
   so that a look-up can tell a pair that is not among them.
3. Each task's counts become a dense vector a bucket, indexed by the hash; vectors are added up over the same tree.
4. The second pass aligns every document again and looks its links up. Hash, pairs and counts reach the tasks by
   broadcast in blocks of at most `BLOCK_PAIRS` pairs (unless one bucket alone holds more, at most a `BUCKETS`th of all
   possible pairs of ids); with several blocks the pass is repeated for each and the sums are added.

Texts are cut into units at places that neither vocabulary's tokens reach over, so both the alignment of a unit and its
links are worked out once and remembered by the worker. A cut is before a run of white space that begins with a space
or a line break, and between a plain letter or digit and a mark of punctuation; whether pieces of the second vocabulary
reach over such a place is read from the vocabulary. A text with other white space is one unit.

Cases: texts that are null, empty or not given back by both vocabularies have no tokens: zeros and an empty string; they
add nothing to the counts. Strings of special tokens are plain text. Ties for a B id's highest count all count as best.
Repeated rows count each time and are rows each. A text of any length is one row of one task; long words and long texts
are aligned by array operations. An empty table gives no rows. Only `doc_id` and `text` are read, so other columns may
have any name.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.bpe_units import byte_letters
from tidemill.llm.common import documents_of, kept_table, mix, slices

BUCKETS = 256
FAN = 64
BLOCK_PAIRS = 4_000_000
CACHE_UNITS = 500_000
CACHE_CHARS = 16_000_000
SPARSE = 1.5  # slots a pair on every level of the hash
_BASE = 0x9E3779B97F4A7C15

_PLAIN = "0-9A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = ".,;:!?"


# Minimal perfect hash -----------------------------------------------------------------------------------------


def bucket_of(pairs: np.ndarray) -> np.ndarray:
    return (mix(pairs.astype(np.uint64) + np.uint64(_BASE)) >> np.uint64(56)).astype(np.int64) * BUCKETS >> 8


def _slots(pairs: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    spread = mix(pairs.astype(np.uint64) ^ mix(np.array([level + 1], np.uint64) * np.uint64(0xD1B54A32D192ED03)))
    return (spread >> np.uint64(1)).astype(np.int64) % size


def build_hash(pairs: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Sizes of the levels, the taken slots of all levels, and the pairs in the order of their index."""
    sizes, taken, order, left = [], [], [], np.asarray(pairs, dtype=np.uint32)
    while len(left):
        size = max(1, int(SPARSE * len(left)))
        slot = _slots(left, len(sizes), size)
        alone = np.bincount(slot, minlength=size) == 1
        own = alone[slot]
        order.append(left[own][np.argsort(slot[own])])
        sizes.append(size)
        taken.append(alone)
        left = left[~own]
    none = np.zeros(0, np.uint32)
    return sizes, np.concatenate(taken) if taken else np.zeros(0, bool), np.concatenate(order) if order else none


class PairTable:
    """The hashes of several buckets side by side: index of a pair, or -1 for a pair that is in none of them."""

    def __init__(self, rows: list[dict]):
        """rows: `bucket`, `sizes`, `taken` (packed bits), `pairs`, by bucket."""
        deepest = max([len(r["sizes"]) for r in rows], default=0)
        self.sizes, self.places = np.ones((deepest, BUCKETS), np.int64), np.zeros((deepest, BUCKETS), np.int64)
        self.there = np.zeros((deepest, BUCKETS), bool)
        taken, at = [], 0
        for r in rows:
            taken.append(np.unpackbits(np.frombuffer(r["taken"], np.uint8), count=sum(r["sizes"])).astype(bool))
            for level, size in enumerate(r["sizes"]):
                self.sizes[level, r["bucket"]], self.places[level, r["bucket"]], self.there[level, r["bucket"]] = size, at, True
                at += size
        self.taken = np.concatenate([*taken, np.zeros(1, bool)])
        self.rank = np.cumsum(self.taken, dtype=np.int32) - 1
        self.pairs = np.concatenate([np.zeros(0, np.uint32), *[np.frombuffer(r["pairs"], "<u4") for r in rows]])

    def index(self, pairs: np.ndarray) -> np.ndarray:
        found, left, bucket = np.full(len(pairs), -1, np.int64), np.arange(len(pairs)), bucket_of(pairs)
        for level in range(len(self.sizes)):
            left = left[self.there[level, bucket[left]]]
            if not len(left):
                break
            own = bucket[left]
            slot = self.places[level, own] + _slots(pairs[left], level, self.sizes[level, own])
            held = self.taken[slot]
            found[left[held]] = self.rank[slot[held]]
            left = left[~held]
        known = np.flatnonzero(found >= 0)
        found[known[self.pairs[found[known]] != pairs[known]]] = -1
        return found


# Alignment ----------------------------------------------------------------------------------------------------


class _Index(dict):
    """Number of a unit; a new one is noted down."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, unit: str) -> int:
        number = self[unit] = len(self)
        self.fresh.append(unit)
        return number


class Aligner:
    """Units of texts with their tokens, groups and links under two vocabularies.

    By unit: `n_a`, `n_b`, `n_groups`, `n_links`, `whole` (both vocabularies give its bytes back), `shown` (its groups as
    text). By link: `pairs` (A id in the upper 16 bits, B id in the lower) and `owners` (the unit).
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.a.model
        if max(self.a.get_vocab_size(), self.b.vocab_size()) > 65_536:
            raise ValueError("ids of these vocabularies do not fit 16 bits")
        self.letters, self.names = dict(enumerate(byte_letters())), [str(i) for i in range(65_536)]
        values = {letter: value for value, letter in self.letters.items()}
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for entry, number in self.a.get_vocab().items():
            self.bytes_a[number] = bytes(values[c] for c in entry) if all(c in values for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.width_a, self.width_b = (np.array([len(x) for x in v], np.int64) for v in (self.bytes_a, self.bytes_b))
        # Places that a token of B may reach over are no places to cut at.
        inner = {x + y for n, p in enumerate(pieces) if not self.b.is_byte(n) for x, y in zip(p, p[1:])}
        self.cuttable = not any(two[1] in "▁\n" and two[0] != "▁" or "\n" in two for two in inner)
        plain = re.compile(f"[{_PLAIN}]")
        marks = "".join(m for m in _MARKS if not any(two[1] == m and plain.match(two[0]) for two in inner))
        self.units = re.compile(rf"\s*+[{_PLAIN}]++(?![^\s{re.escape(marks)}])|\s*+\S+|\s+")
        self.odd = re.compile(r"[^\S \n]")
        self.space = self.b.piece_to_id("▁")
        self.clear()

    def clear(self) -> None:
        self.index, self.chars, self.shown = _Index(), 0, []
        self.stats, self.pairs, self.owners = np.zeros((0, 5), np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def full(self) -> bool:
        return len(self.index) > CACHE_UNITS or self.chars > CACHE_CHARS

    def numbers(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the units of all texts, and where each text begins among them (one more than texts)."""
        rows, odd, units, number = [], self.odd.search, self.units.findall, self.index.__getitem__
        for text in texts:
            if not text:
                rows.append([])
            elif odd(text) or not self.cuttable:
                rows.append([number(" " + text)])
            else:
                rows.append(list(map(number, units(" " + text))))
        if self.index.fresh:
            self._learn(self.index.fresh)
            self.index.fresh = []
        starts = np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)]).astype(np.int64)
        return np.fromiter(chain.from_iterable(rows), np.int64, starts[-1]), starts

    def _ids_a(self, unit: str) -> list[int]:
        word = unit[1:] if unit[0] == " " else unit
        if word.isalpha():  # one piece to the vocabulary's pattern
            letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            return [t.id for t in self.model.tokenize(letters if word is unit else "Ġ" + letters)]
        return self.a.encode(unit, add_special_tokens=False).ids

    def _ids_b(self, units: list[str]) -> list[list[int]]:
        """B puts a space before a text: a unit's own space stands for it, another unit follows a line break, whose ids
        (that space and the break's) are dropped."""
        asked = [u[1:] if u[0] == " " else "\n" + u for u in units]
        return [[self.space] if u == " " else ids if u[0] == " " else ids[2:]
                for u, ids in zip(units, self.b.encode(asked), strict=True)]

    def _learn(self, units: list[str]) -> None:
        ids_a, ids_b = [self._ids_a(u) for u in units], self._ids_b(units)
        whole = self._given_back(units, ids_a, ids_b)
        if not whole.all():
            ids_a, ids_b = ([x if w else [] for x, w in zip(ids, whole, strict=True)] for ids in (ids_a, ids_b))
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
        flat_a, flat_b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (ids_a, ids_b))
        owner_a = np.repeat(np.arange(len(units)), n_a)
        ends_a, ends_b = np.cumsum(self.width_a[flat_a]), np.cumsum(self.width_b[flat_b])
        starts_a, starts_b = ends_a - self.width_a[flat_a], ends_b - self.width_b[flat_b]
        closes_a, closes_b = np.isin(ends_a, ends_b), np.isin(ends_b, ends_a)
        first = np.searchsorted(ends_b, starts_a, side="right")
        links = np.searchsorted(starts_b, ends_a, side="left") - first
        of_a = np.repeat(np.arange(len(flat_a)), links)
        of_b = np.arange(len(of_a)) - np.repeat(np.cumsum(links) - links, links) + np.repeat(first, links)
        base, size = len(self.stats), len(units)
        stats = np.stack([n_a, n_b, np.bincount(owner_a[closes_a], minlength=size),
                          np.bincount(owner_a[of_a], minlength=size), whole], axis=1).astype(np.int64)
        self.stats = np.concatenate([self.stats, stats])
        self.pairs = np.concatenate([self.pairs, (flat_a[of_a] << 16 | flat_b[of_b]).astype(np.uint32)])
        self.owners = np.concatenate([self.owners, owner_a[of_a] + base])
        self.chars += sum(map(len, units))
        text_a, text_b = (list(map(self.names.__getitem__, flat.tolist())) for flat in (flat_a, flat_b))
        stop_a, stop_b = (np.flatnonzero(closes_a) + 1).tolist(), (np.flatnonzero(closes_b) + 1).tolist()
        groups = [f"{','.join(text_a[i:j])}|{','.join(text_b[k:n])}"
                  for i, j, k, n in zip([0, *stop_a], stop_a, [0, *stop_b], stop_b)]
        upto = np.cumsum(stats[:, 2]).tolist()
        self.shown += [";".join(groups[i:j]) for i, j in zip([0, *upto], upto)]

    def _given_back(self, units: list[str], ids_a: list[list[int]], ids_b: list[list[int]]) -> np.ndarray:
        """Whether both vocabularies' tokens have the bytes of a unit: all at once, and one by one if they have not."""
        raws = [u.encode() for u in units]
        sizes, text, good = np.array([len(r) for r in raws]), b"".join(raws), True
        for ids, table, width in ((ids_a, self.bytes_a, self.width_a), (ids_b, self.bytes_b, self.width_b)):
            flat = list(chain.from_iterable(ids))
            ends = np.concatenate([[0], np.cumsum(width[flat])])[np.cumsum([len(x) for x in ids])]
            good = good and (np.diff(ends, prepend=0) == sizes).all() and b"".join([table[i] for i in flat]) == text
        if good:
            return np.ones(len(units), bool)
        return np.array([all(b"".join([table[i] for i in ids]) == raw for ids, table in ((x, self.bytes_a), (y, self.bytes_b)))
                         for raw, x, y in zip(raws, ids_a, ids_b, strict=True)])

    def usable(self, numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Whether both vocabularies give a text back whole."""
        return self.sums(1 - self.stats[:, 4], numbers, starts) == 0

    @staticmethod
    def sums(values: np.ndarray, numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Sum of a value by unit over the units of each text."""
        return np.diff(np.concatenate([[0], np.cumsum(values[numbers])])[starts])


_READY: dict = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner per worker process and pair of vocabularies; its units outlive a task."""
    if (path_a, path_b) not in _READY:
        _READY[path_a, path_b] = Aligner(path_a, path_b)
    return _READY[path_a, path_b]


# First pass, hashes and vectors -------------------------------------------------------------------------------


def _merged(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order, and the sum of the counts of each."""
    order = np.argsort(pairs, kind="stable")
    pairs, counts = pairs[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, np.int64)
    return pairs[first], np.add.reduceat(counts, first) if len(first) else counts


def count_pairs(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """`bucket`, `part`, `pairs`, `counts`: the links of every task's documents, by bucket of the pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        uses, found = np.zeros(0, np.int64), (np.zeros(0, np.uint32), np.zeros(0, np.int64))

        def settle() -> tuple[np.ndarray, np.ndarray]:
            times = np.concatenate([uses, np.zeros(len(own.stats) - len(uses), np.int64)])[own.owners]
            used = times > 0
            return _merged(np.concatenate([found[0], own.pairs[used]]), np.concatenate([found[1], times[used]]))

        for batch in batches:
            for part in slices(batch):
                numbers, starts = own.numbers(part.column("text").to_pylist())
                kept = np.repeat(own.usable(numbers, starts), np.diff(starts))
                counted = np.bincount(numbers[kept], minlength=len(own.stats))
                counted[:len(uses)] += uses
                uses = counted
                if own.full():
                    found, uses = settle(), np.zeros(0, np.int64)
                    own.clear()
        pairs, counts = settle()
        bucket = bucket_of(pairs)
        order = np.argsort(bucket, kind="stable")
        held, begins = np.unique(bucket[order], return_index=True)
        ends = np.append(begins[1:], len(order))[:len(begins)]
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([
            pa.array(held, pa.int32()), pa.array([task] * len(held), pa.int32()),
            pa.array([pairs[order[i:j]].astype("<u4").tobytes() for i, j in zip(begins, ends, strict=True)], pa.binary()),
            pa.array([counts[order[i:j]].astype("<i8").tobytes() for i, j in zip(begins, ends, strict=True)], pa.binary())],
            names=["bucket", "part", "pairs", "counts"])

    return documents_of(docs).mapInArrow(run, "bucket int, part int, pairs binary, counts binary")


def _by_tree(rows: DataFrame, parts: int, merge, schema: str) -> DataFrame:
    """One row a bucket from one row a bucket and part: `FAN` parts at a time, as often as it takes. `merge` makes one
    row's columns after `bucket` and `part` from a table of a group's rows."""
    fields = rows.sparkSession.createDataFrame([], schema).schema.fieldNames()

    def run(key: tuple, table: pa.Table) -> pa.Table:
        values = merge(table)
        arrays = [pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()),
                  *[pa.array([v], pa.binary()) for v in values]]
        return pa.table(arrays, names=fields)

    while True:
        parts = -(-parts // FAN)
        dealt = rows.withColumn("part", F.floor(F.col("part") / FAN).cast("int"))
        rows = dealt.groupBy("bucket", "part").applyInArrow(run, schema)
        if parts <= 1:
            return rows


def _distinct(table: pa.Table) -> list[bytes]:
    known = np.zeros(0, np.uint32)
    for pairs in table.column("pairs").to_pylist():
        known = np.union1d(known, np.frombuffer(pairs, "<u4"))
    return [known.astype("<u4").tobytes()]


def _added(table: pa.Table) -> list[bytes]:
    total = None
    for vector in table.column("vector").to_pylist():
        vector = np.frombuffer(vector, "<i8")
        total = vector if total is None else total + vector
    return [total.astype("<i8").tobytes()]


_HASH = "bucket int, n long, sizes array<long>, taken binary, pairs binary"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for bucket, pairs in zip(batch.column("bucket").to_pylist(), batch.column("pairs").to_pylist(), strict=True):
            sizes, taken, order = build_hash(np.frombuffer(pairs, "<u4"))
            yield pa.RecordBatch.from_arrays([
                pa.array([bucket], pa.int32()), pa.array([len(order)], pa.int64()), pa.array([sizes], pa.list_(pa.int64())),
                pa.array([np.packbits(taken).tobytes()], pa.binary()), pa.array([order.astype("<u4").tobytes()], pa.binary())],
                names=["bucket", "n", "sizes", "taken", "pairs"])


def _dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts as a vector over all pairs of the bucket."""
    for batch in batches:
        for at in range(len(batch)):
            row = batch.slice(at, 1).to_pylist()[0]
            vector = np.zeros(row["n"], "<i8")
            table = PairTable([{"bucket": row["bucket"], "sizes": row["sizes"], "taken": row["taken"], "pairs": row["order"]}])
            vector[table.index(np.frombuffer(row["pairs"], "<u4"))] = np.frombuffer(row["counts"], "<i8")
            yield pa.RecordBatch.from_arrays([pa.array([row["bucket"]], pa.int32()), pa.array([row["part"]], pa.int32()),
                                              pa.array([vector.tobytes()], pa.binary())], names=["bucket", "part", "vector"])


def pair_counts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """`bucket`, `n`, `sizes`, `taken`, `pairs`, `vector`: hash, pairs and counts of every bucket, at most `BUCKETS` rows."""
    partial = kept_table(count_pairs(docs, path_a, path_b), "aligned-pairs")
    parts = 1 + (partial.agg(F.max("part")).first()[0] or 0)
    known = _by_tree(partial.select("bucket", "part", "pairs"), parts, _distinct, "bucket int, part int, pairs binary")
    hashed = kept_table(known.select("bucket", "pairs").mapInArrow(_hashed, _HASH), "aligned-hashes")
    aimed = partial.join(hashed.withColumnRenamed("pairs", "order"), "bucket")
    vectors = aimed.mapInArrow(_dense, "bucket int, part int, vector binary")
    summed = _by_tree(vectors, parts, _added, "bucket int, part int, vector binary")
    return kept_table(hashed.join(summed.select("bucket", "vector"), "bucket"), "aligned-counts")


def best_counts(counts: DataFrame) -> DataFrame:
    """`b`, `best`: the highest count of a pair of each B id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs, vector in zip(batch.column("pairs").to_pylist(), batch.column("vector").to_pylist(), strict=True):
                best = np.zeros(65_536, np.int64)
                np.maximum.at(best, np.frombuffer(pairs, "<u4") & 0xFFFF, np.frombuffer(vector, "<i8"))
                held = np.flatnonzero(best)
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(best[held], pa.int64())],
                                                 names=["b", "best"])

    return counts.select("pairs", "vector").mapInArrow(run, "b int, best long").groupBy("b").agg(F.max("best").alias("best"))


# Second pass --------------------------------------------------------------------------------------------------


def _blocks(counts: DataFrame) -> list[list[int]]:
    """Buckets in runs of at most `BLOCK_PAIRS` pairs; `BUCKETS` numbers reach the driver."""
    blocks, held = [], 0
    for bucket, n in sorted((r["bucket"], r["n"]) for r in counts.select("bucket", "n").collect()):
        if not blocks or held + n > BLOCK_PAIRS:
            blocks.append([])
            held = 0
        blocks[-1].append(bucket)
        held += n
    return blocks or [[]]


_SUMS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """`doc_id`, `n_a`, `n_b`, `n_groups`, `n_links`, `n_best`, `count_sum`, `groups` (sha256 of the groups as text) of
    every document."""
    spark = docs.sparkSession
    counts = pair_counts(docs, path_a, path_b)
    best = np.zeros(65_536, np.int64)
    for row in best_counts(counts).collect():  # at most one row an id of the second vocabulary
        best[row["b"]] = row["best"]
    blocks = _blocks(counts)
    rows = documents_of(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    if len(blocks) > 1:
        rows = kept_table(rows, "aligned-documents")
    found = None
    for number, buckets in enumerate(blocks):
        held = counts.where(F.col("bucket").isin(buckets)).orderBy("bucket").collect() if buckets else []
        shared = spark.sparkContext.broadcast((
            [{k: r[k] for k in ("bucket", "sizes", "taken", "pairs")} for r in held], [bytes(r["vector"]) for r in held], best))
        measured = rows.mapInArrow(_measure(shared, path_a, path_b, number == 0), _MEASURED)
        found = measured if found is None else found.union(measured)
    if len(blocks) == 1:
        return found.drop("row")
    return found.groupBy("row", "doc_id").agg(*[F.sum(c).alias(c) for c in _SUMS], F.max("groups").alias("groups")).drop("row")


_MEASURED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def _measure(shared, path_a: str, path_b: str, first: bool):
    """The pass over the documents with one block of counts; the first one also gives what does not depend on counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        rows, vectors, best = shared.value
        table = PairTable(rows)
        counts = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(v, "<i8") for v in vectors], [0]])
        values, done = np.zeros((0, 2), np.int64), 0
        for batch in batches:
            for part in slices(batch):
                if own.full():
                    own.clear()
                    values, done = np.zeros((0, 2), np.int64), 0
                numbers, starts = own.numbers(part.column("text").to_pylist())
                if len(own.stats) > len(values):
                    pairs, owners = own.pairs[done:], own.owners[done:] - len(values)
                    times = counts[table.index(pairs)]
                    fresh = np.zeros((len(own.stats) - len(values), 2), np.int64)
                    np.add.at(fresh[:, 0], owners, ((times > 0) & (times == best[pairs & 0xFFFF])).astype(np.int64))
                    np.add.at(fresh[:, 1], owners, times)
                    values, done = np.concatenate([values, fresh]), len(own.pairs)
                whole = own.usable(numbers, starts)
                sums = [own.sums(own.stats[:, k] * first, numbers, starts) for k in range(4)]
                sums += [own.sums(values[:, k], numbers, starts) for k in range(2)]
                shown = []
                for k, kept in enumerate(whole.tolist()):
                    units = numbers[starts[k]:starts[k + 1]].tolist() if kept and first else []
                    text = ";".join([own.shown[u] for u in units])
                    shown.append(sha256(text.encode()).hexdigest() if text else "")
                yield pa.RecordBatch.from_arrays([
                    part.column("row"), part.column("doc_id"), *[pa.array(np.where(whole, s, 0), pa.int64()) for s in sums],
                    pa.array(shown, pa.string())], names=["row", "doc_id", *_SUMS, "groups"])

    return run
