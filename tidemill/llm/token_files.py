"""Token ids of documents as grammar-compressed shards (Re-Pair), read back by document.

Every shard holds the ids of consecutive documents. Frequent pairs of adjacent ids are replaced by new symbols again
and again; the shard stores the shortened row of symbols, the rules (left, right), the number of ids that each rule
stands for, and where each document begins in the symbols. A document is decoded by expanding its own symbols only; the
stored expansion lengths tell how many ids that gives, and let a reader skip to any id, without touching the rest.
No rule reaches over a document's end.

A round replaces many pairs at once: the most frequent pairs (`PAIRS` of them, or a third of those that repeat) are
ranked, and an occurrence is replaced where its pair ranks higher than the pairs that overlap it. Rounds go on until no
pair occurs twice. So a shard of n ids needs some tens of passes instead of one for each rule.

The format is a Parquet folder, one row per shard, arrays as little-endian bytes: Spark commits, reads and recovers
it anywhere. Rows: `part`, `shard` (order within the part), `first_id` (ids of the part before the shard), `n_ids`,
`doc_ids` (array), `doc_ends` (symbols up to each document's end), `symbols`, `rules`, `expansions`.

Cases: a null text reads as empty and holds the end id only; a null `doc_id` comes first; repeated ids stand in a row,
in the order of their ids' bytes. Only `doc_id` and `text` are read, so other columns may have any name. An empty table
gives an empty folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.bpe_units import unit_encoder
from tidemill.llm.common import documents_of, shuffle_partitions
from tidemill.plans.scratch import scratch_folder

END = 2
SHARD_IDS = 1_000_000
PAIRS = 2048
LEAST = 2
FIRST_RULE = 65_536
BUCKET_BITS = 20

SHARD_SCHEMA = ("part int, shard int, first_id long, n_ids long, doc_ids array<long>, doc_ends binary, symbols binary, "
                "rules binary, expansions binary")


@dataclass
class Grammar:
    """symbols: the shortened row; rules: (left, right) of symbol FIRST_RULE + i; ends: symbols up to each row's end."""

    symbols: np.ndarray
    rules: np.ndarray
    ends: np.ndarray

    def expansions(self) -> np.ndarray:
        """Ids that each rule stands for. A rule only names symbols of earlier rounds."""
        return np.diff(_unfold(self.rules)[1], prepend=0)


def compress(ids: np.ndarray, ends: np.ndarray, rounds: int | None = None, pairs: int = PAIRS, least: int = LEAST) -> Grammar:
    """ids: rows of ids below FIRST_RULE, one behind the other; ends: where each row ends. Goes on until no pair occurs
    `least` times (two at least) without overlapping itself, or for `rounds` rounds where they are given."""
    symbols, ends = ids.astype(np.int64), np.asarray(ends, dtype=np.int64)
    rules: list[np.ndarray] = []
    found, turn, exact = 0, 0, False
    while len(symbols) > 1 and (rounds is None or turn < rounds):
        turn += 1
        keys = (symbols[:-1] << 32) | symbols[1:]
        inside = np.ones(len(keys), dtype=bool)
        inside[ends[(ends > 0) & (ends < len(symbols))] - 1] = False
        # Of a run of one pair (a a a a) every second occurrence counts, as the others overlap it.
        again = np.flatnonzero(inside[1:] & inside[:-1] & (keys[1:] == keys[:-1])) + 1
        if len(again):
            new = np.r_[True, again[1:] != again[:-1] + 1]
            inside[again[(np.arange(len(again)) - np.maximum.accumulate(np.where(new, np.arange(len(again)), 0))) % 2 == 0]] = False
        place, counts, pair = _counted(keys, inside, turn, exact)
        order = np.flatnonzero(counts >= max(2, least))
        if len(order) < pairs and not exact:
            # Few pairs are left, and some may hide behind others in the hash: from here on all are told apart.
            exact = True
            place, counts, pair = _counted(keys, inside, turn, exact)
            order = np.flatnonzero(counts >= max(2, least))
        if not len(order):
            break
        order = order[np.argsort(-counts[order], kind="stable")[:max(pairs, len(order) // 3)]]
        rank = np.zeros(len(counts), dtype=np.int32)
        rank[order] = np.arange(len(order), 0, -1)
        weight = np.zeros(len(keys) + 2, dtype=np.int32)
        weight[1:-1] = np.where(place >= 0, rank[place], 0)
        here = weight[1:-1]
        chosen = np.flatnonzero((here > weight[:-2]) & (here > weight[2:]))
        # A pair that overlapping ones of higher rank leave but one occurrence of gets no rule in this round.
        taken = len(order) - here[chosen]
        useful = np.bincount(taken, minlength=len(order)) >= 2
        chosen, taken = chosen[useful[taken]], taken[useful[taken]]
        symbols[chosen] = FIRST_RULE + found + (np.cumsum(useful) - 1)[taken]
        gone = np.zeros(len(symbols), dtype=bool)
        gone[chosen + 1] = True
        before = np.concatenate([[0], np.cumsum(gone)])
        ends = ends - before[ends]
        symbols = symbols[~gone]
        pair = pair[order[useful]]
        rules.append(np.stack([pair >> 32, pair & 0xFFFFFFFF], axis=1))
        found += len(pair)
    kept = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    return Grammar(symbols, kept, ends)


def _counted(keys: np.ndarray, inside: np.ndarray, turn: int, exact: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the pair at each occurrence (-1: does not count), occurrences by place, and the pair of each place.

    Not `exact`, pairs are counted by a hash that changes with the round; a bucket speaks for one pair, so of two pairs
    that meet in it one waits for a later round."""
    if exact:
        place = np.full(len(keys), -1, dtype=np.int64)
        pair, place[inside], counts = np.unique(keys[inside], return_inverse=True, return_counts=True)
        return place, counts, pair
    spread = (keys + turn).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bucket = (spread >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
    pair = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    pair[bucket[inside]] = keys[inside]
    same = inside & (pair[bucket] == keys)
    return np.where(same, bucket, -1), np.bincount(bucket[same], minlength=1 << BUCKET_BITS), pair


def expand(symbols: np.ndarray, rules: np.ndarray, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a row of symbols, and where each stretch that ended at `ends` now ends."""
    ends = np.array([len(symbols)]) if ends is None else np.asarray(ends, dtype=np.int64)
    if not len(symbols):
        return symbols, ends
    text, stops = _unfold(rules)
    sizes = np.diff(stops, prepend=0)
    deep = symbols >= FIRST_RULE
    width = np.ones(len(symbols), dtype=np.int64)
    width[deep] = sizes[symbols[deep] - FIRST_RULE]
    stop = np.cumsum(width)
    # Place in (ids of all rules, then the plain ids) of each symbol's first id; the others follow it.
    first = np.empty(len(symbols), dtype=np.int64)
    first[deep] = (stops - sizes)[symbols[deep] - FIRST_RULE]
    first[~deep] = len(text) + symbols[~deep]
    source = np.arange(stop[-1]) + np.repeat(first - (stop - width), width)
    return np.concatenate([text, np.arange(FIRST_RULE)])[source], np.concatenate([[0], stop])[ends]


def _unfold(rules: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every rule, one behind the other, and where each ends: a level of rules at a time."""
    symbols = np.arange(FIRST_RULE, FIRST_RULE + len(rules), dtype=np.int64)
    ends = np.arange(1, len(rules) + 1)
    while len(symbols) and (deep := symbols >= FIRST_RULE).any():
        width = 1 + deep.astype(np.int64)
        stop = np.cumsum(width)
        grown = np.repeat(symbols, width)
        pair = rules[symbols[deep] - FIRST_RULE]
        grown[stop[deep] - 2], grown[stop[deep] - 1] = pair[:, 0], pair[:, 1]
        ends = np.concatenate([[0], stop])[ends]
        symbols = grown
    return symbols, ends


def encode_documents(docs: DataFrame, path: str, spaced: bool = True, bounds: list[int] | None = None) -> DataFrame:
    """`doc_id`, `ids` (unsigned 16-bit bytes with the end id) of every document, and the number of bounds below its
    `doc_id` as `part` (null comes first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limits = np.array(bounds or [], dtype=np.int64)
        encoder, end = unit_encoder(path, spaced), np.array([END], dtype="<u2").tobytes()
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                ids = [encoder.encode(t) + end for t in part.column("text").to_pylist()]
                names = pa.compute.fill_null(part.column("doc_id"), -2**63)
                place = np.searchsorted(limits, np.asarray(names), side="left").astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(place)],
                                                 names=["doc_id", "ids", "part"])

    return documents_of(docs).mapInArrow(run, "doc_id long, ids binary, part int")


def id_bounds(docs: DataFrame, parts: int) -> list[int]:
    """At most `parts` - 1 bounds that cut the documents into runs of ascending ids of about equal number."""
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return []
    found = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), shares, 10 * parts)).first()[0]
    return sorted(set(found or []))


def shards(docs: DataFrame, path: str, shard_ids: int = SHARD_IDS, spaced: bool = True) -> DataFrame:
    """The shards of all documents, ascending by `doc_id` over (part, shard). One shuffle, of the ids."""
    bounds = id_bounds(docs, shuffle_partitions(docs.sparkSession))
    coded = encode_documents(docs, path, spaced, bounds)
    dealt = coded.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("part", "doc_id", "ids")

    def pack(part: int, shard: int, first: int, names: list, rows: list[bytes]) -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(rows), dtype="<u2")
        grammar = compress(ids, np.cumsum([len(r) // 2 for r in rows]))
        return pa.RecordBatch.from_arrays([
            pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([first], pa.int64()),
            pa.array([len(ids)], pa.int64()), pa.array([names], pa.list_(pa.int64())),
            pa.array([grammar.ends.astype("<u8").tobytes()], pa.binary()), pa.array([grammar.symbols.astype("<u4").tobytes()], pa.binary()),
            pa.array([grammar.rules.astype("<u4").tobytes()], pa.binary()),
            pa.array([grammar.expansions().astype("<u8").tobytes()], pa.binary())],
            names=["part", "shard", "first_id", "n_ids", "doc_ids", "doc_ends", "symbols", "rules", "expansions"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, rows, held, shard, first, part = [], [], 0, 0, 0, None
        for batch in batches:
            for p, name, ids in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "ids")), strict=True):
                if rows and (p != part or held >= shard_ids):
                    yield pack(part, shard, first, names, rows)
                    shard, first, names, rows, held = shard + 1, first + held, [], [], 0
                if p != part:
                    part, shard, first = p, 0, 0
                names.append(name)
                rows.append(ids)
                held += len(ids) // 2
        if rows:
            yield pack(part, shard, first, names, rows)

    return dealt.select("part", "doc_id", "ids").mapInArrow(run, SHARD_SCHEMA)


def write_shards(docs: DataFrame, path: str, folder: str, shard_ids: int = SHARD_IDS) -> None:
    shards(docs, path, shard_ids).write.parquet(folder)


def read_documents(spark, folder: str) -> DataFrame:
    """`doc_id`, `start`, `n_tokens`, `ids` (unsigned 32-bit bytes) of every document, from the files alone."""
    stored = spark.read.schema(SHARD_SCHEMA).parquet(folder)
    totals = stored.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row per part of the range partitioning, however many documents there are.
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    placed = stored.join(F.broadcast(before), "part").withColumn("first_id", F.col("first_id") + F.col("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                part = batch.slice(row, 1).to_pylist()[0]
                symbols = np.frombuffer(part["symbols"], dtype="<u4").astype(np.int64)
                rules = np.frombuffer(part["rules"], dtype="<u4").astype(np.int64).reshape(-1, 2)
                ids, ends = expand(symbols, rules, np.frombuffer(part["doc_ends"], dtype="<u8").astype(np.int64))
                begins = np.r_[0, ends[:-1]]
                flat = ids.astype("<u4")
                yield pa.RecordBatch.from_arrays([
                    pa.array(part["doc_ids"], pa.int64()), pa.array(part["first_id"] + begins),
                    pa.array(ends - begins),
                    pa.array([flat[a:b].tobytes() for a, b in zip(begins, ends, strict=True)], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])

    names = ("first_id", "doc_ids", "doc_ends", "symbols", "rules")
    return placed.select(*names).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def read_one(row: dict, doc: int) -> np.ndarray:
    """Ids of the `doc`-th document of a shard: its own symbols are all that is expanded."""
    ends = np.frombuffer(row["doc_ends"], dtype="<u8").astype(np.int64)
    begin = int(ends[doc - 1]) if doc else 0
    symbols = np.frombuffer(row["symbols"], dtype="<u4")[begin:int(ends[doc])].astype(np.int64)
    return expand(symbols, np.frombuffer(row["rules"], dtype="<u4").astype(np.int64).reshape(-1, 2))[0]


def read_range(row: dict, begin: int, end: int) -> np.ndarray:
    """Ids `begin` to `end` of a shard: the expansion lengths lead to the symbols that hold them."""
    symbols = np.frombuffer(row["symbols"], dtype="<u4").astype(np.int64)
    sizes = np.frombuffer(row["expansions"], dtype="<u8").astype(np.int64)
    width = np.ones(len(symbols), dtype=np.int64)
    deep = symbols >= FIRST_RULE
    width[deep] = sizes[symbols[deep] - FIRST_RULE]
    stop = np.cumsum(width)
    first, last = np.searchsorted(stop, begin, side="right"), np.searchsorted(stop, end, side="left")
    ids, _ = expand(symbols[first:last + 1], np.frombuffer(row["rules"], dtype="<u4").astype(np.int64).reshape(-1, 2))
    skip = begin - (int(stop[first - 1]) if first else 0)
    return ids[skip:skip + end - begin]


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """Write the shards, read them back: `doc_id`, `start`, `n_tokens`, `ids_crc32` of every document."""
    folder = scratch_folder(docs.sparkSession, "token-shards")
    write_shards(docs, path, folder)
    back = read_documents(docs.sparkSession, folder)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
