"""A Merkle manifest of the documents, kept as postorder append logs.

Every row is a leaf; the leaves of a source, ascending by doc_id, form a tree in which three consecutive nodes (the
last ones: what is left, even a single one) become their hash until one node remains, the subroot. The subroots, by
source, form the tree above in the same way; what remains there is the root.

A builder gets an aligned block of 3^6 nodes of one tree and writes the nodes of its subtree in the order in which they
are completed: a leaf, and after every third node of a level their parent. The block's log needs nothing else than its
own nodes, so blocks are built wherever Spark puts them; their roots are the leaves of the next round of builders, a
729th as many. No task ever holds more than one block.

A node is found again without any index. In completion order, the nodes before (level, index) are those of its own
subtree and those whose last leaf lies before its first one, so its position follows from the sizes of subtrees alone
(`position`). A proof reads the siblings at those positions: the block's own levels from the block's log, those above
from the logs of later rounds, once for the whole block.

Cases: null fields count as `-`; a null doc_id comes first in its source and is never tampered with; a null source comes
before all others, also before the empty one. Rows that share a doc_id stand in the order of their leaves; repeated
rows are leaves each, and spread over the tasks like any other rows. A source of one row has that row's leaf as its
subroot, a table of one source its subroot as root; a proof without siblings is the hash of nothing. An empty table
gives no rows. A text of any length is hashed where it is read and never moved. Only the five columns of `documents`
are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import kept_table, remainder, shuffle_partitions

ARITY = 3
BLOCK_LEVELS = 6
BLOCK = ARITY**BLOCK_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_HEX = 64


def digest_of(parts: list[bytes]) -> bytes:
    """Hash of digests written as lowercase hexadecimal text, one behind the other."""
    return sha256(b"".join(parts)).hexdigest().encode()


def levels_above(total: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while total > 1:
        total, levels = -(-total // ARITY), levels + 1
    return levels


def position(level: int, index: int, total: int, levels: int) -> int:
    """Place of a node in the postorder log of a tree of `total` leaves with `levels` levels above them.

    Before it are complete all nodes up to its own level over the leaves up to its last one, and of each higher level
    those whose last leaf lies before its first one.
    """
    last = min((index + 1) * ARITY**level, total)
    lower = sum(-(-last // ARITY**h) for h in range(level + 1))
    return lower - 1 + sum(index // ARITY**(h - level) for h in range(level + 1, levels + 1))


def completed(leaves: list[bytes], levels: int) -> Iterator[tuple[int, bytes]]:
    """(level, digest) of every node over `leaves` in the order of completion."""
    pending: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def close(level: int) -> Iterator[tuple[int, bytes]]:
        node = digest_of(pending[level])
        pending[level] = []
        pending[level + 1].append(node)
        yield level + 1, node
        if level + 1 < levels and len(pending[level + 1]) == ARITY:
            yield from close(level + 1)

    for leaf in leaves:
        pending[0].append(leaf)
        yield 0, leaf
        if levels and len(pending[0]) == ARITY:
            yield from close(0)
    for level in range(levels):
        if pending[level]:
            yield from close(level)


def steps_of(log: bytes, total: int, levels: int) -> list[list[tuple[bytes, bytes]]]:
    """By level and index, the siblings of a node as text: those to its left and those to its right."""
    found = []
    for level in range(levels):
        width = -(-total // ARITY**level)
        at = [position(level, i, total, levels) * _HEX for i in range(width)]
        nodes = [log[p:p + _HEX] for p in at]
        row = []
        for i in range(width):
            first = i - i % ARITY
            row.append((b"".join(nodes[first:i]), b"".join(nodes[i + 1:first + ARITY])))
        found.append(row)
    return found


def fold(node: bytes, steps: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a node leads to with these siblings."""
    for left, right in steps:
        node = digest_of([left, node, right])
    return node


def leaf_digest(text: Column | str = "text") -> Column:
    """Digest of a row: each field's number of bytes, a colon and the field; `-` for a null."""
    def shown(value: Column) -> Column:
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    values = [(F.col(c) if c != "text" else F.col(text) if isinstance(text, str) else text).cast("string") for c in FIELDS]
    return F.sha2(F.concat(*[shown(v) for v in values]).cast("binary"), 256)


def leaves_of(docs: DataFrame) -> DataFrame:
    """`name` (the source, such that null comes first), `doc_id`, `leaf`, and `altered`, the leaf of the text without
    line breaks where 2 divides the checksum of the doc_id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *FIELDS[1:])
    chosen = remainder("doc_id", 2) == 0
    return rows.select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("name"), "doc_id", leaf_digest().alias("leaf"),
        F.when(chosen, leaf_digest(F.replace("text", F.lit("\n"), F.lit("")))).alias("altered"))


def in_order(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """`rows` with `idx`, their place within the group, and `total`, the group's rows.

    Rows are dealt into ranges and written; a row's place is that within its range plus the rows of its group in the
    ranges before, of which there is one sum for each range and group.
    """
    parts = shuffle_partitions(rows.sparkSession)
    dealt = rows.repartitionByRange(parts, *group, *order).sortWithinPartitions(*group, *order)
    placed = kept_table(dealt.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("line")), name)
    runs = placed.groupBy("part", *group).agg(F.min("line").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(*group)
    runs = runs.select("part", *group, (F.sum("n").over(whole.orderBy("part")) - F.col("n") - F.col("first")).alias("shift"),
                       F.sum("n").over(whole).alias("total"))
    return placed.join(runs, ["part", *group]).withColumn("idx", F.col("line") + F.col("shift")).drop("part", "line", "shift")


def _build(key: tuple, table: pa.Table) -> pa.Table:
    """The log of one aligned block."""
    table = table.sort_by("idx")
    total = table.column("total")[0].as_py()
    levels = levels_above(total) if total <= BLOCK else BLOCK_LEVELS
    nodes = [d.encode() for d in table.column("digest").to_pylist()]
    log = b"".join([digest for _, digest in completed(nodes, levels)])
    columns = {"name": [key[0].as_py()], "block": [key[1].as_py()], "total": [total], "size": [len(nodes)],
               "log": [log], "root": [log[-_HEX:].decode()]}
    arrays = [pa.array(columns["name"], pa.string()), pa.array(columns["block"], pa.int64()),
              pa.array(columns["total"], pa.int64()), pa.array(columns["size"], pa.int32()),
              pa.array(columns["log"], pa.binary()), pa.array(columns["root"], pa.string())]
    names = list(columns)
    if "doc_id" in table.column_names:
        arrays += [pa.array([table.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                   pa.array([table.column("altered").to_pylist()], pa.list_(pa.string()))]
        names += ["doc_ids", "altered"]
    return pa.table(arrays, names=names)


_SEGMENT = "name string, block long, total long, size int, log binary, root string"


def grow(nodes: DataFrame, name: str) -> list[DataFrame]:
    """All logs of the trees over `nodes` (`name`, `idx`, `total`, `digest`), a table of blocks for each round."""
    most = nodes.agg(F.max("total")).first()[0] or 0
    schema = _SEGMENT + (", doc_ids array<long>, altered array<string>" if "doc_id" in nodes.columns else "")
    rounds: list[DataFrame] = []
    while True:
        blocks = nodes.withColumn("block", F.floor(F.col("idx") / BLOCK))
        rounds.append(kept_table(blocks.groupBy("name", "block").applyInArrow(_build, schema), f"{name}-{len(rounds)}"))
        if most <= BLOCK:
            return rounds
        most, schema = -(-most // BLOCK), _SEGMENT
        nodes = rounds[-1].where(F.col("total") > BLOCK).select(
            "name", F.col("block").alias("idx"), F.ceil(F.col("total") / BLOCK).alias("total"), F.col("root").alias("digest"))


@dataclass
class Manifest:
    """The logs of the sources' trees and of the tree above them, by round, and the sources in its order (`tree`,
    `idx`, `subroot`)."""

    sources: list[DataFrame]
    order: DataFrame
    above: list[DataFrame]


def _tops(rounds: list[DataFrame]) -> DataFrame:
    found = None
    for segments in rounds:
        tops = segments.where(F.col("total") <= BLOCK).select("name", "root")
        found = tops if found is None else found.union(tops)
    return found


def manifest(docs: DataFrame) -> Manifest:
    """Write the logs of all documents."""
    leaves = leaves_of(docs).withColumn("tie", F.monotonically_increasing_id())
    numbered = in_order(kept_table(leaves, "merkle-leaves"), ["name"], ["doc_id", "leaf", "tie"], "merkle-order")
    sources = grow(numbered.select("name", "idx", "total", F.col("leaf").alias("digest"), "doc_id", "altered"), "merkle-log")
    subroots = _tops(sources).select(F.col("name").alias("tree"), F.col("root").alias("subroot"))
    placed = in_order(subroots, [], ["tree"], "merkle-sources")
    above = grow(placed.select(F.lit("").alias("name"), "idx", "total", F.col("subroot").alias("digest")), "merkle-above")
    return Manifest(sources, placed.select("tree", "idx", "subroot"), above)


_PATH = "array<struct<left: binary, right: binary>>"
_STEP = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))


def _below(rounds: list[DataFrame], roots: DataFrame, columns: list[str]) -> DataFrame:
    """The blocks of the first round with the siblings on their way up from the block's root (`path`) and the `columns`
    of their tree, which with its own `path` is a row of `roots`."""
    upper = None
    for segments in reversed(rounds):
        tops = segments.where(F.col("total") <= BLOCK).join(roots, "name")
        joined = tops if upper is None else tops.unionByName(
            segments.where(F.col("total") > BLOCK).join(upper, ["name", "block"]))
        if segments is rounds[0]:
            return joined
        upper = _inner_paths(joined, columns)
    raise ValueError("no rounds")


def _siblings(row: dict) -> tuple[list[list[tuple[bytes, bytes]]], list[tuple[bytes, bytes]]]:
    levels = levels_above(row["total"]) if row["total"] <= BLOCK else BLOCK_LEVELS
    return steps_of(row["log"], row["size"], levels), [(s["left"], s["right"]) for s in row["path"]]


def _way(own: list[list[tuple[bytes, bytes]]], above: list[tuple[bytes, bytes]], i: int) -> list[tuple[bytes, bytes]]:
    return [own[level][i // ARITY**level] for level in range(len(own))] + above


def _inner_paths(segments: DataFrame, columns: list[str]) -> DataFrame:
    """`name`, `block`, `path` of every node that these blocks were built over."""
    fields = [segments.schema[c] for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1).to_pylist()[0]
                own, above = _siblings(row)
                places = range(row["size"])
                paths = [[{"left": a, "right": b} for a, b in _way(own, above, i)] for i in places]
                arrays = [pa.array([row["name"]] * len(places), pa.string()),
                          pa.array([row["block"] * BLOCK + i for i in places], pa.int64()), pa.array(paths, _STEP)]
                arrays += [pa.array([row[c]] * len(places), batch.schema.field(c).type) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, names=["name", "block", "path", *columns])

    schema = f"name string, block long, path {_PATH}" + "".join(f", {f.name} {f.dataType.simpleString()}" for f in fields)
    return segments.select("name", "block", "total", "size", "log", "path", *columns).mapInArrow(run, schema)


def prove(logs: Manifest) -> DataFrame:
    """`doc_id`, `leaf`, `subroot`, `root`, `proof_sha256` of every document, and the root that the leaf found now, the
    altered one where there is one, folds to (`folded_root`, `verified`)."""
    start = _tops(logs.above).select("name", F.col("root").alias("top"), F.from_json(F.lit("[]"), _PATH).alias("path"))
    paths = _inner_paths(_below(logs.above, start, ["top"]), ["top"])
    roots = logs.order.join(paths.select(F.col("block").alias("idx"), "path", "top"), "idx").select(
        F.col("tree").alias("name"), "path", "top", "subroot")
    blocks = _below(logs.sources, kept_table(roots, "merkle-roots"), ["top", "subroot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1).to_pylist()[0]
                own, above = _siblings(row)
                total, levels = row["size"], len(own)
                rows = []
                for i, (name, altered) in enumerate(zip(row["doc_ids"], row["altered"], strict=True)):
                    place = position(0, i, total, levels) * _HEX
                    leaf = row["log"][place:place + _HEX]
                    way = _way(own, above, i)
                    proof = sha256(b"".join([side for step in way for side in step])).hexdigest()
                    folded = fold(leaf if altered is None else altered.encode(), way).decode()
                    rows.append((name, leaf.decode(), row["subroot"], row["top"], proof, folded, folded == row["top"]))
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return blocks.select("name", "block", "total", "size", "log", "path", "top", "subroot", "doc_ids", "altered").mapInArrow(run, schema)


def log_rows(logs: Manifest) -> DataFrame:
    """Every node of the sources' trees: `name`, `level`, `index`, its `position` in the source's whole postorder log,
    and its `digest`. Roots of blocks are written by their block alone, not again as leaves of the round above."""
    totals = logs.sources[0].select("name", F.col("total").alias("leaves")).distinct()
    found = None
    for turn, segments in enumerate(logs.sources):
        def run(batches: Iterator[pa.RecordBatch], base: int = turn * BLOCK_LEVELS) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    levels = levels_above(row["total"]) if row["total"] <= BLOCK else BLOCK_LEVELS
                    whole = levels_above(row["leaves"])
                    nodes = []
                    for level in range(0 if base == 0 else 1, levels + 1):
                        first = row["block"] * ARITY**(BLOCK_LEVELS - level)
                        for i in range(-(-row["size"] // ARITY**level)):
                            at = position(level, i, row["size"], levels) * _HEX
                            nodes.append((row["name"], base + level, first + i, position(base + level, first + i, row["leaves"], whole),
                                          row["log"][at:at + _HEX].decode()))
                    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
                    columns = zip(*nodes, strict=True) if nodes else [[]] * 5
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                                     names=["name", "level", "index", "position", "digest"])

        rows = segments.join(totals, "name").select("name", "block", "total", "size", "log", "leaves").mapInArrow(
            run, "name string, level int, index long, position long, digest string")
        found = rows if found is None else found.union(rows)
    return found
