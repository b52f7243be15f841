"""Nearest neighbours by largest inner product, over few stable projections indexed by a kd-tree.

The largest inner product is made a least distance first: each vector gets one more component, the root of what its
squared norm lacks to the largest one, queries get a zero there. `SIZE` Gaussian projections then turn a distance d
into a projected distance whose square is d^2 times a chi-square variable of `SIZE` degrees. A kd-tree over the
projections cuts space into cells (one task's work each) and every cell into leaves. A query visits leaves in the order
of their projected distance and compares the true vectors there, until the test holds: a neighbour nearer than the
k-th found would, with probability `SURE`, have been projected nearer than the next leaf. The first visit is to the
query's own cell; the k-th score found there is what other cells have to beat, and cells that fail the same test are
not asked at all.

The tree is fitted on at most `SAMPLE` rows (by a hash of the id); every row is indexed. A cell that holds more than
`CELL` rows, of equal vectors for example, is cut into blocks by a hash of the id and asked block by block. No task holds
more than a block and a few hundred queries.

Cases: vectors that are null, zero, or hold a null or non-finite component take no part, neither do vectors of another
than the most frequent length; a query finds every other row if there are fewer than k; rows with the query's own id
are never its neighbours, other repeated rows are neighbours of their own; equal scores go to the smaller id, among
equal vectors always, since only the rows of their k + 1 smallest ids are searched; rows without an id take no part. An
empty table, or one without a usable vector, gives no rows. Columns other than `vec_id` and `embedding` are not read, so they may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import kept_table, shuffle_partitions

SIZE = 8
SURE = 0.95
SAMPLE, CELL, LEAF = 65_536, 20_000, 256
ROUTED = "block long, role int, id long, vec binary, bound double"


def chi_square(x: np.ndarray, degrees: int) -> np.ndarray:
    """Distribution function for an even number of degrees."""
    half = np.minimum(np.asarray(x, dtype=np.float64) / 2, 700)
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, degrees // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


@dataclass
class Tree:
    """Median cuts, level by level: node i cuts `axis[i]` at `cut[i]`; its children are 2i + 1 and 2i + 2."""

    axis: np.ndarray
    cut: np.ndarray
    depth: int

    @staticmethod
    def fit(points: np.ndarray, depth: int) -> Tree:
        axis, cut = np.zeros((1 << depth) - 1, np.int64), np.zeros((1 << depth) - 1)
        held = {0: points}
        for node in range(len(axis)):
            own = held.pop(node)
            if len(own):
                axis[node] = int(np.argmax(own.var(axis=0)))
                cut[node] = float(np.median(own[:, axis[node]]))
            right = own[:, axis[node]] > cut[node]
            held[2 * node + 1], held[2 * node + 2] = own[~right], own[right]
        return Tree(axis, cut, depth)

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        for _ in range(self.depth):
            right = points[np.arange(len(points)), self.axis[node]] > self.cut[node]
            node = 2 * node + 1 + right
        return node - ((1 << self.depth) - 1)


class Block:
    """The vectors of one block, in leaves of at most `LEAF` rows with their boxes in the projection."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projected: np.ndarray):
        order, self.starts = [], [0]
        stack = [np.arange(len(ids))]
        while stack:
            rows = stack.pop()
            if len(rows) > LEAF:
                axis = int(np.argmax(projected[rows].var(axis=0)))
                rows = rows[np.argsort(projected[rows, axis], kind="stable")]
                stack += [rows[:len(rows) // 2], rows[len(rows) // 2:]]
            elif len(rows):
                order.append(rows)
                self.starts.append(self.starts[-1] + len(rows))
        whole = np.concatenate(order) if order else np.zeros(0, np.int64)
        self.ids, self.vectors = ids[whole], vectors[whole]
        self.low = np.array([projected[r].min(axis=0) for r in order])
        self.high = np.array([projected[r].max(axis=0) for r in order])

    def search(self, ids: np.ndarray, queries: np.ndarray, projected: np.ndarray, bounds: np.ndarray, room: np.ndarray,
               k: int) -> tuple[np.ndarray, np.ndarray]:
        """Best k scores and places in the block of each query (-inf and -1 where there are fewer).

        room: square of the largest norm plus the query's own squared norm, so that d^2 = room - 2 * score.
        """
        n = len(ids)
        best, place = np.full((n, k), -np.inf), np.full((n, k), -1, dtype=np.int64)
        outside = np.maximum(np.maximum(self.low[None] - projected[:, None], projected[:, None] - self.high[None]), 0)
        far = (outside ** 2).sum(axis=2)
        order = np.argsort(far, axis=1, kind="stable")
        open_rows = np.arange(n)
        for turn in range(order.shape[1]):
            leaf = order[open_rows, turn]
            least = np.maximum(best[open_rows].min(axis=1), bounds[open_rows])
            with np.errstate(invalid="ignore"):
                distance = np.maximum(room[open_rows] - 2 * least, 1e-300)
                ratio = np.where(np.isfinite(distance), far[open_rows, leaf] / distance, 0.0)
            going = chi_square(ratio, SIZE) < SURE
            open_rows, leaf = open_rows[going], leaf[going]
            if not len(open_rows):
                break
            by_leaf = np.argsort(leaf, kind="stable")
            edges = np.flatnonzero(np.r_[True, np.diff(leaf[by_leaf]) != 0])
            for begin, end in zip(edges, np.r_[edges[1:], len(by_leaf)]):
                rows = open_rows[by_leaf[begin:end]]
                first, last = self.starts[leaf[by_leaf[begin]]], self.starts[leaf[by_leaf[begin]] + 1]
                scores = queries[rows] @ self.vectors[first:last].T
                scores[self.ids[None, first:last] == ids[rows, None]] = -np.inf
                # One more than k is kept in mind below by the exact order; here the best k by the quick product.
                every = np.concatenate([best[rows], scores], axis=1)
                where = np.concatenate([place[rows], np.broadcast_to(np.arange(first, last), scores.shape)], axis=1)
                kept = np.argpartition(-every, k - 1, axis=1)[:, :k]
                best[rows] = np.take_along_axis(every, kept, axis=1)
                place[rows] = np.take_along_axis(where, kept, axis=1)
        place[np.isneginf(best)] = -1
        return best, place


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row by row in double precision, component after component: equal vectors always have equal scores."""
    total = np.zeros(len(left))
    for i in range(left.shape[1]):
        total += left[:, i] * right[:, i]
    return total


@dataclass
class Index:
    """What every task needs: the tree, the projections, the largest squared norm, and each cell's box and blocks."""

    tree: Tree
    matrix: np.ndarray
    largest: float
    low: np.ndarray
    high: np.ndarray
    blocks: np.ndarray

    def project(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        flat = vectors @ self.matrix[:-1]
        if query:
            return flat
        lacking = np.sqrt(np.maximum(self.largest - (vectors ** 2).sum(axis=1), 0))
        return flat + lacking[:, None] * self.matrix[-1]


def usable(rows: DataFrame) -> DataFrame:
    """`vec_id`, `vec` (doubles as bytes), `norm` (squared) of the vectors that take part, whatever their length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vecs, norms = [], [], []
            for name, values in zip(batch.column("vec_id").to_pylist(), batch.column("embedding"), strict=True):
                if name is None or not values.is_valid or not len(values.values) or values.values.null_count:
                    continue
                vector = np.asarray(values.values, dtype=np.float64)
                norm = float((vector ** 2).sum())
                if math.isfinite(norm) and vector.any():
                    ids.append(name)
                    vecs.append(vector.tobytes())
                    norms.append(norm)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vecs, pa.binary()), pa.array(norms, pa.float64())],
                                             names=["vec_id", "vec", "norm"])

    plain = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return plain.mapInArrow(run, "vec_id long, vec binary, norm double")


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype=np.float64).reshape(len(rows), -1)


def _placed(rows: DataFrame, index: Index, query: bool) -> DataFrame:
    """`cell`, projected coordinates and the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            points = index.project(_matrix(batch.column("vec")), query)
            yield pa.RecordBatch.from_arrays(
                [pa.array(index.tree.cell(points)), pa.array(list(points), pa.list_(pa.float64())), *batch.columns],
                names=["cell", "point", *batch.schema.names])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"cell long, point array<double>, {fields}")


def _searched(base: DataFrame, asked: DataFrame, index: Index, k: int) -> DataFrame:
    """`query_id`, `vec_id`, `score`: at most k of each query and block. base, asked: rows as in `ROUTED`."""
    both = base.union(asked)
    dealt = both.repartition(shuffle_partitions(both.sparkSession), "block").sortWithinPartitions("block", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, block = None, [], None
        for batch in batches:
            names = np.asarray(batch.column("block"))
            roles = np.asarray(batch.column("role"))
            for at in _runs(names, roles):
                part = batch.slice(at[0], at[1] - at[0])
                if names[at[0]] != current:
                    current, held, block = names[at[0]], [], None
                ids, vectors = np.asarray(part.column("id")), _matrix(part.column("vec"))
                if roles[at[0]] == 0:
                    held.append((ids, vectors))
                    continue
                if block is None and held:
                    ids0, vectors0 = (np.concatenate(x) for x in zip(*held))
                    block, held = Block(ids0, vectors0, index.project(vectors0, False)), []
                if block is not None:
                    yield _answers(block, ids, vectors, np.asarray(part.column("bound")), index, k)

    return dealt.mapInArrow(run, "query_id long, vec_id long, score double")


def _runs(names: np.ndarray, roles: np.ndarray, most: int = 512) -> Iterator[tuple[int, int]]:
    """Stretches of one block and role; queries in portions of `most`."""
    if not len(names):
        return
    edges = np.flatnonzero(np.r_[True, (np.diff(names) != 0) | (np.diff(roles) != 0)])
    for begin, end in zip(edges, np.r_[edges[1:], len(names)]):
        step = most if roles[begin] else end - begin
        for at in range(begin, end, step):
            yield at, min(at + step, end)


def _answers(block: Block, ids, queries, bounds, index: Index, k: int) -> pa.RecordBatch:
    projected = index.project(queries, True)
    room = index.largest + (queries ** 2).sum(axis=1)
    # A little more than k, so that equal scores at the end can be put in order exactly.
    _, place = block.search(ids, queries, projected, bounds, room, k + 12)
    row, column = np.nonzero(place >= 0)
    at = place[row, column]
    scores = inner_products(queries[row], block.vectors[at])
    order = np.lexsort((block.ids[at], -scores, row))
    row, at, scores = row[order], at[order], scores[order]
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, np.int64)
    rank = np.arange(len(row)) - np.repeat(first, np.diff(np.r_[first, len(row)]))
    good = (rank < k) & (scores >= bounds[row])
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[row[good]]), pa.array(block.ids[at[good]]), pa.array(scores[good])], names=["query_id", "vec_id", "score"])


def least_copies(rows: DataFrame, k: int) -> DataFrame:
    """Of equal vectors the rows of the k + 1 smallest ids, at most k of one id: no query can have another of them among
    its k nearest, since at most one id is its own. Copies are counted, and groups cut, before they meet in a task."""
    counted = rows.groupBy("vec", "norm", "vec_id").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    few = counted.withColumn("place", place).where(F.col("place") <= k + 1)
    return few.select("vec_id", "vec", "norm", F.explode(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k).cast("long")))).alias("copy")).drop("copy")


def nearest(rows: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`. rows, queries: `vec_id`, `embedding`."""
    spark = rows.sparkSession
    base, asked = kept_table(least_copies(usable(rows), k), "ann-rows"), kept_table(usable(queries), "ann-queries")
    sizes = base.groupBy(F.octet_length("vec").alias("size")).agg(F.count("*").alias("n"), F.max("norm").alias("norm"))
    common = sizes.orderBy(F.desc("n"), "size").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    base, asked = (x.where(F.octet_length("vec") == common["size"]) for x in (base, asked))
    matrix = np.random.default_rng(3).normal(size=(common["size"] // 8 + 1, SIZE))
    depth = max(0, min(math.ceil(math.log2(max(1, common["n"] / CELL))), int(math.log2(SAMPLE)) - 4))
    index = Index(Tree(np.zeros(0, np.int64), np.zeros(0), 0), matrix, common["norm"], np.zeros(0), np.zeros(0), np.zeros(0))
    sample = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(SAMPLE, 64 << depth))
    points = [r["point"] for r in _placed(sample.select("vec"), index, False).select("point").collect()] if depth else []
    index.tree = Tree.fit(np.array(points).reshape(-1, SIZE), depth)
    placed = kept_table(_placed(base.select("vec_id", "vec"), index, False), "ann-cells")
    ends = [f(F.col("point")[i]).alias(f"{name}{i}") for i in range(SIZE) for name, f in (("low", F.min), ("high", F.max))]
    cells = {r["cell"]: r for r in placed.groupBy("cell").agg(F.count("*").alias("n"), *ends).collect()}
    count = 1 << depth
    index.low = np.array([[cells[c][f"low{i}"] if c in cells else np.inf for i in range(SIZE)] for c in range(count)])
    index.high = np.array([[cells[c][f"high{i}"] if c in cells else -np.inf for i in range(SIZE)] for c in range(count)])
    index.blocks = np.array([-(-cells[c]["n"] // CELL) if c in cells else 0 for c in range(count)], dtype=np.int64)
    shared = spark.sparkContext.broadcast(index)
    blocks = F.get(F.array(*[F.lit(int(b)) for b in np.maximum(index.blocks, 1)]), F.col("cell").cast("int")) if count <= 4096 else None
    if blocks is None:
        known = spark.createDataFrame([(c, int(max(1, b))) for c, b in enumerate(index.blocks)], "cell long, blocks int")
        placed, blocks = placed.join(F.broadcast(known), "cell"), F.col("blocks")
    block = (F.col("cell") * 2**20 + F.pmod(F.xxhash64("vec_id"), blocks)).alias("block")
    stored = placed.select(block, F.lit(0).alias("role"), F.col("vec_id").alias("id"), "vec", F.lit(0.0).alias("bound"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The query's own cell (its first block) while it has no bound, then every block that may hold better."""
        index = shared.value
        for batch in batches:
            if not len(batch):
                continue
            vectors = _matrix(batch.column("vec"))
            points, bounds = index.project(vectors, True), np.asarray(batch.column("bound"))
            outside = np.maximum(np.maximum(index.low[None] - points[:, None], points[:, None] - index.high[None]), 0)
            far = (outside ** 2).sum(axis=2)
            home = np.argmin(np.where(index.blocks[None] > 0, far, np.inf), axis=1)
            fresh = np.asarray(batch.column("fresh"))
            room = index.largest + (vectors ** 2).sum(axis=1)
            distance = np.maximum(room - 2 * np.where(np.isfinite(bounds), bounds, 0), 1e-300)
            open_cell = chi_square(far / distance[:, None], SIZE) < SURE
            open_cell |= ~np.isfinite(bounds)[:, None]
            open_cell &= (index.blocks > 0)[None]
            picked, targets = [], []
            for i in range(len(batch)):
                own = int(home[i]) * 2**20
                if fresh[i]:
                    found = [own]
                else:
                    found = [int(c) * 2**20 + b for c in np.flatnonzero(open_cell[i]) for b in range(index.blocks[c])]
                    found = [f for f in found if f != own]
                picked += [i] * len(found)
                targets += found
            yield pa.RecordBatch.from_arrays(
                [pa.array(targets, pa.int64()), pa.array([1] * len(picked), pa.int32()),
                 batch.column("vec_id").take(pa.array(picked, pa.int64())), batch.column("vec").take(pa.array(picked, pa.int64())),
                 batch.column("bound").take(pa.array(picked, pa.int64()))], names=["block", "role", "id", "vec", "bound"])

    nothing = F.lit(float("-inf"))
    once = asked.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    start = once.select("vec_id", "vec", nothing.alias("bound"), F.lit(True).alias("fresh"))
    first = kept_table(_searched(stored, start.mapInArrow(route, ROUTED), index, k), "ann-first")
    reached = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    bound = F.when(F.col("n") >= k, F.col("least")).otherwise(nothing)
    more = once.join(reached, F.col("vec_id") == F.col("query_id"), "left").select(
        "vec_id", "vec", F.coalesce(bound, nothing).alias("bound"), F.lit(False).alias("fresh"))
    second = _searched(stored, more.mapInArrow(route, ROUTED), index, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = first.union(second).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
