"""Pack documents' token ids into windows of fixed length, almost without padding.

What remains of each document after its whole windows is a piece of 1 to window - 1 ids. Piece lengths are rounded up
to a coarse grid; every combination of at most `DEPTH` grid lengths that fills a window is a column of a matrix, and
non-negative least squares finds how often to repeat each so that the combinations use up the histogram of lengths.
Repeat counts are rounded down. The pieces left over are packed greedily, longest first: they are cut to fill the
small gaps that rounding the lengths has left, and then fill windows of their own one behind the other.

The driver sees the histogram only (one count for each length below the window). A document finds its place from its
rank among the pieces of its length: a count within its partition plus an offset for (partition, length), so that no
task gathers the documents of a frequent length. Ids move once, for the join with those offsets.

Cases: a null text reads as empty; an empty document is its end id; repeated rows are packed as often as they occur; an
empty table gives an empty result. Only `doc_id` and `text` are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.bpe_units import unit_encoder
from tidemill.llm.common import documents_of, kept_table

END = 2
WINDOW = 4096
GRID = 64
DEPTH = 4
PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def combinations(slots: int, depth: int) -> list[tuple[int, ...]]:
    """Descending grid lengths, at most `depth`, that add up to `slots`."""
    found: list[tuple[int, ...]] = []

    def grow(taken: tuple[int, ...], left: int) -> None:
        if left == 0:
            found.append(taken)
        elif len(taken) < depth:
            for size in range(min(left, taken[-1] if taken else slots), 0, -1):
                if size * (depth - len(taken)) < left:
                    break
                grow((*taken, size), left - size)

    grow((), slots)
    return found


def nonnegative_least_squares(matrix: np.ndarray, target: np.ndarray, rounds: int = 500) -> np.ndarray:
    """x >= 0 that brings matrix @ x closest to target: columns enter one at a time by their gradient and leave when
    they would turn negative."""
    columns = matrix.shape[1]
    x, active = np.zeros(columns), np.zeros(columns, dtype=bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(rounds):
        gradient = matrix.T @ (target - matrix @ x)
        gradient[active] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= tolerance:
            break
        active[best] = True
        while True:
            inside = np.flatnonzero(active)
            solved = np.linalg.lstsq(matrix[:, inside], target, rcond=None)[0]
            if (solved > 0).all():
                x[:] = 0
                x[inside] = solved
                break
            low = solved <= 0
            step = np.min(x[inside][low] / np.maximum(x[inside][low] - solved[low], 1e-300))
            x[inside] += step * (solved - x[inside])
            active[inside[(x[inside] <= tolerance) | (low & (x[inside] <= x[inside][low].min()))]] = False
            x[~active] = 0
            if not active.any():
                break
    return x


@dataclass
class Plan:
    """Where the piece of a given length and rank goes. Rows ascend by (length, first rank).

    length, low: the row's length and its first rank; place >= 0: sequence of that rank (each further rank goes one
    sequence on) at `offset`; place < 0: the piece is filler, its ids begin at `stream` + (rank - low) * length.
    Filler flows through gaps: gap_start (of the first of equal gaps), gap_size, gap_sequence, gap_offset.
    """

    length: np.ndarray
    low: np.ndarray
    place: np.ndarray
    offset: np.ndarray
    stream: np.ndarray
    gap_start: np.ndarray
    gap_size: np.ndarray
    gap_sequence: np.ndarray
    gap_offset: np.ndarray

    def pieces(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(begin in the piece, ids, sequence, offset) of each cut."""
        row = int(np.searchsorted(self.length * 2**40 + self.low, length * 2**40 + rank, side="right")) - 1
        ahead = rank - int(self.low[row])
        if self.place[row] >= 0:
            return [(0, length, int(self.place[row]) + ahead, int(self.offset[row]))]
        position, done, cuts = int(self.stream[row]) + ahead * length, 0, []
        while done < length:
            gap = int(np.searchsorted(self.gap_start, position, side="right")) - 1
            number, inside = divmod(position - int(self.gap_start[gap]), int(self.gap_size[gap]))
            take = min(length - done, int(self.gap_size[gap]) - inside)
            cuts.append((done, take, int(self.gap_sequence[gap]) + number, int(self.gap_offset[gap]) + inside))
            done, position = done + take, position + take
        return cuts


def plan_windows(histogram: dict[int, int], window: int = WINDOW, grid: int = GRID, depth: int = DEPTH) -> Plan:
    """histogram: pieces of each length below the window. Bounded by the window, whatever the number of documents."""
    slots = window // grid
    held = np.zeros(slots + 1)
    for length, count in histogram.items():
        held[-(-length // grid)] += count
    columns = combinations(slots, depth)
    matrix = np.zeros((slots + 1, len(columns)))
    for k, sizes in enumerate(columns):
        np.add.at(matrix[:, k], list(sizes), 1)
    wanted = nonnegative_least_squares(matrix, held)
    rows, gaps, left, sequences = [], [], {}, 0
    for share in (1.0, 0.97, 0.94, 0.9, 0.8, 0.6, 0.3, 0.0):
        rows, gaps, left, sequences = _realise(histogram, columns, np.floor(wanted * share + 1e-6), window, grid)
        if sum(k * n for k, (_, n) in left.items()) >= sum(size * n for size, n, _, _ in gaps):
            break
    stream = 0
    for length in sorted(left, reverse=True):
        low, count = left[length]
        if count:
            rows.append((length, low, -1, 0, stream))
            stream += length * count
    starts, position = [], 0
    for size, count, _, _ in gaps:
        starts.append(position)
        position += size * count
    gaps.append((window, 0, sequences, 0))
    starts.append(position)
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    gap = np.array(gaps, dtype=np.int64).T
    return Plan(*table, np.array(starts, dtype=np.int64), gap[0], gap[2], gap[3])


def _realise(histogram, columns, repeats, window, grid):
    """Turn grid combinations into rows of true lengths: within a grid length, the longest pieces go first."""
    runs: dict[int, list[list[int]]] = {}
    for length in sorted(histogram, reverse=True):
        runs.setdefault(-(-length // grid), []).append([length, 0, histogram[length]])
    have = {size: sum(r[2] for r in rs) for size, rs in runs.items()}
    rows, gaps, sequences = [], [], 0
    for k in np.argsort(-repeats, kind="stable"):
        sizes = columns[k]
        uses = {s: sizes.count(s) for s in sizes}
        left = int(min([repeats[k], *[have.get(s, 0) // n for s, n in uses.items()]]))
        if left <= 0:
            continue
        for s, n in uses.items():
            have[s] -= left * n
        while left:
            step = left
            for s, n in uses.items():
                step = min(step, max(1, next(r[2] for r in runs[s] if r[2]) // n))
            offset = 0
            for s in sizes:
                run = next(r for r in runs[s] if r[2])
                rows.append((run[0], run[1], sequences, offset, 0))
                run[1], run[2], offset = run[1] + step, run[2] - step, offset + run[0]
            if offset < window:
                gaps.append((window - offset, step, sequences, offset))
            sequences, left = sequences + step, left - step
    rest = {r[0]: (r[1], r[2]) for rs in runs.values() for r in rs if r[2]}
    return rows, gaps, rest, sequences


def encoded(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """`doc_id`, `ids` (unsigned 16-bit bytes with the end id), `rest` (ids after the whole windows), and where the
    document stands in its partition `part`: `rank` among those of the same `rest`, `windows` whole windows before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = unit_encoder(path, False), np.array([END], dtype="<u2").tobytes()
        part, whole, seen = TaskContext.get().partitionId(), 0, np.zeros(window, dtype=np.int64)
        for batch in batches:
            for at in range(0, len(batch), 500):
                few = batch.slice(at, 500)
                ids = [encoder.encode(t) + end for t in few.column("text").to_pylist()]
                rests, ranks, windows = [], [], []
                for row in ids:
                    full, rest = divmod(len(row) // 2, window)
                    rests.append(rest)
                    ranks.append(int(seen[rest]))
                    windows.append(whole)
                    seen[rest] += 1
                    whole += full
                yield pa.RecordBatch.from_arrays(
                    [few.column("doc_id"), pa.array(ids, pa.binary()), pa.array(rests, pa.int32()),
                     pa.array([part] * len(ids), pa.int32()), pa.array(ranks, pa.int64()), pa.array(windows, pa.int64())],
                    names=["doc_id", "ids", "rest", "part", "rank", "windows"])

    return documents_of(docs).mapInArrow(run, "doc_id long, ids binary, rest int, part int, rank long, windows long")


def pack(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """`doc_id`, `start`, `length`, `ids` (unsigned 32-bit bytes), `doc_tokens`, `sequence_id`, `offset` of each piece.

    Sequences of planned pieces are numbered from 0, those of whole windows from (partition + 1) * 2^40.
    """
    coded = kept_table(encoded(docs, path, window), "packing-ids")
    counts = coded.groupBy("part", "rest").agg(F.count("*").alias("n"))
    histogram = counts.where("rest > 0").groupBy("rest").agg(F.sum("n").alias("n")).collect()
    plan = docs.sparkSession.sparkContext.broadcast(plan_windows({r["rest"]: r["n"] for r in histogram}, window))
    ahead = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "rest", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    ranked = coded.join(before.hint("shuffle_hash"), ["part", "rest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                rows = []
                for r in batch.slice(at, 500).to_pylist():
                    ids = np.frombuffer(r["ids"], dtype="<u2").astype("<u4")
                    full = len(ids) // window
                    own = ((r["part"] + 1) << 40) + r["windows"]
                    cuts = [(i * window, window, own + i, 0) for i in range(full)]
                    if r["rest"]:
                        cuts += [(full * window + c[0], *c[1:])
                                 for c in plan.value.pieces(r["rest"], r["rank"] + r["before"])]
                    rows += [(r["doc_id"], b, n, ids[b:b + n].tobytes(), len(ids), s, o) for b, n, s, o in cuts]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return ranked.mapInArrow(run, PIECES)
