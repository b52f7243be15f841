"""Correlations of hundreds of columns from blocked cross products.

One column expression a pair would make a plan of k x k / 2 aggregates. Here a task turns its rows into matrices: for each
pair of columns the number of rows that have both, both means over those rows, and the centred sums of squares and
products. Matrices of two tasks merge exactly like the moments of one column, so they are added up over a tree of `FAN`
tasks a node, block of columns by block of columns; no task ever holds more than `FAN` blocks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 64
FAN = 32
_PARTIAL = "a int, b int, part int, sums binary"


def pair_moments(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Six matrices (count, mean and centred sum of squares of the left column, the same of the right one, centred sum of
    products) over the rows where both columns have a value; NaN is none."""
    here, there = ~np.isnan(left), ~np.isnan(right)
    with np.errstate(invalid="ignore", divide="ignore"):
        shift_l, shift_r = (np.nan_to_num(np.where(m, v, 0).sum(0) / m.sum(0)) for v, m in ((left, here), (right, there)))
        x, y = np.where(here, left - shift_l, 0.0), np.where(there, right - shift_r, 0.0)
        m, n = here.astype(float), there.astype(float)
        count = m.T @ n
        mean_x, mean_y = np.nan_to_num(x.T @ n / count), np.nan_to_num(m.T @ y / count)
    square_x = (x * x).T @ n - count * mean_x**2
    square_y = m.T @ (y * y) - count * mean_y**2
    product = x.T @ y - count * mean_x * mean_y
    return np.stack([count, mean_x + shift_l[:, None], square_x, mean_y + shift_r[None, :], square_y, product])


def merged(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The matrices of two sets of rows as those of their union."""
    count = one[0] + two[0]
    with np.errstate(invalid="ignore", divide="ignore"):
        share, weight = np.nan_to_num(two[0] / count), np.nan_to_num(one[0] * two[0] / count)
    step_x, step_y = np.where(one[0] > 0, two[1] - one[1], 0.0), np.where(one[0] > 0, two[3] - one[3], 0.0)
    first = lambda k, step: np.where(one[0] > 0, one[k] + share * step, two[k])
    return np.stack([count, first(1, step_x), one[2] + two[2] + weight * step_x**2, first(3, step_y),
                     one[4] + two[4] + weight * step_y**2, one[5] + two[5] + weight * step_x * step_y])


def _partial(columns: Sequence[str], block: int):
    starts = list(range(0, len(columns), block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not len(batch):
                continue
            values = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(columns))], axis=1)
            for a in starts:
                for b in starts[a // block:]:
                    sums = pair_moments(values[:, a:a + block], values[:, b:b + block])
                    held[a, b] = merged(held[a, b], sums) if (a, b) in held else sums
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([
            pa.array([a // block for a, _ in held], pa.int32()), pa.array([b // block for _, b in held], pa.int32()),
            pa.array([task] * len(held), pa.int32()), pa.array([s.tobytes() for s in held.values()], pa.binary())],
            names=["a", "b", "part", "sums"])

    return run


def _merge(shape_of):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        a, b, part = (k.as_py() for k in key)
        total = None
        for sums in table.column("sums").to_pylist():
            sums = np.frombuffer(sums).reshape(6, *shape_of(a, b))
            total = sums if total is None else merged(total, sums)
        return pa.table([pa.array([a], pa.int32()), pa.array([b], pa.int32()), pa.array([part], pa.int32()),
                         pa.array([total.tobytes()], pa.binary())], names=["a", "b", "part", "sums"])

    return run


def corr_matrix_wide(frame: DataFrame, columns: Sequence[str], block: int = BLOCK) -> DataFrame:
    """(`a`, `b`, `n`, `corr`) of every ordered pair of numeric columns, over the `n` rows where neither is null or NaN;
    null for fewer than two such rows or a constant column."""
    names = list(columns)
    size = lambda k: min(block, len(names) - k * block)
    cells = frame.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    rows = cells.mapInArrow(_partial(names, block), _PARTIAL)
    parts = max(1, cells.rdd.getNumPartitions())
    while True:
        parts = -(-parts // FAN)
        rows = rows.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("a", "b", "part").applyInArrow(
            _merge(lambda a, b: (size(a), size(b))), _PARTIAL)
        if parts <= 1:
            break

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, sums in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "sums")), strict=True):
                count, _, square_x, _, square_y, product = np.frombuffer(sums).reshape(6, size(a), size(b))
                flat = (square_x > 0) & (square_y > 0) & (count > 1)
                with np.errstate(invalid="ignore", divide="ignore"):
                    corr = np.clip(product / np.sqrt(square_x * square_y), -1, 1)
                left = np.repeat(names[a * block:a * block + size(a)], size(b))
                right = np.tile(names[b * block:b * block + size(b)], size(a))
                for x, y in ((left, right),) if a == b else ((left, right), (right, left)):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(x.tolist(), pa.string()), pa.array(y.tolist(), pa.string()), pa.array(count.ravel().astype(np.int64)),
                        pa.array(corr.ravel(), pa.float64(), mask=~flat.ravel())], names=["a", "b", "n", "corr"])

    return rows.select("a", "b", "sums").mapInArrow(opened, "a string, b string, n long, corr double")
