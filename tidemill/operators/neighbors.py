"""Exact nearest neighbours without comparing all pairs across the cluster.

Space is cut into boxes of a bounded number of points (cuts come from a bounded sample, and boxes that turn out too
full are cut again). Each box finds its points' neighbours inside; a point whose search ball leaves its box then
asks the boxes the ball touches, and only those. The answers are merged per point. Copies of the same point are
folded into one position first, so a point that makes up a third of the data cannot fill a box.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.session import checkpoint_dir

# Points per box: at least BOX_POINTS, more once that would take over MAX_BOXES boxes (the cuts go to every task).
BOX_POINTS = 2_000
MAX_BOXES = 100_000
SAMPLE_POINTS = 200_000
_BLOCK_CELLS = 4_000_000


@dataclass
class Cuts:
    """A binary space partition: node i cuts `axis[i]` at `at[i]`; axis -1 marks a box."""

    axis: list[int] = field(default_factory=lambda: [-1])
    at: list[float] = field(default_factory=lambda: [0.0])
    low: list[int] = field(default_factory=lambda: [-1])

    def split(self, node: int, sample: np.ndarray, parts: int) -> None:
        """Cut a box into about `parts` boxes along the medians of a sample of its points."""
        if parts < 2 or len(sample) < 2:
            return
        axis = int(np.argmax(sample.max(axis=0) - sample.min(axis=0)))
        values = np.unique(sample[:, axis])
        if len(values) < 2:
            return
        at = float(max(np.median(sample[:, axis]), values[1]))
        below = sample[:, axis] < at
        first = len(self.axis)
        self.axis[node], self.at[node], self.low[node] = axis, at, first
        for _ in range(2):
            self.axis.append(-1), self.at.append(0.0), self.low.append(-1)
        self.split(first, sample[below], parts // 2)
        self.split(first + 1, sample[~below], parts - parts // 2)

    def boxes(self) -> int:
        return (len(self.axis) + 1) // 2

    def box_of(self, points: np.ndarray) -> np.ndarray:
        axis, at, low = np.array(self.axis), np.array(self.at), np.array(self.low)
        node = np.zeros(len(points), dtype=np.int64)
        while (inner := axis[node] >= 0).any():
            rows = np.nonzero(inner)[0]
            here = node[rows]
            node[rows] = low[here] + (points[rows, axis[here]] >= at[here])
        return node

    def touched(self, points: np.ndarray, radius: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(box, rows) for every box that the balls around the points may reach."""
        stack = [(0, np.arange(len(points)))]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            axis = self.axis[node]
            if axis < 0:
                yield node, rows
                continue
            x, r = points[rows, axis], radius[rows]
            stack.append((self.low[node], rows[x - r < self.at[node]]))
            stack.append((self.low[node] + 1, rows[x + r >= self.at[node]]))


def _closest(queries: np.ndarray, points: np.ndarray, k: int, own: np.ndarray | None = None,
             within: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, point row, squared distance) of each query's k closest points; points come in id order, which
    decides ties. `own` names the point to leave out, `within` the largest squared distance of interest."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    step = max(1, _BLOCK_CELLS // max(1, len(points)))
    for begin in range(0, len(queries), step):
        block = queries[begin:begin + step]
        distance = np.zeros((len(block), len(points)))
        for axis in range(points.shape[1]):
            gap = block[:, axis, None] - points[None, :, axis]
            distance += gap * gap
        if own is not None:
            distance[np.arange(len(block)), own[begin:begin + step]] = np.inf
        reach = np.partition(distance, min(k, len(points)) - 1, axis=1)[:, min(k, len(points)) - 1]
        if within is not None:
            reach = np.minimum(reach, within[begin:begin + step])
        rows, cols = np.nonzero((distance <= reach[:, None]) & np.isfinite(distance))
        value = distance[rows, cols]
        order = np.lexsort((cols, value, rows))
        rows, cols, value = rows[order], cols[order], value[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
        keep = rank < k
        found.append((rows[keep] + begin, cols[keep], value[keep]))
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=float)


def positions(rows: DataFrame, key: str, features: Sequence[str], k: int) -> DataFrame:
    """One row per distinct point: (`pos`: its smallest key, `x`: coordinates, `members`: its k + 1 smallest keys)."""
    order = Window.partitionBy(*features).orderBy(key)
    first = rows.select(key, *features).withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k + 1)
    return first.groupBy(*features).agg(F.min(key).alias("pos"), F.array_sort(F.collect_list(key)).alias("members")).select(
        "pos", F.array(*[F.col(f).cast("double") for f in features]).alias("x"), "members")


def _cut_space(points: DataFrame, box_points: int | None) -> tuple[Cuts, int]:
    """Cuts such that no box holds more than about four times `box_points` positions, and that number."""
    cuts, total = Cuts(), points.count()
    box_points = box_points or max(BOX_POINTS, total // MAX_BOXES)
    crowded = {0: total} if total > box_points else {}
    while crowded:
        boxes = [b for b in crowded]
        inside = points if boxes == [0] else _with_box(points, cuts).where(F.col("box").isin(boxes))
        share = min(1.0, SAMPLE_POINTS / sum(crowded.values()))
        sample = inside.sample(share, seed=7).select("x").limit(2 * SAMPLE_POINTS).toPandas()
        known = _matrix(sample["x"]) if len(sample) else np.empty((0, 1))
        owner = cuts.box_of(known) if len(known) else np.empty(0, dtype=int)
        before = len(cuts.axis)
        for box in boxes:
            cuts.split(box, known[owner == box], -(-crowded[box] // box_points))
        if len(cuts.axis) == before:
            break
        sizes = _with_box(points, cuts).groupBy("box").count().where(F.col("count") > 4 * box_points)
        crowded = {row["box"]: row["count"] for row in sizes.collect()}
    return cuts, box_points


def _with_box(points: DataFrame, cuts: Cuts) -> DataFrame:
    @F.pandas_udf(T.LongType())
    def box(x: pd.Series) -> pd.Series:
        return pd.Series(cuts.box_of(_matrix(x)) if len(x) else [], dtype="int64")

    return points.withColumn("box", box("x"))


def nearest_positions(points: DataFrame, k: int, box_points: int | None = None) -> DataFrame:
    """(`pos`, `near`, `d2`): each position's k nearest other positions by squared distance, ties by `pos`."""
    checkpoint_dir(points.sparkSession)
    cuts, box_points = _cut_space(points, box_points)
    # One task per box up to the cluster's size, whatever the few bytes of a box suggest to the adaptive planner.
    tasks = min(cuts.boxes(), max(points.sparkSession.sparkContext.defaultParallelism,
                                  int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    # Read several times below, and dear to compute again: kept as checkpoints in the shared folder.
    boxed = _with_box(points.select("pos", "x"), cuts).repartition(tasks, "box").checkpoint()
    answer = "pos long, near long, d2 double"

    def inside(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pos", ignore_index=True)
        x, pos = _matrix(group["x"]), group["pos"].to_numpy()
        rows, cols, d2 = _closest(x, x, k, own=np.arange(len(x)))
        return pd.DataFrame({"pos": pos[rows], "near": pos[cols], "d2": d2})

    local = boxed.repartition(tasks, "box").groupBy("box").applyInPandas(inside, answer).checkpoint()
    if cuts.boxes() == 1:
        return local
    reach = local.groupBy("pos").agg(F.count("*").alias("n"), F.max("d2").alias("d2"))
    reach = reach.select("pos", F.when(F.col("n") >= k, F.col("d2")).alias("d2"))
    asking = boxed.join(reach, "pos", "left").select(
        "pos", "x", "box", F.coalesce("d2", F.lit(float("inf"))).alias("d2"))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, home = _matrix(batch["x"]), batch["box"].to_numpy()
            radius = np.sqrt(batch["d2"].to_numpy()) * (1 + 1e-9)
            for box, rows in cuts.touched(x, radius):
                rows = rows[home[rows] != box]
                if len(rows):
                    yield batch.iloc[rows].assign(box=box)

    requests = asking.mapInPandas(ask, asking.schema)
    # A box that many points ask is answered in several parts, each with a copy of the box's points.
    sizes = requests.groupBy("box").agg(F.ceil(F.count("*") / F.lit(4 * box_points)).cast("int").alias("parts"))
    requests = requests.join(F.broadcast(sizes), "box")  # one row per box
    requests = requests.select("pos", "x", "d2", "box", F.pmod(F.xxhash64("pos"), "parts").cast("int").alias("part"))
    held_parts = sizes.select("box", F.sequence(F.lit(0), F.col("parts") - 1).alias("held_parts"))
    copies = boxed.join(F.broadcast(held_parts), "box").select("pos", "x", "box", F.explode("held_parts").alias("part"))

    def reply(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"pos": [], "near": [], "d2": []}).astype({"pos": "int64", "near": "int64"})
        held = held.sort_values("pos", ignore_index=True)
        rows, cols, d2 = _closest(_matrix(asked["x"]), _matrix(held["x"]), k, within=asked["d2"].to_numpy())
        return pd.DataFrame({"pos": asked["pos"].to_numpy()[rows], "near": held["pos"].to_numpy()[cols], "d2": d2})

    asked = requests.repartition(tasks, "box", "part").groupBy("box", "part")
    others = asked.cogroup(copies.repartition(tasks, "box", "part").groupBy("box", "part")).applyInPandas(reply, answer)
    rank = F.row_number().over(Window.partitionBy("pos").orderBy("d2", "near"))
    return local.unionByName(others).withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")
