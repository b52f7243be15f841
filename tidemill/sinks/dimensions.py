"""A dimension kept on files: a base snapshot plus one delta folder per batch.

A batch costs as much as the batch, not as much as the dimension: its own last images are written to
`delta/batch=N`, replacing themselves when the batch is repeated. A reader takes the last image per key over the
newest base and the deltas after it. `compact` folds them into the next base, every `compact_every` batches by the job
itself; nothing is ever read and overwritten at the same time. What the base before the newest covers is removed, so a
reader that took its folders before a compaction still finds them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemill.operators.changes import latest_images
from tidemill.sinks.writers import batch_folder, complete_batches, remove_batches


class DimensionFiles:
    """Files of one dimension. `order` must order a key's changes uniquely across batches."""

    def __init__(self, spark: SparkSession, path: str, key: str, order: Sequence[str], values: Sequence[str],
                 compact_every: int = 100):
        self.spark, self.path, self.key, self.every = spark, path, key, compact_every
        self.order, self.values = list(order), list(values)

    def upsert(self, changes: DataFrame, batch: int) -> None:
        """Store a batch of changes (`op`, key, values, order); usable as a stream's batch writer."""
        if self.every and batch and batch % self.every == 0:
            self.compact(batch - 1)
        last = latest_images(changes, self.key, self.order, self.values, keep_deleted=True)
        last.write.mode("overwrite").parquet(batch_folder(f"{self.path}/delta", batch))

    def current(self) -> DataFrame:
        """Live rows: (key, values..., order...)."""
        images = self._images()
        return latest_images(images, self.key, self.order, self.values)

    def compact(self, upto: int | None = None) -> int | None:
        """Fold all complete deltas, or those up to batch `upto`, into a new base; returns the last batch it covers."""
        bases = self._numbers("base")
        covered = max(bases, default=-1)
        batches = [n for n in self._numbers("delta") if n > covered and (upto is None or n <= upto)]
        if not batches:
            return covered if bases else None
        upto = max(batches)
        images = latest_images(self._images(upto), self.key, self.order, self.values, keep_deleted=True)
        images.write.mode("overwrite").parquet(batch_folder(f"{self.path}/base", upto))
        remove_batches(self.spark, f"{self.path}/delta", covered)
        remove_batches(self.spark, f"{self.path}/base", covered - 1)
        return upto

    def _images(self, upto: int | None = None) -> DataFrame:
        bases, deltas = self._numbers("base"), self._numbers("delta")
        covered = max(bases, default=-1)
        folders = [batch_folder(f"{self.path}/delta", n) for n in deltas if n > covered and (upto is None or n <= upto)]
        if bases:
            folders.append(batch_folder(f"{self.path}/base", covered))
        if not folders:
            raise FileNotFoundError(f"no images in {self.path}")
        return self.spark.read.parquet(*folders).select(self.key, "op", *self.values, *self.order)

    def _numbers(self, kind: str) -> list[int]:
        return complete_batches(self.spark, f"{self.path}/{kind}")
