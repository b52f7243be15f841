"""Late records, told apart one by one.

Spark moves a watermark between micro-batches, so a record that is late within its batch still counts. Here every record
is held against the largest event time that arrived before it, in the order of its offset: it is late if its window
had ended by then. Late records go to an output of their own, so that kept and late records together are all records.

A running maximum needs no single task: offsets are cut into stretches of `STRETCH`, each stretch has its own maximum,
the maxima before each stretch are a running maximum over one row a stretch, and only the rest runs over the rows of a
stretch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.operators.keywords import WINDOW_MILLIS
from tidemill.sinks.writers import BatchWriter, batch_folder, complete_batches, remove_batches

STRETCH = 100_000
_LATEST = "latest bigint"


def earlier_maximum(rows: DataFrame, millis: str, offset: str, since: int | None = None, stretch: int = STRETCH) -> DataFrame:
    """Add `newest`, the largest `millis` of the rows of smaller `offset` (and `since`); `offset` is unique."""
    placed = rows.withColumn("_stretch", F.floor(F.col(offset) / stretch))
    tops = placed.groupBy("_stretch").agg(F.max(millis).alias("_top"))
    before = Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    start = F.lit(since).cast("bigint")
    tops = tops.select("_stretch", F.greatest(F.max("_top").over(before), start).alias("_before"))
    inside = Window.partitionBy("_stretch").orderBy(offset).rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(tops, "_stretch").select(*rows.columns, F.greatest(F.max(millis).over(inside), "_before").alias("newest"))


def window_end(millis: str, length: int = WINDOW_MILLIS) -> Column:
    """End of a row's tumbling window of so many milliseconds. (The window function would drop rows without a time.)"""
    return (F.floor(F.col(millis) / length) + 1) * length


def mark_late(rows: DataFrame, millis: str = "ts", offset: str = "offset", since: int | None = None,
              length: int = WINDOW_MILLIS) -> DataFrame:
    """Add `late`: the window of the row had ended, by the event times that arrived before it. A row without time is
    never late."""
    seen = earlier_maximum(rows, millis, offset, since)
    ended = F.coalesce(F.col("newest") >= window_end(millis, length), F.lit(False))
    return seen.withColumn("late", ended).drop("newest")


class LateStore:
    """Batch writer of rows with an event time and an offset: `kept` gets the rows in time, `late` the others. The largest
    event time is stored for each batch; a repeated batch reads that of the batch before it."""

    def __init__(self, spark: SparkSession, path: str, kept: BatchWriter, late: BatchWriter, millis: str = "ts",
                 offset: str = "offset", length: int = WINDOW_MILLIS):
        self.spark, self.path, self.kept, self.late = spark, path, kept, late
        self.millis, self.offset, self.length = millis, offset, length

    def __call__(self, batch: DataFrame, number: int) -> None:
        since = self._latest(number)
        held = mark_late(batch, self.millis, self.offset, since, self.length).persist()
        try:
            top = held.agg(F.greatest(F.max(self.millis), F.lit(since).cast("bigint")).alias("latest"))
            top.write.mode("overwrite").parquet(batch_folder(f"{self.path}/latest", number))
            self.kept(held.where(~F.col("late")).drop("late"), number)
            self.late(held.where("late").drop("late"), number)
        finally:
            held.unpersist()
        remove_batches(self.spark, f"{self.path}/latest", number - 2)

    def _latest(self, number: int) -> int | None:
        done = [n for n in complete_batches(self.spark, f"{self.path}/latest") if n < number]
        return self.spark.read.schema(_LATEST).parquet(batch_folder(f"{self.path}/latest", max(done))).first()["latest"] if done else None
