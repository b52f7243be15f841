"""The new-visitor repair over many micro-batches, with one row a device between them.

A micro-batch is first reduced to one row a device, by aggregates that combine before the shuffle: its first claim, its
first and last record without a claim, the first such record after the first claim. That row and the device's
remembered day give both the day to remember next and what is needed to judge every record of the batch, so a device
with a third of all records costs one row like any other; its records take the day by `join_state`.

Remembered days lie in folders of one batch each; a repeated batch reads only those before it and replaces its own.
`compact` folds them into one base folder; the job calls it every `compact_every` batches. With a time to live a day is
forgotten that long after it was last written, by the clock of the batch, which is stored before anything else so that a
repeated batch runs at the same time.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.dates import SHOP_ZONE, ts_to_day
from tidemill.operators.skew import HOT_ROWS, join_state
from tidemill.operators.visitors import BEFORE_ALL, MODES, place_number
from tidemill.sinks.writers import BatchWriter, batch_folder, complete_batches, remove_batches

_STATE = "mid string, day int, written bigint, batch int"


class VisitorDays:
    """Batch writer of log records (`mid`, `is_new`, `ts`, the columns of `order`, any others); `sink` gets them with the
    repaired flag. `order` is `ts` alone or with one whole-number column that orders records of one millisecond."""

    def __init__(self, spark: SparkSession, path: str, sink: BatchWriter, order: Sequence[str] = ("ts",), mode: str = "as_written",
                 zone: str = SHOP_ZONE, ttl_ms: int | None = None, compact_every: int = 100,
                 clock: Callable[[], int] = lambda: int(time.time() * 1000), hot_rows: int = HOT_ROWS):
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        self.spark, self.path, self.sink, self.order, self.mode, self.zone = spark, path, sink, tuple(order), mode, zone
        self.ttl, self.every, self.clock, self.hot_rows = ttl_ms, compact_every, clock, hot_rows

    def __call__(self, batch: DataFrame, number: int) -> None:
        now = self._now(number)
        if self.every and number and number % self.every == 0:
            self.compact(number - 1, now)
        held = batch.persist()
        try:
            steps = self.transitions(held, number, now).persist()
            try:
                self.sink(self._repaired(held, steps), number)
                steps.where("moved").select("mid", "day", F.lit(now).alias("written"), F.lit(number).alias("batch")).write.mode(
                    "overwrite").parquet(batch_folder(f"{self.path}/day", number))
            finally:
                steps.unpersist()
        finally:
            held.unpersist()

    def days(self, before: int | None = None, now: int | None = None) -> DataFrame:
        """`mid`, `day`, `written`, `batch` of every device, as of the last batch or the last one before `before`, without
        those whose time to live is over at `now`."""
        bases = [n for n in complete_batches(self.spark, f"{self.path}/base") if before is None or n < before]
        base = max(bases, default=-1)
        folders = [batch_folder(f"{self.path}/base", base)] if bases else []
        folders += [batch_folder(f"{self.path}/day", n) for n in complete_batches(self.spark, f"{self.path}/day")
                    if n > base and (before is None or n < before)]
        if not folders:
            return self.spark.createDataFrame([], _STATE)
        rows = self.spark.read.schema(_STATE).parquet(*folders)
        last = rows.groupBy("mid").agg(F.max_by("day", "batch").alias("day"), F.max_by("written", "batch").alias("written"),
                                       F.max("batch").alias("batch"))
        return last if self.ttl is None or now is None else last.where(F.col("written") + self.ttl > now)

    def compact(self, upto: int, now: int | None = None) -> None:
        if upto not in complete_batches(self.spark, f"{self.path}/base"):
            self.days(upto + 1, now).write.mode("overwrite").parquet(batch_folder(f"{self.path}/base", upto))
        remove_batches(self.spark, f"{self.path}/day", upto)
        remove_batches(self.spark, f"{self.path}/base", upto - 1)

    def transitions(self, batch: DataFrame, number: int, now: int) -> DataFrame:
        """One row a device of the batch: `records`, the day that holds at its start (`opened_day`, from the place
        `opened` on), the place from which every claim is refuted (`closed`), the next `day` and whether it was written
        (`moved`)."""
        narrow = batch.select("mid", self._claim().alias("claim"), place_number(self.order).alias("place"), self._day().alias("day"))
        if self.mode == "as_documented":
            first = F.when(F.col("claim"), F.col("day")).otherwise(F.col("day") - 1)
            seen = narrow.groupBy("mid").agg(F.count("*").alias("records"), F.min_by(first, "place").alias("first_day"))
            known = self._with_days(seen, number, now)
            day = F.coalesce("remembered", "first_day")
            return known.select("mid", "records", F.lit(BEFORE_ALL).cast("decimal(38,0)").alias("opened"), day.alias("opened_day"),
                                F.lit(None).cast("decimal(38,0)").alias("closed"), day.alias("day"), F.col("remembered").isNull().alias("moved"))
        own, other = F.when(F.col("claim"), F.col("place")), F.when(~F.col("claim"), F.col("place"))
        seen = narrow.groupBy("mid").agg(
            F.count("*").alias("records"), F.min(own).alias("claimed"), F.min_by(F.when(F.col("claim"), F.col("day")), own).alias("claimed_day"),
            F.min(other).alias("first_other"), F.max(other).alias("last_other"),
            F.max_by(F.when(~F.col("claim"), F.col("day")), other).alias("last_day"))
        known = self._with_days(seen, number, now)
        opened = F.when(F.col("remembered").isNotNull(), F.lit(BEFORE_ALL).cast("decimal(38,0)")).otherwise(F.col("claimed"))
        known = known.withColumn("opened", opened).withColumn("opened_day", F.coalesce("remembered", "claimed_day"))
        # A device without a day that starts with other records needs one more look for the first of them after its claim.
        between = known.where("first_other < opened AND last_other > opened").select("mid", "records", "opened")
        later = join_state(narrow.where(~F.col("claim")).select("mid", "place"), between, "mid", "records", self.hot_rows)
        later = later.where("place > opened").groupBy("mid").agg(F.min("place").alias("next_other"))
        moved = F.coalesce(F.col("last_other") > F.col("opened"), F.lit(False))
        closed = F.when(F.col("first_other") > F.col("opened"), F.col("first_other")).otherwise(F.col("next_other"))
        return known.join(later, "mid", "left").select(
            "mid", "records", "opened", "opened_day", closed.alias("closed"),
            F.when(moved, F.col("last_day") - 1).otherwise(F.col("opened_day")).alias("day"),
            (F.col("opened").isNotNull() & (moved | F.col("remembered").isNull())).alias("moved"))

    def _with_days(self, seen: DataFrame, number: int, now: int) -> DataFrame:
        """Devices of the batch with their remembered day; both sides have one row a device."""
        return seen.join(self.days(number, now).select("mid", F.col("day").alias("remembered")), "mid", "left")

    def _repaired(self, batch: DataFrame, steps: DataFrame) -> DataFrame:
        state = steps.select("mid", "records", F.col("opened").alias("_opened"), F.col("opened_day").alias("_day"), F.col("closed").alias("_closed"))
        joined = join_state(batch, state, "mid", "records", self.hot_rows)
        place = place_number(self.order)
        refuted = self._claim() & F.coalesce(place > F.col("_opened"), F.lit(False)) & (
            (self._day() != F.col("_day")) | F.coalesce(place > F.col("_closed"), F.lit(False)))
        return joined.withColumn("is_new", F.when(refuted, "0").otherwise(F.col("is_new"))).select(*batch.columns)

    def _claim(self) -> Column:
        return F.coalesce(F.col("is_new") == "1", F.lit(False))

    def _day(self) -> Column:
        return F.unix_date(ts_to_day("ts", self.zone))

    def _now(self, number: int) -> int:
        """The batch's clock: the stored one when the batch is repeated."""
        folder = f"{self.path}/clock"
        if number not in complete_batches(self.spark, folder):
            self.spark.range(1).select(F.lit(self.clock()).cast("bigint").alias("now")).write.mode("overwrite").parquet(batch_folder(folder, number))
            remove_batches(self.spark, folder, number - 2)
        return self.spark.read.schema("now bigint").parquet(batch_folder(folder, number)).first()["now"]
