"""Routing by a configuration that comes as a stream itself.

Configuration and changes are one job, so that their order is fixed by micro-batches: a batch first applies its
configuration changes, then routes its changes, and with them those that waited for a table configured in it. What the
job has to remember lies in folders of its own, one for each batch, which a repeated batch replaces:

* `config/batch=N`: the configuration as of batch N, one row for each table ever named. Written only by batches that
  change it; `started` is the batch since which a table is live, `since` the first batch whose changes have not been
  routed yet when it is not.
* `waiting/batch=N`: changes of tables that are not live in batch N. When a table starts in batch M, the changes that
  wait from batch `since` to M - 1 go to the sink with batch M's. A table that is removed and comes back starts
  again, from the batch of its removal on, so nothing is replayed twice.
* `nameless/batch=N`: changes that name no table.

A batch only reads what earlier batches wrote, so repeating it gives the same rows again: every change is in the sink
once, or in `waiting()`, or in `nameless()`. `compact` folds waiting changes that still wait into one base folder and
removes the folders it covers; the job calls it every `compact_every` batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import changes as C
from tidemill.operators.skew import join_lookup
from tidemill.sinks.writers import BatchWriter, batch_folder, complete_batches, remove_batches

_ROUTE = ("sink_table", "sink_columns", "row_key")
_CONFIG = C.ROUTE_SCHEMA + ", live boolean, started int, since int"
_WAITING = f"{C.ENVELOPE}, source_table string, since_batch int"


def routed_feed(config_lines: DataFrame, change_lines: DataFrame) -> DataFrame:
    """Both feeds as one frame (`feed`, `value`), batch or stream."""
    tagged = [f.select(F.lit(n).alias("feed"), "value") for n, f in (("config", config_lines), ("change", change_lines))]
    return tagged[0].union(tagged[1])


class RouteStore:
    """Batch writer of a routed feed. `sink` gets the routed changes of every batch; with a `namespace`, its tables are
    created and dropped as the configuration says."""

    def __init__(self, spark: SparkSession, path: str, sink: BatchWriter, namespace: str | None = None,
                 compact_every: int = 100):
        self.spark, self.path, self.sink, self.namespace, self.every = spark, path, sink, namespace, compact_every

    def __call__(self, batch: DataFrame, number: int) -> None:
        if self.every and number and number % self.every == 0:
            self.compact(number - 1)
        held = batch.persist()
        try:
            self._configure(held.where("feed = 'config'").select("value"), number)
            changes = C.read_changes(held.where("feed = 'change'").select("value")).withColumn("source_table", C.source_table())
            self._route(changes, number)
        finally:
            held.unpersist()

    def configuration(self, before: int | None = None) -> DataFrame:
        """The configuration as of the last batch, or the last one before batch `before`."""
        done = [n for n in complete_batches(self.spark, f"{self.path}/config") if before is None or n < before]
        if not done:
            return self.spark.createDataFrame([], _CONFIG)
        return self.spark.read.schema(_CONFIG).parquet(batch_folder(f"{self.path}/config", max(done)))

    def waiting(self, before: int | None = None) -> DataFrame:
        """Changes whose table is not live yet, with the batch they came in (`since_batch`)."""
        state = self.configuration(before).select("source_table", "live", "since")
        held = join_lookup(self._stored(before), state, "source_table", "left")
        pending = ~F.coalesce("live", F.lit(False)) & (F.col("since_batch") >= F.coalesce("since", F.lit(0)))
        return held.where(pending).drop("live", "since")

    def nameless(self) -> DataFrame:
        done = complete_batches(self.spark, f"{self.path}/nameless")
        empty = self.spark.createDataFrame([], C.ENVELOPE)
        return self.spark.read.schema(C.ENVELOPE).parquet(*[batch_folder(f"{self.path}/nameless", n) for n in done]) if done else empty

    def compact(self, upto: int) -> None:
        """Fold the waiting changes of the batches up to `upto` into one base folder. A complete base is never written
        again, so a repeated call only removes what a broken one has left."""
        done = complete_batches(self.spark, f"{self.path}/base")
        if upto not in done:
            self.waiting(upto + 1).write.mode("overwrite").parquet(batch_folder(f"{self.path}/base", upto))
        remove_batches(self.spark, f"{self.path}/waiting", upto)
        remove_batches(self.spark, f"{self.path}/base", upto - 1)
        remove_batches(self.spark, f"{self.path}/config", max(
            [n for n in complete_batches(self.spark, f"{self.path}/config") if n <= upto], default=0) - 1)

    def _stored(self, before: int | None) -> DataFrame:
        """All waiting changes on file, replayed ones included, of the batches before `before`."""
        bases = [n for n in complete_batches(self.spark, f"{self.path}/base") if before is None or n < before]
        base = max(bases, default=-1)
        folders = [batch_folder(f"{self.path}/base", base)] if bases else []
        folders += [batch_folder(f"{self.path}/waiting", n) for n in complete_batches(self.spark, f"{self.path}/waiting")
                    if n > base and (before is None or n < before)]
        if not folders:
            return self.spark.createDataFrame([], _WAITING)
        return self.spark.read.schema(_WAITING).parquet(*folders)

    def _configure(self, lines: DataFrame, number: int) -> None:
        """Write the configuration as of this batch, if the batch changes it, and create and drop its tables."""
        images = C.config_images(lines).persist()
        try:
            if images.isEmpty():
                return
            old = self.configuration(number).select("source_table", *[F.col(c).alias(f"old_{c}") for c in (
                *_ROUTE, "live", "started", "since")])
            both = old.join(images, "source_table", "full")
            named = F.col("op").isNotNull()
            was = F.coalesce("old_live", F.lit(False))
            live = F.when(named, F.col("op") != C.DELETE).otherwise(was)
            rows = both.select(
                "source_table", *[F.when(named, F.col(c)).otherwise(F.col(f"old_{c}")).alias(c) for c in _ROUTE], live.alias("live"),
                F.when(live & ~was, number).otherwise(F.col("old_started")).cast("int").alias("started"),
                F.when(~live & was, number).otherwise(F.coalesce("old_since", F.lit(0))).cast("int").alias("since"))
            order = [c.strip().split(" ")[0] for c in _CONFIG.split(",")]
            rows.select(*order).write.mode("overwrite").parquet(batch_folder(f"{self.path}/config", number))
            if self.namespace:
                C.apply_table_config(self.spark, images, self.namespace)
        finally:
            images.unpersist()

    def _route(self, changes: DataFrame, number: int) -> None:
        state = self.configuration(number + 1)
        live = state.where("live").select("source_table", *_ROUTE)
        changes = changes.persist()
        try:
            known = join_lookup(changes, live.select("source_table", F.lit(True).alias("_live")), "source_table", "left")
            early = known.where("_live IS NULL AND source_table IS NOT NULL").drop("_live")
            early.withColumn("since_batch", F.lit(number)).write.mode("overwrite").parquet(batch_folder(f"{self.path}/waiting", number))
            changes.where("source_table IS NULL").drop("source_table").write.mode("overwrite").parquet(
                batch_folder(f"{self.path}/nameless", number))
            due = self._due(state.where(F.col("live") & (F.col("started") == number)), number)
            whole = changes.select("before", "after", "source", "op", "ts_ms")
            self.sink(C.route_changes(whole.union(due) if due is not None else whole, live), number)
        finally:
            changes.unpersist()

    def _due(self, started: DataFrame, number: int) -> DataFrame | None:
        """Changes that waited for the tables that start in this batch."""
        if started.isEmpty():
            return None
        held = join_lookup(self._stored(number), started.select("source_table", "since"), "source_table")
        return held.where("since_batch >= since").select("before", "after", "source", "op", "ts_ms")
