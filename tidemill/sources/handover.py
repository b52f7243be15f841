"""A table's snapshot followed by its change log, without a gap and without a change twice.

While a table is read the log goes on, so every chunk of keys is read at a log position of its own, and that position is
stored with the chunk. Of the log, a change at or before the position of its key's chunk is in the snapshot already and
is dropped, also when its key has no row there because it had been deleted by then; every later change is kept. So the
log may start anywhere before the first chunk was read, and overlap the snapshot as far as it likes.

A chunk's position is written after its rows: without it the chunk counts as unread, and `missing` names it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.changes import ENVELOPE, source_position
from tidemill.sinks.writers import batch_folder, complete_batches
from tidemill.sources.readers import SNAPSHOT

_ROWS = f"{ENVELOPE}, chunk int, position bigint"
_POSITIONS = "chunk int, position bigint"


def chunk_of(key: Column | str, chunks: int) -> Column:
    """Number of a key's chunk, the same for equal keys."""
    return F.pmod(F.xxhash64(key), F.lit(chunks)).cast("int")


class SnapshotFiles:
    """A snapshot of `chunks` chunks in a folder: their rows, and the log position of each."""

    def __init__(self, spark: SparkSession, path: str, chunks: int):
        self.spark, self.path, self.chunks = spark, path, chunks

    def store(self, rows: DataFrame, positions: DataFrame, database: str, table: str) -> None:
        """Add chunks: `rows` are the table's rows with their `chunk`, `positions` has `chunk` and `position`, the end of
        the log when that chunk was read. Chunks without rows are named there too."""
        number = max(complete_batches(self.spark, f"{self.path}/positions"), default=-1) + 1
        handed = positions.select(F.col("chunk").cast("int").alias("chunk"), F.col("position").cast("bigint").alias("position"))
        placed = rows.join(F.broadcast(handed), "chunk")  # at most one row a chunk
        after = F.to_json(F.struct(*[c for c in rows.columns if c != "chunk"]))
        source = F.to_json(F.struct(F.lit(database).alias("db"), F.lit(table).alias("table"), F.col("position").alias("pos")))
        placed.select(
            F.lit(None).cast("string").alias("before"), after.alias("after"), source.alias("source"), F.lit(SNAPSHOT).alias("op"),
            F.lit(0).cast("bigint").alias("ts_ms"), F.col("chunk").cast("int").alias("chunk"), "position",
        ).write.mode("overwrite").parquet(batch_folder(f"{self.path}/rows", number))
        handed.write.mode("overwrite").parquet(batch_folder(f"{self.path}/positions", number))

    def positions(self) -> DataFrame:
        return self._read("positions", _POSITIONS)

    def rows(self) -> DataFrame:
        """The snapshot as envelopes marked as reads, with `chunk` and `position`."""
        return self._read("rows", _ROWS)

    def missing(self) -> list[int]:
        read = {r["chunk"] for r in self.positions().select("chunk").collect()}
        return [n for n in range(self.chunks) if n not in read]

    def _read(self, kind: str, schema: str) -> DataFrame:
        done = complete_batches(self.spark, f"{self.path}/positions")
        if not done:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[batch_folder(f"{self.path}/{kind}", n) for n in done])


def changes_after(snapshot: SnapshotFiles, changes: DataFrame, chunk: Column) -> DataFrame:
    """Changes (batch or stream) that the snapshot does not have, with `chunk` and `position`.

    `chunk` is the chunk of a change's key; a change without key or position is kept.
    """
    if left := snapshot.missing():
        raise ValueError(f"chunks {left} of the snapshot have not been read")
    handed = F.broadcast(snapshot.positions().groupBy("chunk").agg(F.max("position").alias("_handed")))  # one row a chunk
    placed = changes.withColumn("chunk", chunk.cast("int")).withColumn("position", source_position())
    return placed.join(handed, "chunk", "left").where(F.coalesce(F.col("position") > F.col("_handed"), F.lit(True))).select(
        *changes.columns, "chunk", "position")


def snapshot_then_changes(snapshot: SnapshotFiles, changes: DataFrame, chunk: Column) -> DataFrame:
    """Snapshot reads and the changes after them, as one batch frame."""
    return snapshot.rows().unionByName(changes_after(snapshot, changes, chunk))
