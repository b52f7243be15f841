"""Streaming jobs: the batch operators between a text feed and a sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemill.functions.dates import SHOP_ZONE
from tidemill.functions.text import tokens
from tidemill.operators import changes as C
from tidemill.operators import keywords as K
from tidemill.operators import logs as L
from tidemill.sinks.dimensions import DimensionFiles
from tidemill.sinks.writers import BatchWriter, tagged_batches
from tidemill.sources.handover import SnapshotFiles, changes_after
from tidemill.sources.readers import page_log_table
from tidemill.streaming.lateness import LateStore
from tidemill.streaming.routing import RouteStore, routed_feed
from tidemill.streaming.visitors import repair_visitor_stream
from tidemill.streaming.visitor_days import VisitorDays

# Fixed value: time between two checkpoints of a live job.
CHECKPOINT_INTERVAL = "3 seconds"

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark) -> None:
    """Keep stream state in RocksDB (required by the visitor repair, and state no longer lives on the heap)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _writer(frame: DataFrame, checkpoint: str, until_done: bool) -> DataStreamWriter:
    writer = frame.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if until_done else writer.trigger(processingTime=CHECKPOINT_INTERVAL)


def keyword_stream(lines: DataFrame, zone: str = SHOP_ZONE, tokenizer=tokens) -> DataFrame:
    """Page-log lines -> finished keyword windows. A window comes out once the watermark has passed its end, so the
    last one waits for newer events."""
    return K.keyword_window_count(page_log_table(lines), tokenizer, zone=zone)


def keyword_job(lines: DataFrame, path: str, checkpoint: str, until_done: bool = False) -> DataStreamWriter:
    """Finished windows as parquet files, exactly once."""
    return _writer(keyword_stream(lines), checkpoint, until_done).outputMode("append").format("parquet").option("path", path)


def repaired_log_stream(lines: DataFrame, order: Sequence[str] = ("ts",), mode: str = "as_written",
                        zone: str = SHOP_ZONE, ttl_ms: int | None = None) -> DataFrame:
    """Log lines -> good records with the repaired flag. `order` may name any column of `lines` after `ts`."""
    logs = L.valid_logs(L.read_logs(lines)).drop("record")
    fixed = repair_visitor_stream(logs, order, mode, zone, ttl_ms)
    return fixed.withColumn("record", F.try_parse_json("value"))


def log_split_job(lines: DataFrame, checkpoint: str, sink: BatchWriter | str, order: Sequence[str] = ("ts",),
                  mode: str = "as_written", ttl_ms: int | None = None, until_done: bool = False) -> DataStreamWriter:
    """Validate, repair and split a log stream; `sink` is a batch writer of (tag, value) or a folder."""
    split = L.log_split(repaired_log_stream(lines, order, mode, ttl_ms=ttl_ms))
    writer = tagged_batches(sink) if isinstance(sink, str) else sink
    return _writer(split, checkpoint, until_done).foreachBatch(writer)


def visitor_days_job(lines: DataFrame, days: VisitorDays, checkpoint: str, until_done: bool = False) -> DataStreamWriter:
    """Repair the flags of a log stream with one remembered day a device between the batches."""
    logs = L.valid_logs(L.read_logs(lines)).drop("record")
    return _writer(logs, checkpoint, until_done).foreachBatch(days)


def late_records_job(rows: DataFrame, store: LateStore, checkpoint: str, until_done: bool = False) -> DataStreamWriter:
    """Split a stream of timed rows into those in time and the late ones."""
    return _writer(rows, checkpoint, until_done).foreachBatch(store)


def open_windows(spark: SparkSession, checkpoint: str, zone: str = SHOP_ZONE) -> DataFrame:
    """Windows that a stopped keyword job still holds, with their counts so far, read from its state."""
    state = spark.read.format("statestore").load(checkpoint)
    counts = state.select("key.window", "key.keyword", F.col("value.count").alias("keyword_count"))
    return K.format_windows(counts, zone)


def snapshot_job(lines: DataFrame, snapshot: SnapshotFiles, chunk: Column, checkpoint: str, sink: BatchWriter,
                 until_done: bool = False) -> DataStreamWriter:
    """A snapshot and then the changes it does not have; the snapshot comes with the first batch. `chunk` is the chunk of
    a parsed change's key."""
    def write(batch: DataFrame, number: int) -> None:
        later = changes_after(snapshot, batch, chunk)
        sink(snapshot.rows().unionByName(later) if number == 0 else later, number)

    return _writer(C.read_changes(lines), checkpoint, until_done).foreachBatch(write)


def dirty_log_job(lines: DataFrame, path: str, checkpoint: str, until_done: bool = False) -> DataStreamWriter:
    """The quarantine of a log stream as parquet files."""
    return _writer(L.dirty_logs(L.read_logs(lines)), checkpoint, until_done).format("parquet").option("path", path)


def dimension_job(lines: DataFrame, dimension: DimensionFiles, checkpoint: str, until_done: bool = False) -> DataStreamWriter:
    """Change lines -> dimension files, upserted batch by batch. The key and values are fields of the image."""
    changes = C.read_changes(lines).withColumn("position", C.source_position()).withColumn("_image", C.image())
    fields = changes.select(
        "op", "ts_ms", "position",
        *[F.get_json_object("_image", f"$.{c}").alias(c) for c in (dimension.key, *dimension.values)])
    return _writer(fields, checkpoint, until_done).foreachBatch(dimension.upsert)


def route_job(lines: DataFrame, config_lines, checkpoint: str, sink: BatchWriter, until_done: bool = False) -> DataStreamWriter:
    """Route a change stream. `config_lines()` gives the configuration log as a batch frame; it is read again for
    every micro-batch, so a change of routing takes effect with the next one. A change that comes before its table
    is configured is dropped."""
    def write(batch: DataFrame, number: int) -> None:
        sink(C.route_changes(batch, C.config_state(config_lines())), number)

    return _writer(C.read_changes(lines), checkpoint, until_done).foreachBatch(write)


def stream_route_job(config_lines: DataFrame, change_lines: DataFrame, store: RouteStore, checkpoint: str,
                     until_done: bool = False) -> DataStreamWriter:
    """Route a change stream by a configuration stream; changes that come before their configuration wait for it."""
    return _writer(routed_feed(config_lines, change_lines), checkpoint, until_done).foreachBatch(store)
