"""Sinks for frames and for the batches of a stream.

A stream writes each batch into a folder of its own, so a batch repeated after a failure replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

BatchWriter = Callable[[DataFrame, int], None]


def as_lines(frame: DataFrame, value: Column | None = None) -> DataFrame:
    """Any frame as a `value` column: JSON of the whole row, or the caller's own text expression."""
    return frame.select((F.to_json(F.struct("*")) if value is None else value).cast("string").alias("value"))


def routed_records(frame: DataFrame, route: str, value: str = "value", topics: Mapping[str, str] | None = None) -> DataFrame:
    """(`topic`, `value`): the topic is the row's `route` column, or that name looked up in `topics`."""
    topic = F.col(route)
    if topics is not None:
        topic = F.create_map(*[F.lit(x) for pair in topics.items() for x in pair])[topic]
    return frame.select(topic.alias("topic"), F.col(value).cast("string").alias("value"))


def kafka_sink(records: DataFrame, servers: str, topic: str | None = None,
               checkpoint: str | None = None) -> DataStreamWriter | None:
    """Write `value` records to one topic, or to each row's `topic` column; delivery is at least once.

    A stream gives the configured writer to start; a batch is written at once. Needs the Kafka package.
    """
    options = {"kafka.bootstrap.servers": servers} | ({"topic": topic} if topic else {})
    if records.isStreaming:
        if not checkpoint:
            raise ValueError("a stream needs a checkpoint folder")
        return records.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint)
    records.write.format("kafka").options(**options).save()
    return None


def batch_folder(path: str, batch: int) -> str:
    return f"{path}/batch={batch}"


def complete_batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the completely written batch folders below `path`."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    done = files.globStatus(hadoop.Path(f"{path}/batch=*/_SUCCESS")) or []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in done)


def remove_batches(spark: SparkSession, path: str, upto: int) -> None:
    """Remove the complete batch folders below `path` up to number `upto`."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for number in complete_batches(spark, path):
        if number <= upto:
            folder = hadoop.Path(batch_folder(path, number))
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def routed_files(frame: DataFrame, path: str, route: str, batch: int | None = None) -> None:
    """One folder per value of `route`, all written in one pass: appended, or with a `batch` in a folder of the batch's
    own, which a repeated batch replaces."""
    if batch is None:
        frame.write.mode("append").partitionBy(route).parquet(path)
    else:
        frame.write.mode("overwrite").partitionBy(route).parquet(batch_folder(path, batch))


def json_batches(path: str, retries: int = 3) -> BatchWriter:
    """Batch writer of JSON lines for a reporting store; append only, a failed write is tried again."""
    def write(frame: DataFrame, batch: int) -> None:
        for attempt in range(retries + 1):
            try:
                frame.write.mode("overwrite").json(batch_folder(path, batch))
                return
            except Exception:
                if attempt == retries:
                    raise

    return write


def tagged_batches(path: str, tag: str = "tag") -> BatchWriter:
    """Batch writer that stores every tag's rows in a folder of its own from a single pass over the batch."""
    def write(frame: DataFrame, batch: int) -> None:
        frame.write.mode("overwrite").partitionBy(tag).parquet(batch_folder(path, batch))

    return write


def fan_out(writers: Mapping[str, BatchWriter], tag: str = "tag") -> BatchWriter:
    """Batch writer that gives each tag's rows to that tag's own writer; the batch is computed once."""
    def write(frame: DataFrame, batch: int) -> None:
        held = frame.persist()
        try:
            for name, writer in writers.items():
                writer(held.where(F.col(tag) == name).drop(tag), batch)
        finally:
            held.unpersist()

    return write
