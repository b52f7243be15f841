"""Sources. Whatever the transport, a feed is a frame with a text column `value`; batch and stream look the same."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.parsing import parse_json
from tidemill.operators.changes import ENVELOPE, source_table
from tidemill.operators.keywords import with_event_time, with_zero_watermark

# Columns of the page log and the snapshot mark of a change log.
PAGE_LOG = "common map<string,string>, page map<string,string>, ts bigint"
SNAPSHOT = "r"


def kafka_lines(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", streaming: bool = True,
                **options: str) -> DataFrame:
    """Values of a Kafka topic as text; a null value stays null. Needs the Kafka package on the class path.

    `maxOffsetsPerTrigger` in `options` bounds a micro-batch.
    """
    reader = spark.readStream if streaming else spark.read
    loaded = (reader.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
              .option("startingOffsets", starting).options(**options).load())
    return loaded.select(F.col("value").cast("string").alias("value"), "partition", "offset")


def file_lines(spark: SparkSession, path: str, streaming: bool = False, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the text files in a folder."""
    if not streaming:
        return spark.read.text(path)
    reader = spark.readStream
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def json_table(spark: SparkSession, lines: DataFrame, schema: str, view: str) -> DataFrame:
    """Publish JSON lines under a schema as a SQL view, and return `SELECT *` of it."""
    parse_json(lines.select("value"), schema).createOrReplaceTempView(view)
    return spark.sql(f"SELECT * FROM {view}")


def change_table(spark: SparkSession, lines: DataFrame, view: str = "topic_db") -> DataFrame:
    """A change topic as a SQL table of envelopes."""
    return json_table(spark, lines, ENVELOPE, view)


def page_log_table(lines: DataFrame) -> DataFrame:
    """Page log with maps, event time `et`, and on a stream a watermark that allows no lateness."""
    timed = with_event_time(parse_json(lines.select("value"), PAGE_LOG))
    return with_zero_watermark(timed) if timed.isStreaming else timed


def snapshot_changes(rows: DataFrame, database: str, table: str) -> DataFrame:
    """Current rows of a table as change envelopes marked as snapshot reads, older than any change."""
    return rows.select(
        F.lit(None).cast("string").alias("before"),
        F.to_json(F.struct("*")).alias("after"),
        F.to_json(F.struct(F.lit(database).alias("db"), F.lit(table).alias("table"))).alias("source"),
        F.lit(SNAPSHOT).alias("op"),
        F.lit(0).cast("bigint").alias("ts_ms"),
    )


def change_source(changes: DataFrame, snapshot: DataFrame | None = None, databases: Sequence[str] = (),
                  tables: Sequence[str] = ()) -> DataFrame:
    """Changes of the named databases and `db.table` tables (none named: all), after the snapshot if one is given."""
    whole = changes if snapshot is None else snapshot.unionByName(changes)
    database = F.get_json_object("source", "$.db")
    if databases:
        whole = whole.where(database.isin(list(databases)))
    if tables:
        whole = whole.where(F.concat_ws(".", database, source_table()).isin(list(tables)))
    return whole


def dimension_table(spark: SparkSession, name: str) -> DataFrame:
    """A dictionary dimension with its nested block flattened."""
    return spark.table(name).select("rk", "info.dic_name", "info.parent_code")


def csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header line under an explicit schema (inference would read the data twice)."""
    return spark.read.csv(path, header=True, schema=schema)
