"""Database change records: parsing, cleaning, configuration, routing, current images."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.parsing import parse_json
from tidemill.operators.skew import join_lookup

# The change envelope and its delete mark.
ENVELOPE = "before string, after string, source string, op string, ts_ms bigint"
DELETE = "d"

# Columns of the routing configuration (our own choice of names).
ROUTE_SCHEMA = "source_table string, sink_table string, sink_columns string, row_key string"


def read_changes(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Parse `value` into the envelope; the inner objects stay JSON text.

    A line that is not JSON fails the job when `strict`, and gives a row of nulls otherwise.
    """
    mode = {"mode": "FAILFAST" if strict else "PERMISSIVE"}
    return parse_json(lines, ENVELOPE, mode)


def clean_changes(changes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop origin and transaction; a delete keeps only its before image, anything else only its after image."""
    deleted = F.col("op").eqNullSafe(DELETE)
    return changes.select(
        F.when(deleted, F.col("before")).alias("before"),
        F.when(~deleted, F.col("after")).alias("after"),
        "op",
        *keep,
    )


def image() -> Column:
    """The image a change carries: before for a delete, after otherwise."""
    return F.when(F.col("op").eqNullSafe(DELETE), F.col("before")).otherwise(F.col("after"))


def source_table() -> Column:
    return F.get_json_object("source", "$.table")


def source_position() -> Column:
    """Log position of a change, the tie-breaker of changes made in the same millisecond."""
    return F.get_json_object("source", "$.pos").cast("long")


def latest_images(changes: DataFrame, key: str, order: Sequence[str], values: Sequence[str],
                  keep_deleted: bool = False) -> DataFrame:
    """Last image per key, deleted keys left out. `order` must order a key's changes uniquely.

    One mergeable aggregate: each map task sends at most one row per key, whatever a key's share of the log.
    A change without a key is no row of a dimension; `unkeyed_changes` has those.
    """
    last = changes.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct("op", *values, *order), F.struct(*order)).alias("last"))
    last = last.select(key, "last.op", *[F.col("last")[c].alias(c) for c in (*values, *order)])
    return last if keep_deleted else last.where(~F.col("op").eqNullSafe(DELETE)).drop("op")


def unkeyed_changes(changes: DataFrame, key: str) -> DataFrame:
    """Quarantine of `latest_images`: the changes whose key is null."""
    return changes.where(F.col(key).isNull())


def config_images(config_lines: DataFrame) -> DataFrame:
    """Last configuration change per source table, removals included: `op` and the configuration's columns.

    An update that gives a row another source table removes the one it had.
    """
    changes = read_changes(config_lines).withColumn("position", source_position())
    table = lambda text: F.get_json_object(text, "$.source_table")
    moved = ~F.col("op").eqNullSafe(DELETE) & table("before").isNotNull() & ~table("before").eqNullSafe(table("after"))
    own = F.struct(F.col("op").alias("op"), image().alias("config"))
    entries = F.when(moved, F.array(own, F.struct(F.lit(DELETE).alias("op"), F.col("before").alias("config")))).otherwise(F.array(own))
    rows = changes.select("ts_ms", "position", F.inline(entries)).withColumn("source_table", table("config"))
    last = latest_images(rows, "source_table", ("ts_ms", "position"), ("config",), keep_deleted=True)
    return last.select("op", F.from_json("config", ROUTE_SCHEMA).alias("config")).select("op", "config.*")


def config_state(config_lines: DataFrame) -> DataFrame:
    """Routing configuration as of the last change: one row per source table, removed tables left out."""
    return config_images(config_lines).where(~F.col("op").eqNullSafe(DELETE)).drop("op")


def route_changes(changes: DataFrame, routes: DataFrame) -> DataFrame:
    """Keep changes of configured tables, project them to the configured columns, name their sink and row key.

    Changes of a table that is not configured are dropped. `routes` has one row per source table.
    """
    tagged = changes.select("*", source_table().alias("source_table"), image().alias("_image"))
    wanted = routes.withColumn("_wanted", F.split("sink_columns", r"\s*,\s*"))
    routed = join_lookup(tagged, wanted, "source_table")
    members = F.try_parse_json("_image").try_cast("map<string,variant>")
    return routed.withColumn("_members", members).select(
        *[c for c in changes.columns if c not in ("before", "after", "source")],
        "source_table",
        "sink_table",
        F.col("_members")[F.col("row_key")].try_cast("string").alias("row_key"),
        F.to_json(F.to_variant_object(
            F.map_filter("_members", lambda k, v: F.array_contains("_wanted", k)))).alias("payload"),
    )


def through_sql(spark: SparkSession, changes: DataFrame, view: str = "topic_db") -> DataFrame:
    """Publish a frame as a SQL view and read it back; batch and stream alike, nothing is converted."""
    changes.createOrReplaceTempView(view)
    return spark.table(view)


def enrich(facts: DataFrame, dictionary: DataFrame, code: str) -> DataFrame:
    """Add `dic_name` and `parent_code` of a dictionary dimension (`rk`, `info`) to facts; unknown codes stay."""
    names = dictionary.select(F.col("rk").alias(code), "info.dic_name", "info.parent_code")
    return join_lookup(facts, names, code, "left")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def apply_table_config(spark: SparkSession, images: DataFrame, namespace: str = "default") -> list[str]:
    """Create the sink table of every configured table and drop that of every removed one; returns the statements.

    `images` is `config_images`, a row per source table, read one partition at a time.
    """
    done = []
    for row in images.toLocalIterator():
        name = f"{_quoted(namespace)}.{_quoted(row.sink_table)}"
        if row.op == DELETE:
            statement = f"DROP TABLE IF EXISTS {name}"
        else:
            columns = ", ".join(f"{_quoted(c.strip())} STRING" for c in row.sink_columns.split(","))
            statement = f"CREATE TABLE IF NOT EXISTS {name} (`rk` STRING, {columns}) USING parquet"
        spark.sql(statement)
        done.append(statement)
    return done
