"""Joins that survive a hot key.

Two rules hold here. A side is broadcast only when its size is bounded, either by a count made first or because
its rows are keys heavier than a threshold (a table of R rows has at most R / threshold of them). And rows of a
hot key never meet in one task.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 5_000_000
SMALL_ROWS = 100_000
SMALL_BYTES = 64 * 1024 * 1024


def fits_broadcast(frame: DataFrame, rows: int = SMALL_ROWS, size: int = SMALL_BYTES) -> bool:
    """Count at most `rows` + 1 rows of `frame` and add up their text size."""
    head = frame.limit(rows + 1).select(F.octet_length(F.to_json(F.struct("*"))).alias("size"))
    seen = head.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
    return seen["n"] <= rows and seen["size"] <= size


def join_lookup(facts: DataFrame, lookup: DataFrame, key: str, how: str = "inner",
                rows: int = SMALL_ROWS, size: int = SMALL_BYTES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Equi-join of a big frame to a lookup frame that has one row per key, inner or left.

    A lookup that fits is broadcast, so the facts are not shuffled at all. A bigger one is joined by
    `join_state` with the fact rows per key as weight; a stream, whose keys cannot be counted first, falls back to
    the ordinary join (its batches are bounded by the source's rate limit).
    """
    if how not in ("inner", "left"):
        raise ValueError("join_lookup joins inner or left")
    if fits_broadcast(lookup, rows, size):
        return facts.join(F.broadcast(lookup), key, how)
    if facts.isStreaming:
        return facts.join(lookup, key, how)
    weights = facts.groupBy(key).agg(F.count("*").alias("_rows"))
    # A hot key that the lookup lacks needs a state too, an empty one, or its rows would meet in one task.
    state = weights.join(lookup.withColumn("_found", F.lit(True)), key, "left").where(F.col("_found") | (F.col("_rows") >= hot_rows))
    joined = join_state(facts, state, key, "_rows", hot_rows)
    return (joined if how == "left" else joined.where("_found")).drop("_found")


def join_state(facts: DataFrame, state: DataFrame, keys: str | list[str], weight: str,
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left-join every fact row to its key's single state row.

    `weight` holds the number of fact rows behind each state row. State rows of at least `hot_rows` go by
    broadcast; their fact rows leave the shuffle key and spread by a row hash. All other keys take the ordinary
    equi-join, which the adaptive planner turns into a broadcast join when the state turns out small.
    """
    keys = [keys] if isinstance(keys, str) else keys
    fields = [c for c in state.columns if c not in (*keys, weight)]
    packed = state.select(*keys, F.struct(*fields).alias("_state"), F.col(weight).alias("_weight"))
    hot = packed.where(F.col("_weight") >= hot_rows).select(*keys, F.col("_state").alias("_hot"))
    # Zero, but not a literal: the optimiser would take a literal out of the join key, and the salt with it.
    zero = F.least(F.col("_weight"), F.lit(0).cast("long"))
    cold = packed.where(F.col("_weight") < hot_rows).select(
        *keys, zero.alias("_salt"), F.col("_state").alias("_cold"))
    marked = facts.join(F.broadcast(hot), keys, "left")
    # A null key matches nothing, whatever its salt.
    unmatched = reduce(or_, [F.col(k).isNull() for k in keys])
    apart = F.col("_hot").isNotNull() | unmatched
    marked = marked.withColumn("_salt", F.when(apart, _row_salt(facts)).otherwise(F.lit(0)))
    joined = marked.join(cold, [*keys, "_salt"], "left")
    best = F.coalesce("_hot", "_cold")
    return joined.select(*facts.columns, *[best[c].alias(c) for c in fields])


def _row_salt(frame: DataFrame) -> Column:
    """A non-zero salt from the row and its partition: copies of one row spread as well, and a task that is run
    again gives the same salts."""
    hashable = [f.name for f in frame.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return F.xxhash64(*hashable, F.spark_partition_id()).bitwiseOR(F.lit(1))
