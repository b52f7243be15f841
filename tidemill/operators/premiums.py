"""Premium frames side by side, and the retained-premium ratio."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows per range when rows are numbered, and the most ranges used.
RANGE_ROWS = 2_000_000
MAX_RANGES = 20_000


def bind_by_key(frames: list[DataFrame], key: str) -> DataFrame:
    """Frames side by side on a business key that is unique in each; a key missing on one side gives nulls."""
    return reduce(lambda left, right: left.join(right, key, "full"), frames)


def with_position(frame: DataFrame, order: str, name: str = "position") -> DataFrame:
    """Number rows 0, 1, 2... in the order of a unique numeric column.

    Rows fall into ranges of about equal size; the number is the row's place in its range plus the size of all
    ranges before it. No task sees more than one range, and a repeated task gives the same numbers.
    """
    ranges = min(MAX_RANGES, frame.count() // RANGE_ROWS + frame.sparkSession.sparkContext.defaultParallelism)
    cuts = frame.approxQuantile(order, [i / ranges for i in range(1, ranges)], 0.1 / ranges)
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="_order", outputCol="_range", handleInvalid="keep").transform(
        frame.withColumn("_order", F.col(order).cast("double")))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # at most MAX_RANGES + 1 rows
    offsets = ranged.groupBy("_range").agg(F.count("*").alias("_rows")).select(
        "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(order)) - 1
    return ranged.join(F.broadcast(offsets), "_range").withColumn(name, F.col("_offset") + place).select(
        *frame.columns, name)


def bind_by_position(frames: list[DataFrame], orders: list[str], name: str = "position") -> DataFrame:
    """Frames side by side row by row, each in its own explicit order; shorter frames give nulls."""
    return bind_by_key([with_position(f, o, name) for f, o in zip(frames, orders, strict=True)], name)


def retained_premium_ratio(frame: DataFrame, gross: str, ceded: str, closing: str, opening: str | None = None,
                           keep: tuple[str, ...] = ()) -> DataFrame:
    """Retained premium, average equity and their ratio in percent; no equity gives a null ratio.

    Without an opening balance the closing one stands for both.
    """
    retained = F.col(gross) - F.col(ceded)
    equity = (F.col(opening or closing) + F.col(closing)) / 2
    return frame.select(
        *keep,
        retained.alias("retained_premium"),
        equity.alias("average_equity"),
        (F.try_divide(retained, equity) * 100).alias("ratio_percent"),
    )
