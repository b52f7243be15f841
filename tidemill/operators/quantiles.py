"""Exact quantiles without gathering a column in one task.

1. A bounded sketch brackets each wanted rank, with the sketch's own error bound as margin.
2. A second pass counts the rows below the bracket and the distinct values inside it, at most about 6 / `accuracy` of
   the rows.
3. Where a bracket holds more than `RANGE_ROWS` distinct values it is cut into `RANGES` ranges of about equal number; a
   prefix sum over the ranges' counts tells which one or two hold the rank, and only their values go on.
4. The rank is read off a running count over what is left.

A bracket that misses its rank is widened eightfold and tried again, in the end as wide as the column.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.skew import fits_broadcast, join_state
from tidemill.session import checkpoint_dir

ACCURACY = 10_000
RANGE_ROWS = 50_000
RANGES = 256
MARGIN = 2.0
WIDEN = 8


def melt(frame: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Numeric columns in long form (`column`, `value`), nulls and NaN left out; never shuffled in this form."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return frame.select(*by, F.inline(cells)).where("value IS NOT NULL AND NOT isnan(value)")


def exact_quantiles(frame: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = (),
                    accuracy: int = ACCURACY, moments: bool = False) -> DataFrame:
    """Linearly interpolated quantiles: (by..., `column`, `probability`, `value`, `rows`), with `moments` also `mean`,
    `std`, `low` and `high` from the pass of the sketch."""
    spark, keys = frame.sparkSession, [*by, "column"]
    checkpoint_dir(spark)
    cells = melt(frame, columns, by)
    # Ends of the brackets as the sketch gives them, for the margin and for each wider one up to the whole column.
    margins = [MARGIN / accuracy]
    while margins[-1] < 1:
        margins.append(margins[-1] * WIDEN)
    ends = [min(1.0, max(0.0, p + side)) for m in margins[:-1] for p in probabilities for side in (-m, m)]
    sketch = cells.groupBy(*keys).agg(
        F.count("*").alias("rows"), F.min("value").alias("low"), F.max("value").alias("high"),
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.percentile_approx("value", ends, accuracy).alias("ends"),
    )
    state = sketch.checkpoint()  # one row per group and column; its size decides how the brackets reach the rows
    wanted = state.select(*keys, F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability"))
    found = None
    for turn in range(len(margins)):
        picked = _pick(cells, _brackets(state, keys, probabilities, margins, turn, accuracy), wanted if turn else None, keys, by)
        picked = picked.checkpoint()
        hits = picked.where("value IS NOT NULL")
        found = hits if found is None else found.union(hits)
        missed = picked.where("value IS NULL")
        if missed.isEmpty():
            break
        wanted = missed.select(*keys, "probability")
    if not moments:
        return found
    return found.join(state.select(*keys, "mean", "std", "low", "high"), keys)


def _brackets(state: DataFrame, keys: list[str], probabilities: Sequence[float], margins: list[float], turn: int,
              accuracy: int) -> DataFrame:
    """`brackets` of every group: probability, rank and the bracket's ends."""
    margin, base = margins[turn], 2 * len(probabilities) * turn
    whole = F.lit(turn == len(margins) - 1) | (F.col("rows") <= 4 * accuracy)
    at = lambda i, other: F.col(other) if turn == len(margins) - 1 else F.col("ends")[base + i]
    brackets = F.array(*[
        F.struct(
            F.lit(float(p)).alias("probability"),
            (F.lit(float(p)) * (F.col("rows") - 1)).alias("rank"),
            F.when(whole | F.lit(p <= margin), F.col("low")).otherwise(at(2 * i, "low")).alias("from"),
            F.when(whole | F.lit(p >= 1 - margin), F.col("high")).otherwise(at(2 * i + 1, "high")).alias("to"),
        )
        for i, p in enumerate(probabilities)
    ])
    return state.select(*keys, "rows", F.col("rows").alias("n"), brackets.alias("brackets"))


def _pick(cells: DataFrame, state: DataFrame, wanted: DataFrame | None, keys: list[str], by: Sequence[str]) -> DataFrame:
    """(keys..., `probability`, `value`, `rows`); a null value where the bracket missed the rank."""
    if wanted is not None:
        asked = wanted.groupBy(*keys).agg(F.collect_set("probability").alias("_asked"))
        state = state.join(asked, keys).select(*keys, "rows", "n", F.filter("brackets", lambda b: F.array_contains(
            F.col("_asked"), b["probability"])).alias("brackets"))
    if not by or fits_broadcast(state):
        placed = cells.join(F.broadcast(state.drop("rows")), keys)
    else:
        placed = join_state(cells, state, keys, "rows").where("brackets IS NOT NULL")
    inside = F.when(F.col("value") >= F.col("b.from"), F.col("value"))
    groups = [*keys, "n", "probability", "rank"]
    counted = (
        placed.select(*keys, "n", "value", F.explode("brackets").alias("b"))
        .where(F.col("value") <= F.col("b.to"))
        .groupBy(*keys, "n", F.col("b.probability").alias("probability"), F.col("b.rank").alias("rank"),
                 inside.alias("value"))
        .agg(F.count("*").alias("count"))
    ).checkpoint()
    lower, upper = F.floor("rank"), F.ceil("rank")
    below = F.coalesce(F.max(F.when(F.col("value").isNull(), F.col("count"))), F.max("under"), F.lit(0))
    sizes = counted.groupBy(*groups).agg(F.count("value").alias("distinct"))
    if not sizes.where(F.col("distinct") > RANGE_ROWS).isEmpty():
        counted = _only_ranges(counted, groups)
    else:
        counted = counted.select("*", F.lit(0).cast("long").alias("skipped"), F.lit(None).cast("long").alias("under"))
    upto = F.sum("count").over(Window.partitionBy(*groups).orderBy(F.col("value").asc_nulls_first())
                               .rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("skipped")
    picked = counted.withColumn("upto", upto).groupBy(*groups).agg(
        below.alias("below"),
        F.min(F.when(F.col("upto") > lower, F.col("value"))).alias("left"),
        F.min(F.when(F.col("upto") > upper, F.col("value"))).alias("right"),
    )
    hit = (F.col("below") <= lower) & F.col("right").isNotNull()
    value = F.col("left") + (F.col("rank") - lower) * (F.col("right") - F.col("left"))
    picked = picked.select(*keys, "probability", F.when(hit, value).alias("value"))
    asked = state.select(*keys, F.col("n").alias("rows"), F.explode("brackets.probability").alias("probability"))
    on = reduce(and_, [F.col(f"a.{k}").eqNullSafe(F.col(f"p.{k}")) for k in (*keys, "probability")])
    return asked.alias("a").join(picked.alias("p"), on, "left").select(
        *[F.col(f"a.{k}").alias(k) for k in (*keys, "probability")], "value", "rows")


def _only_ranges(counted: DataFrame, groups: list[str]) -> DataFrame:
    """Of the brackets only the ranges that hold the rank, with the count of everything before them (`skipped`) and below
    the bracket (`under`). A bracket of few distinct values is one range."""
    shares = [i / RANGES for i in range(1, RANGES)]
    inner = counted.where("value IS NOT NULL")
    bounds = inner.groupBy(*groups).agg(F.count("*").alias("distinct"), F.percentile_approx("value", shares, 10 * RANGES).alias("bounds"))
    # At most one row for each RANGE_ROWS distinct values.
    bounds = F.broadcast(bounds.where(F.col("distinct") > RANGE_ROWS).select(*groups, "bounds"))
    cut = counted.join(bounds, groups, "left").withColumn("range", F.when(F.col("value").isNull(), -1).otherwise(
        F.coalesce(F.size(F.filter("bounds", lambda b: b < F.col("value"))), F.lit(0)))).drop("bounds")
    sums = cut.groupBy(*groups, "range").agg(F.sum("count").alias("held"))
    whole = Window.partitionBy(*groups)  # RANGES + 1 rows at most
    sums = sums.select("*", (F.sum("held").over(whole.orderBy("range")) - F.col("held")).alias("before"),
                       F.coalesce(F.sum(F.when(F.col("range") < 0, F.col("held"))).over(whole), F.lit(0)).alias("under"))
    holds = (F.col("range") >= 0) & (F.col("before") <= F.ceil("rank")) & (F.col("before") + F.col("held") > F.floor("rank"))
    sums = sums.where(holds).select(*groups, "range", "under", F.min("before").over(whole).alias("skipped"))
    return cut.join(F.broadcast(sums) if fits_broadcast(sums) else sums, [*groups, "range"]).select(*counted.columns, "skipped", "under")
