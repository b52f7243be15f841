"""Column profiles and cleaning. Each function is one aggregate over the frame, never one pass per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.quantiles import exact_quantiles, melt

# Box-plot rule and the category codes of the cross-sell data.
WHISKER = 1.5
GENDER_CODES = {"Female": 1, "Male": 0}
DAMAGE_CODES = {"Yes": 1, "No": 0}
VEHICLE_AGE_CODES = {"< 1 Year": 0, "1-2 Year": 1, "> 2 Years": 2}


def numeric_columns(frame: DataFrame) -> list[str]:
    return [f.name for f in frame.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(frame: DataFrame) -> list[str]:
    return [f.name for f in frame.schema.fields if isinstance(f.dataType, T.StringType)]


def _unpivot(names: Sequence[str], **fields) -> Column:
    """One output row per name; each keyword gives a field as a function of the name."""
    return F.inline(F.array(*[
        F.struct(F.lit(n).alias("column"), *[make(n).alias(field) for field, make in fields.items()]) for n in names]))


def _text_cells(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    return frame.select(_unpivot(columns, value=lambda c: F.col(c).cast("string")))


def null_counts(frame: DataFrame) -> DataFrame:
    """(`column`, `nulls`) for every column."""
    counts = frame.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in frame.columns])
    return counts.select(_unpivot(frame.columns, nulls=F.col))


def frame_info(frame: DataFrame) -> DataFrame:
    """(`column`, `dtype`, `non_null`) for every column."""
    types = dict(frame.dtypes)
    counts = frame.agg(*[F.count(F.col(c)).alias(c) for c in frame.columns])
    return counts.select(_unpivot(frame.columns, dtype=lambda c: F.lit(types[c]), non_null=F.col))


def describe_numeric(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per numeric column."""
    points = {0.25: "q1", 0.5: "median", 0.75: "q3"}
    found = exact_quantiles(frame, list(columns or numeric_columns(frame)), list(points), moments=True)
    return found.groupBy("column", "mean", "std", F.col("low").alias("min"), F.col("high").alias("max"), F.col("rows").alias("count")).agg(*[
        F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name) for p, name in points.items()]).select(
        "column", "count", "mean", "std", "min", "q1", "median", "q3", "max")


def describe_object(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, distinct values, most frequent value and its count per text column; ties go to the smallest value."""
    cells = _text_cells(frame, list(columns or text_columns(frame))).where("value IS NOT NULL")
    counts = cells.groupBy("column", "value").agg(F.count("*").alias("n"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count("*").alias("unique"),
        F.min(F.struct((-F.col("n")).alias("rank"), "value", "n")).alias("top"),
    ).select("column", "count", "unique", F.col("top.value").alias("top"), F.col("top.n").alias("freq"))


def distinct_values(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(`column`, `value` as text) for every distinct value, null included."""
    return _text_cells(frame, columns).distinct()


def encode_categories(frame: DataFrame, column: str, codes: Mapping[str, int], name: str | None = None) -> DataFrame:
    """Replace a category by its code; a value without a code becomes null."""
    lookup = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return frame.withColumn(name or column, lookup[F.col(column)])


def drop_columns(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.drop(*columns)


def head_rows(frame: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First `n` rows in an explicit order (a top-k per task, merged at the end)."""
    return frame.orderBy(*order).limit(n)


def _quartiles(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    points = {0.25: "q1", 0.5: "median", 0.75: "q3"}
    return exact_quantiles(frame, columns, list(points)).groupBy("column").agg(*[
        F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name) for p, name in points.items()])


def iqr_bounds(frame: DataFrame, columns: Sequence[str], whisker: float = WHISKER) -> DataFrame:
    """Quartiles, their distance and the outlier bounds per column. Columns are named on purpose: over a rare 0/1
    label both bounds are 0 and every positive row would count as an outlier."""
    quartiles = exact_quantiles(frame, columns, [0.25, 0.75]).groupBy("column").agg(
        F.min("value").alias("q1"), F.max("value").alias("q3"))
    spread = F.col("q3") - F.col("q1")
    return quartiles.select("column", "q1", "q3", spread.alias("iqr"), (F.col("q1") - whisker * spread).alias("lower"),
                            (F.col("q3") + whisker * spread).alias("upper"))


def _with_bounds(frame: DataFrame, columns: Sequence[str], whisker: float) -> DataFrame:
    """Attach `_bounds`, a map column -> {lower, upper} from one scalar subquery (one entry per column)."""
    entries = F.collect_list(F.struct("column", F.struct("lower", "upper")))
    bounds = iqr_bounds(frame, columns, whisker).agg(F.map_from_entries(entries).alias("bounds"))
    return frame.withColumn("_bounds", bounds.scalar())


def iqr_remove(frame: DataFrame, columns: Sequence[str], whisker: float = WHISKER) -> DataFrame:
    """Rows inside the bounds of every column; bounds come from the whole frame, null and NaN fail."""
    inside = F.lit(True)
    for c in columns:
        bound = F.col("_bounds")[c]
        inside = inside & F.col(c).between(bound["lower"], bound["upper"])
    return _with_bounds(frame, columns, whisker).where(inside).drop("_bounds")


def iqr_outliers(frame: DataFrame, columns: Sequence[str], keep: Sequence[str], whisker: float = WHISKER) -> DataFrame:
    """Values outside their column's bounds in long form (keep..., `column`, `value`)."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"),
                 F.col("_bounds")[c].alias("bound")) for c in columns])
    outside = F.filter(cells, lambda x: (x["value"] < x["bound"]["lower"])
                       | ((x["value"] > x["bound"]["upper"]) & ~F.isnan(x["value"])))
    return _with_bounds(frame, columns, whisker).select(*keep, F.inline(outside)).drop("bound")


def box_stats(frame: DataFrame, columns: Sequence[str], whisker: float = WHISKER) -> DataFrame:
    """The numbers of a box plot: quartiles, whisker ends (outermost values inside the bounds), fliers."""
    quartiles = _quartiles(frame, columns)
    spread = F.col("q3") - F.col("q1")
    bounds = quartiles.select("*", (F.col("q1") - whisker * spread).alias("lower"),
                              (F.col("q3") + whisker * spread).alias("upper"))
    cells = melt(frame, columns).join(F.broadcast(bounds), "column")  # one row per column
    inside = F.col("value").between(F.col("lower"), F.col("upper"))
    return cells.groupBy("column", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("fliers"),
    )
