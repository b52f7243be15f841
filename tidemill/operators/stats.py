"""Counts, shares, two-way tables, group statistics and correlations."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import md5
from itertools import combinations_with_replacement
from math import exp, factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.quantiles import exact_quantiles
from tidemill.session import checkpoint_dir

# Fixed value: normal quantile of a two-sided 95 % interval.
Z95 = 1.959963984540054


def _once(counts: DataFrame) -> DataFrame:
    """Grouped counts that are used twice, checkpointed, so that the frame behind them is evaluated once."""
    checkpoint_dir(counts.sparkSession)
    return counts.checkpoint()


def value_counts(frame: DataFrame, column: str) -> DataFrame:
    """(`value`, `n`), most frequent first, ties by value, nulls left out."""
    return frame.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count("*").alias("n")).orderBy(F.desc("n"), "value")


def value_shares(frame: DataFrame, column: str) -> DataFrame:
    """(`value`, `share`) of the non-null rows, largest first."""
    counts = _once(frame.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n").alias("n"))
    return counts.select("value", (F.col("n") / total.scalar()).alias("share")).orderBy(F.desc("share"), "value")


def crosstab(frame: DataFrame, index: str, column: str, values: Sequence | None = None,
             normalize: str | None = None) -> DataFrame:
    """Two-way table of the rows where neither column is null.

    Without `values` it covers every value, in the long form (index, `value`, `n` or `share`). With them it has one
    column per entry, named after it; rows with other values still count in the shares of their index.

    `normalize='index'` gives shares of each row, `'columns'` of each column, None plain counts. Totals are sums of the
    grouped counts, so the frame is evaluated once.
    """
    if normalize not in (None, "index", "columns"):
        raise ValueError("normalize is 'index', 'columns' or None")
    known = frame.where(F.col(index).isNotNull() & F.col(column).isNotNull())
    if values is None:
        return _crosstab_long(known, index, column, normalize)
    names = [str(v) for v in values]
    counts = known.groupBy(index).agg(
        F.count("*").alias("_row"), *[F.count_if(F.col(column) == v).alias(n) for v, n in zip(values, names, strict=True)])
    if normalize is None:
        return counts.drop("_row")
    if normalize == "index":
        return counts.select(index, *[(F.col(n) / F.col("_row")).alias(n) for n in names])
    counts = _once(counts)
    totals = counts.agg(F.struct(*[F.sum(n).alias(n) for n in names]).alias("totals")).scalar()
    counts = counts.withColumn("_totals", totals)
    return counts.select(index, *[F.try_divide(F.col(n), F.col("_totals")[n]).alias(n) for n in names])


def _crosstab_long(known: DataFrame, index: str, column: str, normalize: str | None) -> DataFrame:
    counts = known.groupBy(index, F.col(column).alias("value")).agg(F.count("*").alias("n"))
    if normalize is None:
        return counts
    counts, by = _once(counts), index if normalize == "index" else "value"
    totals = counts.groupBy(by).agg(F.sum("n").alias("_total"))
    return counts.join(totals, by).select(index, "value", (F.col("n") / F.col("_total")).alias("share"))


def crosstab_sorted(frame: DataFrame, index: str, column: str, values: Sequence, by) -> DataFrame:
    """Column shares, largest share of the value `by` first."""
    return crosstab(frame, index, column, values, "columns").orderBy(F.desc(F.col(f"`{by}`")), index)


def group_counts(frame: DataFrame, *columns: str) -> DataFrame:
    """Rows per combination of the columns."""
    return frame.groupBy(*columns).agg(F.count("*").alias("n"))


def group_median(frame: DataFrame, by: str, value: str) -> DataFrame:
    """Exact median per group."""
    return exact_quantiles(frame, [value], [0.5], [by]).select(by, F.col("value").alias("median"))


def group_mean_interval(frame: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Mean per group with a normal-approximation 95 % interval (null for a single row)."""
    half = Z95 * F.stddev_samp(value) / F.sqrt(F.count(value))
    return frame.groupBy(*by).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"),
        (F.avg(value) - half).alias("low"), (F.avg(value) + half).alias("high"))


#: Cumulative shares of a Poisson count of mean one, on a scale of 65,536.
POISSON_CUTS = tuple(int(65_536 * sum(exp(-1) / factorial(j) for j in range(k + 1))) for k in range(8))
_WORDS = 8  # sixteen-bit numbers in a digest
_ROWS = 2000  # rows whose draws are held at a time
_WEIGHT_OF = np.searchsorted(POISSON_CUTS, np.arange(65_536), side="right").astype(np.uint8)


def group_mean_bootstrap(frame: DataFrame, by: Sequence[str], value: str, key: Sequence[str], draws: int = 200,
                         level: float = 0.95, seed: str = "42") -> DataFrame:
    """Mean per group with the percentile interval of `draws` bootstrap means.

    In a draw each row counts as often as a Poisson number of mean one says, which is read off a digest of the row's
    `key`, so the draws need no resampling, no order and no state: weighted sums by group and draw, formed for a batch of
    rows at a time (values as doubles), so that a row is not multiplied by its draws. The same rows always give the same interval. Rows without a value do not count.
    """
    rows = frame.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_value"), F.concat_ws(
        ":", F.lit(seed), *[F.col(c).cast("string") for c in key]).alias("_key"))
    # Shares by rows, a few for every core: digests cost far more than the bytes that splits and shuffles go by.
    spark = rows.sparkSession
    rows = rows.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), _ROWS):
                yield _drawn(batch.slice(at, _ROWS), len(by), draws)

    schema = T.StructType([*rows.select(*by).schema, T.StructField("_n", T.LongType()), T.StructField("_total", T.DoubleType()),
                           T.StructField("_weights", T.ArrayType(T.LongType())), T.StructField("_sums", T.ArrayType(T.DoubleType()))])
    partial = rows.mapInArrow(run, schema).select(
        *by, "_n", "_total", F.posexplode(F.arrays_zip("_weights", "_sums")).alias("_draw", "_cell"))
    means = partial.groupBy(*by, "_draw").agg(
        F.sum("_n").alias("_n"), F.sum("_total").alias("_total"),
        F.try_divide(F.sum("_cell._sums"), F.sum("_cell._weights")).alias("_mean")).where(F.col("_mean").isNotNull())
    side = (1 - level) / 2
    return means.groupBy(*by).agg(
        F.max("_n").alias("n"), F.min_by(F.col("_total") / F.col("_n"), "_draw").alias("mean"),
        F.percentile("_mean", [side, 1 - side]).alias("_bounds"),  # `draws` numbers a group
    ).select(*by, "n", "mean", F.col("_bounds")[0].alias("low"), F.col("_bounds")[1].alias("high"))


def _drawn(rows: pa.RecordBatch, grouped: int, draws: int) -> pa.RecordBatch:
    """For each group of the rows (the first `grouped` columns): rows, their sum, and by draw weights and weighted sum."""
    group = np.zeros(len(rows), dtype=np.int64)
    for column in rows.columns[:grouped]:
        codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
        group = np.unique(group * (codes.max() + 1) + codes, return_inverse=True)[1]
    _, first, group = np.unique(group, return_index=True, return_inverse=True)
    ends = [f":{block}".encode() for block in range(-(-draws // _WORDS))]
    digests = b"".join([md5(key + end).digest() for key in rows.column("_key").cast(pa.binary()).to_pylist() for end in ends])
    words = np.frombuffer(digests, dtype=">u2").reshape(len(rows), -1)[:, :draws]
    weights, values = _WEIGHT_OF[words], rows.column("_value").to_numpy(zero_copy_only=False)
    counts, sums = np.zeros((len(first), draws), np.int64), np.zeros((len(first), draws))
    for g in range(len(first)):
        own = group == g
        counts[g] = weights[own].sum(axis=0, dtype=np.int64)
        # A row that is not drawn does not count, whatever its value.
        sums[g] = np.where(weights[own] > 0, weights[own] * values[own, None], 0.0).sum(axis=0)
    offsets = pa.array(np.arange(len(first) + 1) * draws, pa.int32())
    table = [c.take(pa.array(first)) for c in rows.columns[:grouped]]
    return pa.RecordBatch.from_arrays(
        [*table, pa.array(np.bincount(group, minlength=len(first))), pa.array(np.bincount(group, values, len(first))),
         pa.ListArray.from_arrays(offsets, pa.array(counts.ravel())), pa.ListArray.from_arrays(offsets, pa.array(sums.ravel()))],
        names=[*rows.schema.names[:grouped], "_n", "_total", "_weights", "_sums"])


def corr_matrix(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair of columns: (`a`, `b`, `corr`), from one aggregate.

    Rows that are null in either column of a pair do not count for that pair.
    """
    pairs = list(combinations_with_replacement(columns, 2))
    names = {pair: f"c{i}" for i, pair in enumerate(pairs)}
    row = frame.agg(*[F.corr(a, b).alias(names[a, b]) for a, b in pairs])
    cells: list[Column] = []
    for a, b in pairs:
        for left, right in dict.fromkeys([(a, b), (b, a)]):
            cells.append(F.struct(F.lit(left).alias("a"), F.lit(right).alias("b"), F.col(names[a, b]).alias("corr")))
    return row.select(F.inline(F.array(*cells)))


def corr_rank(frame: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Correlation of each column with the target, strongest positive first, the target itself left out."""
    others = [c for c in columns if c != target]
    row = frame.agg(*[F.corr(c, target).alias(f"c{i}") for i, c in enumerate(others)])
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("corr")) for i, c in enumerate(others)]
    return row.select(F.inline(F.array(*cells))).orderBy(F.desc("corr"), "column")
