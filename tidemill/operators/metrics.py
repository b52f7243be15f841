"""Scores of a 0/1 classifier from its actual and predicted columns, in one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _outcomes(frame: DataFrame, actual: str, predicted: str) -> DataFrame:
    a, p = F.col(actual) == 1, F.col(predicted) == 1
    return frame.agg(
        F.count_if(a & p).alias("tp"), F.count_if(~a & p).alias("fp"),
        F.count_if(a & ~p).alias("fn"), F.count_if(~a & ~p).alias("tn"))


def classification_metrics(frame: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Accuracy, recall, precision and F1 of the positive class 1; a score without a denominator is 0."""
    def ratio(top, bottom):
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return _outcomes(frame, actual, predicted).select(
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def confusion_matrix(frame: DataFrame, actual: str, predicted: str) -> DataFrame:
    """The full 2x2 table in the label order 1, 0; an outcome that never occurs counts 0."""
    cells = ((1, 1, "tp"), (1, 0, "fn"), (0, 1, "fp"), (0, 0, "tn"))
    return _outcomes(frame, actual, predicted).select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n")) for a, p, c in cells])))
