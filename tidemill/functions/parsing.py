"""JSON text to columns, parsed once per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_json(lines: DataFrame, schema: str, options: dict[str, str] | None = None, column: str = "value") -> DataFrame:
    """Replace the text column by the fields of its JSON object; other columns stay in front.

    The object passes through a Generate of one row. Over a plain projection the optimiser would repeat the parse in
    every filter that later steps put on a field.
    """
    kept = [c for c in lines.columns if c != column]
    return lines.select(*kept, F.inline(F.array(F.from_json(column, schema, options or {}))))
