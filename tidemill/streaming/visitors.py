"""The new-visitor repair on a stream: per device one remembered day in the state store."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tidemill.functions.dates import SHOP_ZONE, ts_to_day
from tidemill.operators.visitors import MODES

# Fixed value: how long a device's day is remembered after it was last written, in a live run.
STATE_TTL_MS = 10_000


def repair_days(days: np.ndarray, claims: np.ndarray, remembered: float, mode: str) -> tuple[np.ndarray, float]:
    """Walk one device's ordered records; `remembered` is a day number or NaN. Returns refuted claims and the new day."""
    written = np.full(len(days), np.nan)
    start = 0
    if np.isnan(remembered):
        if mode == "as_documented":
            written[0] = days[0] if claims[0] else days[0] - 1
        elif claims.any():
            start = int(claims.argmax())
            written[start] = days[start]
        else:
            start = len(days)
    if mode == "as_written":
        later = ~claims & (np.arange(len(days)) >= start)
        written[later] = days[later] - 1
    known = pd.Series(np.concatenate(([remembered], written))).ffill().to_numpy()
    before = known[:-1]
    return claims & ~np.isnan(before) & (before != days), known[-1]


class _VisitorDay(StatefulProcessor):
    def __init__(self, order: Sequence[str], mode: str, ttl_ms: int | None):
        self._order, self._mode, self._ttl = list(order), mode, ttl_ms

    def init(self, handle) -> None:
        schema = T.StructType([T.StructField("day", T.LongType())])
        self._day = handle.getValueState("day", schema, self._ttl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # The rows of one device in one micro-batch; the source's rate limit bounds them.
        records = pd.concat(list(rows), ignore_index=True).sort_values(self._order, kind="stable", ignore_index=True)
        held = self._day.get() if self._day.exists() else None
        claims = (records["is_new"] == "1").to_numpy(dtype=bool)
        remembered = float("nan") if held is None else float(held[0])
        refuted, day = repair_days(records["day_number"].to_numpy(dtype=float), claims, remembered, self._mode)
        touched = (~claims).any() if self._mode == "as_written" else False
        if not np.isnan(day) and (held is None or day != remembered or touched):
            self._day.update((int(day),))
        records.loc[refuted, "is_new"] = "0"
        yield records.drop(columns="day_number")

    def close(self) -> None:
        pass


def repair_visitor_stream(logs: DataFrame, order: Sequence[str] = ("ts",), mode: str = "as_written",
                          zone: str = SHOP_ZONE, ttl_ms: int | None = None) -> DataFrame:
    """Streaming counterpart of `repair_visitors` for columns `mid`, `is_new`, `ts` and any others Arrow can carry.

    Needs the RocksDB state store. With `ttl_ms` a device is forgotten that long after its day was last written;
    such a query runs on processing time and has to be stopped, it does not end by itself.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    dated = logs.withColumn("day_number", F.unix_date(ts_to_day("ts", zone)).cast("long"))
    return dated.groupBy("mid").transformWithStateInPandas(
        statefulProcessor=_VisitorDay(order, mode, ttl_ms),
        outputStructType=logs.schema,
        outputMode="Append",
        timeMode="ProcessingTime" if ttl_ms else "None",
    )
