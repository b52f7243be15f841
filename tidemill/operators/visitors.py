"""Repair of the new-visitor flag.

Per device the job remembers one date and walks the device's records in time order. Read as one statement over all
records of a device, the walk needs very little of them:

* `as_documented` - a record claiming a new visitor is refuted unless the device's first record made the same claim
  on the same day.
* `as_written` - the date is first stored by the earliest claim, and any later record without a claim moves it to
  the day before. So a claim is refuted when it comes on another day than the earliest claim, or after the first
  non-claim that follows the earliest claim.

Both are minima per device, which combine on the map side; a device with a third of all rows costs no more than
any other, and no device's records are sorted or held together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.dates import SHOP_ZONE, ts_to_day
from tidemill.operators.skew import HOT_ROWS, join_state
from tidemill.session import checkpoint_dir

MODES = ("as_written", "as_documented")

#: Comes before every place.
BEFORE_ALL = "-" + "9" * 38


def place_number(order: Sequence[str]) -> Column:
    """Place of a record as one number: `ts`, and a second whole-number column among records of one millisecond. Numbers
    of fixed width let minima be kept in a hash table, where a struct would have the rows sorted."""
    if order[0] != "ts" or len(order) > 2:
        raise ValueError("records are ordered by ts and at most one more column")
    place = F.col("ts").cast("decimal(18,0)") * F.lit("1" + "0" * 20).cast("decimal(21,0)")
    if len(order) == 2:
        place = place + F.coalesce(F.col(order[1]).cast("decimal(19,0)"), F.lit(0)) + F.lit(str(2**63)).cast("decimal(19,0)")
    return place.cast("decimal(38,0)")


def repair_visitors(logs: DataFrame, order: Sequence[str] = ("ts",), mode: str = "as_written",
                    zone: str = SHOP_ZONE, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Replace `is_new` by the repaired flag. `order` starts with `ts` and must order a device's records uniquely.

    What the repair needs of a record (device, claim, place, day) is checkpointed once, so that the parse behind `logs`
    runs for it and for the output and not for every step between.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if order[0] != "ts":
        raise ValueError("records are ordered by ts first; name tie-breakers after it")
    checkpoint_dir(logs.sparkSession)
    claim = F.coalesce(F.col("is_new") == "1", F.lit(False))
    whole = len(order) <= 2 and all(isinstance(logs.schema[c].dataType, T.IntegralType) for c in order)
    place = place_number(order) if whole else F.struct(*order)
    day = F.unix_date(ts_to_day("ts", zone))
    narrow = logs.select("mid", claim.alias("claim"), place.alias("place"), day.alias("day")).checkpoint()
    first = _first_records(narrow) if mode == "as_documented" else _first_claims(narrow, hot_rows)
    state = first.select("mid", "records", F.col("opened").alias("_opened"), F.col("closed").alias("_closed")).checkpoint()
    joined = join_state(logs, state, "mid", "records", hot_rows)
    refuted = claim & (~F.coalesce(day == F.col("_opened"), F.lit(False)) | F.coalesce(place > F.col("_closed"), F.lit(False)))
    return joined.withColumn("is_new", F.when(refuted, "0").otherwise(F.col("is_new"))).select(*logs.columns)


def _first_records(narrow: DataFrame) -> DataFrame:
    """Per device the day of its first record if that is a claim, else no day: then every claim is refuted."""
    claimed = F.min_by(F.when(F.col("claim"), F.col("day")), "place")
    return narrow.groupBy("mid").agg(F.count("*").alias("records"), claimed.alias("opened")).select(
        "mid", "records", "opened", F.lit(None).cast(narrow.schema["place"].dataType).alias("closed"))


def _first_claims(narrow: DataFrame, hot_rows: int) -> DataFrame:
    """Per device the day of its first claim and the place of the first non-claim after it."""
    own = F.when(F.col("claim"), F.col("place"))
    claims = narrow.groupBy("mid").agg(F.count("*").alias("records"), F.min(own).alias("claimed"),
                                       F.min_by("day", own).alias("opened")).checkpoint()
    later = join_state(narrow.where(~F.col("claim")), claims.select("mid", "records", "claimed"), "mid", "records", hot_rows)
    closed = later.where("place > claimed").groupBy("mid").agg(F.min("place").alias("closed"))
    return claims.join(closed, "mid", "left").select("mid", "records", "opened", "closed")
