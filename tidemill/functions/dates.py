"""Epoch-millisecond and calendar helpers.

Every helper takes the zone as an argument and works on TIMESTAMP_NTZ, so a result never depends on
`spark.sql.session.timeZone`. All of them are built-in expressions and stay inside code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shop zone and text patterns.
SHOP_ZONE = "+08:00"
DATE_PATTERN = "yyyy-MM-dd"
PARTITION_PATTERN = "yyyyMMdd"
DATETIME_PATTERN = "yyyy-MM-dd HH:mm:ss"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def millis_of_utc(column: Column | str) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ that holds UTC clock time.

    Built from the clock's fields: the difference functions would first cast to the session zone.
    """
    clock = _col(column)
    minutes = (F.unix_date(clock.cast("date")).cast("long") * 24 + F.hour(clock)) * 60 + F.minute(clock)
    return minutes * 60_000 + F.floor(F.extract(F.lit("SECOND"), clock) * 1000).cast("long")


def local_clock(millis: Column | str, zone: str = SHOP_ZONE) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ showing the clock of `zone`."""
    utc = F.timestamp_add("MILLISECOND", _col(millis), _epoch())
    return utc if zone in ("UTC", "+00:00") else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def ts_to_day(millis: Column | str, zone: str = SHOP_ZONE) -> Column:
    """Epoch milliseconds -> DATE in `zone`."""
    return local_clock(millis, zone).cast("date")


def ts_to_date(millis: Column | str, zone: str = SHOP_ZONE) -> Column:
    """Epoch milliseconds -> 'yyyy-MM-dd'."""
    return ts_to_day(millis, zone).cast("string")


def ts_to_datetime(millis: Column | str, zone: str = SHOP_ZONE) -> Column:
    """Epoch milliseconds -> 'yyyy-MM-dd HH:mm:ss' (the fraction is cut off)."""
    return F.substring(local_clock(millis, zone).cast("string"), 1, 19)


def ts_to_partition(millis: Column | str, zone: str = SHOP_ZONE) -> Column:
    """Epoch milliseconds -> 'yyyyMMdd', the name of a day partition."""
    return F.replace(ts_to_date(millis, zone), F.lit("-"), F.lit(""))


def datetime_to_ts(text: Column | str, zone: str = SHOP_ZONE) -> Column:
    """'yyyy-MM-dd HH:mm:ss' in `zone` -> epoch milliseconds; other text raises an error."""
    clock = F.to_timestamp_ntz(_col(text), F.lit(DATETIME_PATTERN))
    return millis_of_utc(F.convert_timezone(F.lit(zone), F.lit("UTC"), clock))


def date_to_ts(text: Column | str, zone: str = SHOP_ZONE) -> Column:
    """'yyyy-MM-dd' -> epoch milliseconds of that midnight in `zone`."""
    return datetime_to_ts(F.concat(_col(text), F.lit(" 00:00:00")), zone)


def window_format(clock: Column | str, pattern: str) -> Column:
    """Format a timestamp with any pattern; a pattern without letters comes out as it stands."""
    return F.date_format(_col(clock), pattern)
