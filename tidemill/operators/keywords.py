"""Search keywords counted in tumbling event-time windows. Every function takes a batch or a streaming frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.dates import SHOP_ZONE, ts_to_date, ts_to_datetime
from tidemill.functions.text import tokens

# What marks a page view as a search, and the window length.
SEARCH_PAGE = "search"
KEYWORD_ITEM = "keyword"
WINDOW_LENGTH = "10 minutes"
WINDOW_MILLIS = 600_000


def with_event_time(logs: DataFrame, millis: str = "ts", name: str = "et") -> DataFrame:
    """Add the event time of an epoch-millisecond column."""
    return logs.withColumn(name, F.timestamp_millis(millis))


def with_zero_watermark(logs: DataFrame, name: str = "et") -> DataFrame:
    """A watermark that follows the newest event with no allowed lateness."""
    return logs.withWatermark(name, "0 seconds")


def search_filter(page_log: DataFrame) -> DataFrame:
    """Keyword searches of a page log with a `page` map: (fullword, et)."""
    page = F.col("page")
    return page_log.where(
        (page["last_page_id"] == SEARCH_PAGE) & (page["item_type"] == KEYWORD_ITEM) & page["item"].isNotNull()
    ).select(page["item"].alias("fullword"), "et")


def keyword_rows(searches: DataFrame, text: str = "fullword", tokenizer=tokens) -> DataFrame:
    """One row per token; a search without any token gives no row."""
    return searches.select(F.explode(tokenizer(F.col(text))).alias("keyword"), "et")


def window_counts(keywords: DataFrame, length: str = WINDOW_LENGTH) -> DataFrame:
    """Occurrences per (tumbling window, keyword); counted on the map side before the shuffle."""
    return keywords.groupBy(F.window("et", length).alias("window"), "keyword").agg(
        F.count("*").alias("keyword_count"))


def format_windows(counts: DataFrame, zone: str = SHOP_ZONE, cur_date_literal: str | None = None) -> DataFrame:
    """Print window bounds and date in `zone`; `cur_date_literal` puts one fixed text into every `cur_date`."""
    opened, closed = F.unix_millis("window.start"), F.unix_millis("window.end")
    day = F.lit(cur_date_literal) if cur_date_literal is not None else ts_to_date(opened, zone)
    return counts.select(
        ts_to_datetime(opened, zone).alias("stt"),
        ts_to_datetime(closed, zone).alias("edt"),
        day.alias("cur_date"),
        "keyword",
        "keyword_count",
    )


def keyword_window_count(page_log: DataFrame, tokenizer=tokens, length: str = WINDOW_LENGTH,
                         zone: str = SHOP_ZONE, cur_date_literal: str | None = None) -> DataFrame:
    """Page log (`page` map, `et`) -> keyword counts per window: filter, tokenise, count, format."""
    searched = keyword_rows(search_filter(page_log), tokenizer=tokenizer)
    return format_windows(window_counts(searched, length), zone, cur_date_literal)

