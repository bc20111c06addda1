"""Row-level views: display rows, sorting, top rows and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.functions import codes, numbers, text, times
from vigilog.operators.ordered import with_position

PAGE_SIZE = 50
HIGH_SEVERITY_ROWS = 10


def high_severity(events: DataFrame) -> DataFrame:
    return events.filter(codes.is_high(F.col("severity")))


def with_location(events: DataFrame) -> DataFrame:
    return events.filter(F.col("geo_location").isNotNull())


def sort_key(field: str) -> Column:
    """Sort expression of a display field; text fields treat null as the empty text."""
    empty = F.lit("")
    return {
        "Time": F.col("ts"),
        "Type": F.coalesce("event_type", empty),
        "Severity": codes.severity_rank(F.col("severity")),
        "User": F.coalesce("user_id", empty),
        "Source IP": F.coalesce("ip_address", empty),
        "Location": text.country_city(F.col("geo_location")),
        "Message": F.coalesce("message", empty),
    }[field]


def ordering(field: str = "Time", ascending: bool = False) -> list[Column]:
    """Ties stay in arrival order in both directions."""
    key = sort_key(field)
    return [key.asc() if ascending else key.desc(), F.col("arrival_seq").asc()]


def sort_events(events: DataFrame, field: str = "Time", ascending: bool = False) -> DataFrame:
    return events.orderBy(*ordering(field, ascending))


def sorted_positions(events: DataFrame, field: str = "Time", ascending: bool = False) -> DataFrame:
    """The whole table with each event's place in the sorted view as ``pos``."""
    return with_position(events, ordering(field, ascending))


def display_rows(events: DataFrame) -> DataFrame:
    """The columns a reader sees."""
    return events.select(
        "event_id",
        times.clock_text(F.col("timestamp")).alias("time"),
        F.coalesce("event_type", F.lit("")).alias("type"),
        F.coalesce("severity", F.lit("INFO")).alias("severity"),
        F.coalesce("user_id", F.lit("")).alias("user"),
        F.coalesce("ip_address", F.lit("")).alias("source_ip"),
        text.country_city(F.col("geo_location")).alias("location"),
        F.coalesce("message", F.lit("")).alias("message"))


def first_rows(events: DataFrame, n: int, field: str = "Time", ascending: bool = False) -> DataFrame:
    """The first n rows of the sorted view; each task keeps n rows, nothing is fully sorted."""
    return sort_events(events, field, ascending).limit(n)


def page(events: DataFrame, number: int, size: int = PAGE_SIZE, field: str = "Time",
         ascending: bool = False) -> DataFrame:
    """Page ``number`` (from 1) of the sorted view. For pages far down use ``page_after``."""
    return sort_events(events, field, ascending).offset((number - 1) * size).limit(size)


def page_after(events: DataFrame, last_key, last_seq: int, size: int = PAGE_SIZE, field: str = "Time",
               ascending: bool = False) -> DataFrame:
    """The page behind a known last row (its sort key and ``arrival_seq``).

    The cost does not grow with the depth of the page. The key must not be null.
    """
    key = sort_key(field)
    beyond = key > F.lit(last_key) if ascending else key < F.lit(last_key)
    if field == "Time" and not ascending:
        beyond = beyond | key.isNull()
    tie = (key == F.lit(last_key)) & (F.col("arrival_seq") > last_seq)
    return first_rows(events.filter(beyond | tie), size, field, ascending)


def page_info(events: DataFrame, number: int, size: int = PAGE_SIZE) -> DataFrame:
    """Total, number of pages, and first and last row number of a page."""
    total = F.col("total")
    return events.agg(F.count(F.lit(1)).alias("total")).select(
        "total", numbers.page_count(total, size).alias("pages"),
        F.least(total, F.lit((number - 1) * size + 1)).alias("first_row"),
        F.least(total, F.lit(number * size)).alias("last_row"))


def retain_last(events: DataFrame, n: int = 1000) -> DataFrame:
    """The n events that arrived last."""
    return events.orderBy(F.desc("arrival_seq")).limit(n)
