"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_enum_prefix(c: Column) -> Column:
    """``EventType.LOGOUT`` -> ``LOGOUT``; plain values pass."""
    return F.regexp_replace(c, r"^(EventType|Severity|UserType)\.", "")


def city_country(geo: Column) -> Column:
    """``City, Country``; the country alone without a city; ``Unknown`` without a location."""
    city, country = geo["city"], geo["country"]
    return (F.when(geo.isNull(), F.lit("Unknown"))
            .when(F.coalesce(city, F.lit("")) != "", F.concat(city, F.lit(", "), F.coalesce(country, F.lit(""))))
            .otherwise(F.coalesce(country, F.lit("Unknown"))))


def country_city(geo: Column) -> Column:
    """``Country, City`` when either is there, else the empty text."""
    country, city = F.coalesce(geo["country"], F.lit("")), F.coalesce(geo["city"], F.lit(""))
    return F.when((country != "") | (city != ""), F.concat(country, F.lit(", "), city)).otherwise(F.lit(""))


def join_tags(tags: Column) -> Column:
    return F.coalesce(F.array_join(tags, ", "), F.lit(""))


def two_decimals(x: Column) -> Column:
    return F.format_string("%.2f", x)


def stable_id(raw: Column) -> Column:
    """Id for a record that came without one: the same on every replay."""
    return F.sha2(raw, 256)
