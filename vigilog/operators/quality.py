"""The record contract as table checks. They report; they never repair."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog import schema as S
from vigilog.functions import codes, text, times

REQUIRED = ["event_id", "event_type", "user_id", "ip_address", "user_agent", "status_code", "message"]


def contract_rules(columns: list[str]) -> dict[str, Column]:
    """Violation code -> condition under which a row violates it, for the columns at hand."""
    rules = {f"missing_{c}": F.col(c).isNull() for c in REQUIRED if c in columns}
    for c, domain in [("event_type", S.EVENT_TYPES), ("user_type", S.USER_TYPES), ("severity", S.SEVERITIES)]:
        if c in columns:
            rules[f"bad_{c}"] = F.col(c).isNotNull() & ~text.strip_enum_prefix(F.col(c)).isin(*domain)
    if "timestamp" in columns:
        rules["bad_timestamp"] = F.col("timestamp").isNotNull() & times.parse_iso(F.col("timestamp")).isNull()
    if "geo_location" in columns:
        rules["missing_country"] = F.col("geo_location").isNotNull() & F.col("geo_location.country").isNull()
    return rules


def conformance_rules(columns: list[str]) -> dict[str, Column]:
    """Checks between fields; a row they cannot judge is not a violation."""
    rules = {}
    if {"event_type", "severity"} <= set(columns):
        rules["severity_not_of_type"] = ~codes.severity_in_domain(F.col("event_type"), F.col("severity"))
    if {"event_type", "status_code", "additional_info"} <= set(columns):
        success = F.get_json_object("additional_info", "$.success") == "true"
        rules["status_not_of_type"] = F.col("status_code") != codes.expected_status(F.col("event_type"), success)
    if {"event_type", "tags"} <= set(columns):
        rules["category_tag_missing"] = ~F.array_contains(
            F.col("tags"), F.coalesce(codes.event_category(F.col("event_type")), F.lit("")))\
            & codes.event_category(F.col("event_type")).isNotNull()
    if {"user_type", "tags"} <= set(columns):
        rules["user_tag_differs"] = ~F.array_contains(F.col("tags"), F.coalesce(F.lower("user_type"), F.lit("")))\
            & F.col("user_type").isNotNull()
    return {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}


def with_violations(events: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    rules = rules or contract_rules(events.columns)
    codes_ = [F.when(rule, F.lit(name)) for name, rule in rules.items()]
    return events.withColumn("violations", F.array_compact(F.array(*codes_)))


def split_valid(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid); the invalid rows get their violation codes, which valid ones need not pay for."""
    bad = reduce(or_, contract_rules(events.columns).values())
    return events.filter(~bad), with_violations(events.filter(bad))


def violation_counts(events: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Rows per violated rule, rules nobody violates included.

    All counters are taken in one pass without a shuffle of rows; the single
    result row is then turned on its side.
    """
    rules = rules or contract_rules(events.columns)
    counters = events.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    return counters.unpivot([], list(rules), "rule", "n")
