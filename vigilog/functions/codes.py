"""Expressions over the enumerated fields."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigilog import schema as S


def _case(c: Column, pairs, otherwise) -> Column:
    """CASE over (values, result) pairs."""
    out = None
    for values, result in pairs:
        hit = c.isin(*values)
        out = F.when(hit, F.lit(result)) if out is None else out.when(hit, F.lit(result))
    return out.otherwise(F.lit(otherwise))


def severity_rank(severity: Column) -> Column:
    """INFO 1 .. CRITICAL 5; anything else, null included, 0."""
    return _case(severity, [([s], i + 1) for i, s in enumerate(S.SEVERITIES)], 0)


def log_level(severity: Column) -> Column:
    # Severity to log level.
    return _case(severity, [(["INFO", "LOW"], "INFO"), (["MEDIUM"], "WARNING"),
                            (["HIGH"], "ERROR"), (["CRITICAL"], "CRITICAL")], "INFO")


def is_high(severity: Column) -> Column:
    return severity.isin(*S.HIGH_SEVERITIES)


def event_category(event_type: Column) -> Column:
    """Category of a known type, null for an unknown one."""
    return _case(event_type, [(types, name) for name, types in S.CATEGORY_OF_TYPE.items()], None)


def display_category(event_type: Column) -> Column:
    """Display class by substring; the first rule that matches wins."""
    # Display class and the text parts that select it.
    rules = [
        ("green", ["LOGIN_SUCCESS", "LOGOUT"]),
        ("yellow", ["LOGIN_FAILURE", "ACCOUNT_LOCKOUT", "MFA_CHALLENGE"]),
        ("red", ["UNAUTHORIZED", "PRIVILEGE", "DATA_EXFILTRATION"]),
        ("blue", ["DATA_"]),
        ("cyan", ["SYSTEM_", "CONFIG_"]),
    ]
    arms = [F.when(reduce(or_, [event_type.contains(p) for p in parts]), F.lit(name)) for name, parts in rules]
    return F.coalesce(*arms, F.lit("white"))


def severity_color(severity: Column) -> Column:
    # Display colour per severity.
    return _case(severity, [(["INFO"], "green"), (["LOW"], "blue"), (["MEDIUM"], "yellow"),
                            (["HIGH"], "red"), (["CRITICAL"], "magenta")], "white")


def derive_tags(event_type: Column, user_type: Column) -> Column:
    """The tags that follow from type and user; optional audit and channel tags cannot be derived."""
    return F.array_compact(F.array(
        event_category(event_type),
        F.lower(user_type),
        F.when(event_type.isin(*S.THREAT_TYPES), F.lit("security-threat")),
        F.when(event_type.isin(*S.ALERT_TYPES), F.lit("security-alert")),
    ))


def severity_in_domain(event_type: Column, severity: Column) -> Column:
    """Whether a severity is one its type may carry; null for an unknown type."""
    out = None
    for types, severities in S.SEVERITY_DOMAINS:
        hit, ok = event_type.isin(*types), severity.isin(*severities)
        out = F.when(hit, ok) if out is None else out.when(hit, ok)
    return out


def expected_status(event_type: Column, mfa_success: Column) -> Column:
    """Status code of a type; an MFA challenge depends on its outcome."""
    out = F.when(event_type == "MFA_CHALLENGE",
                 F.when(mfa_success, F.lit(200)).when(~mfa_success, F.lit(401)))
    for status, types in S.STATUS_OF_TYPE:
        out = out.when(event_type.isin(*types), F.lit(status))
    return out


def rate_mode(per_minute: Column) -> Column:
    # Rate bounds and their labels.
    return (F.when(per_minute <= 30, F.lit("Slow Mode"))
            .when(per_minute <= 100, F.lit("Normal Rate"))
            .otherwise(F.lit("High Rate")))
