"""Wire record <-> event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilog import schema as S
from vigilog.functions import codes, text, times

CORRUPT = "_corrupt"


def parse_value(df: DataFrame, value: str = "value", schema: T.StructType = S.WIRE_EVENT) -> DataFrame:
    """Bytes or text of a record to one column per field.

    A record that is not a JSON object keeps its text in ``_corrupt``; the
    query goes on. Other columns of ``df`` pass through.

    ``inline`` keeps a filter on the fields above the parsing. As a plain
    projection it would be pushed below and every record parsed twice.
    """
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    rest = [c for c in df.columns if c != value]
    # Blank text gives no struct at all; it is marked like other unreadable text.
    blank = F.from_json(F.lit("{}"), full).withField(CORRUPT, F.coalesce("raw", F.lit("")))
    data = F.coalesce(F.from_json("raw", full, {"columnNameOfCorruptRecord": CORRUPT}), blank)
    return (df.select(*rest, F.col(value).cast("string").alias("raw"))
            .select(*rest, "raw", F.inline(F.array(data))))


def readable() -> Column:
    """Whether a parsed or scanned record was a JSON object; never null."""
    return F.col(CORRUPT).isNull()


def good_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter(readable()).drop(CORRUPT)


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Records that could not be read, with their text."""
    rest = [c for c in parsed.columns if c not in set(S.WIRE_FIELDS) | {CORRUPT, "raw"}]
    return (parsed.filter(~readable())
            .select(*rest, "raw", F.lit("unreadable record").alias("reason")))


def fill_defaults(events: DataFrame) -> DataFrame:
    """Missing and null alike take the default; a missing id becomes the hash of the record.

    That is the hash of ``raw`` or, for a table without it, of all its columns.
    """
    geo = F.col("geo_location")
    content = F.col("raw") if "raw" in events.columns else F.to_json(F.struct(*events.columns))
    return events.withColumns({
        "event_id": F.coalesce("event_id", text.stable_id(content)),
        "event_type": F.coalesce(text.strip_enum_prefix(F.col("event_type")), F.lit("UNKNOWN")),
        "severity": F.coalesce(text.strip_enum_prefix(F.col("severity")), F.lit("INFO")),
        "user_type": text.strip_enum_prefix(F.col("user_type")),
        "user_id": F.coalesce("user_id", F.lit("")),
        "ip_address": F.coalesce("ip_address", F.lit("")),
        "message": F.coalesce("message", F.lit("")),
        "geo_location": F.when(geo.isNotNull(), geo.withField(
            "country", F.coalesce(geo["country"], F.lit("Unknown")))),
    })


def with_time(events: DataFrame) -> DataFrame:
    return events.withColumn("ts", times.parse_iso(F.col("timestamp")))


def valid_timestamps(events: DataFrame) -> DataFrame:
    """Events whose time text can be read."""
    return with_time(events).filter(F.col("ts").isNotNull())


def info_map(info: Column) -> Column:
    """JSON object text to a string map; numbers, booleans and lists keep their text."""
    return F.from_json(info, T.MapType(T.StringType(), T.StringType()))


def typed_info(events: DataFrame, *event_types: str) -> DataFrame:
    """Events of these types with their typed details, one struct column per type, in one pass.

    The column has the name of the type in lower case and is null for other types.
    """
    kind = F.col("event_type")
    details = {t.lower(): F.when(kind == t, F.from_json("additional_info", T.StructType.fromDDL(S.INFO_SCHEMAS[t])))
               for t in event_types}
    return events.filter(kind.isin(*event_types)).withColumns(details)


def wire_json(events: DataFrame) -> Column:
    """The event as JSON text: ISO time with ``Z``, nulls kept, details with their own types."""
    fields = []
    for name in S.WIRE_FIELDS:
        if name == "timestamp":
            fields.append(times.iso_z(F.col("ts")).alias(name))
        elif name == "additional_info":
            fields.append(F.try_parse_json(name).alias(name))
        elif name in events.columns:
            fields.append(F.col(name))
        else:
            fields.append(F.lit(None).cast(S.WIRE_EVENT[name].dataType).alias(name))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def record_headers(source_default: str = "unknown") -> Column:
    """The six record headers; a filter on them saves parsing the value."""
    pairs = [
        ("schema-version", F.lit("1.0.0")),
        ("event-type", F.col("event_type")),
        ("severity", F.col("severity")),
        ("source", F.coalesce("source_system", F.lit(source_default))),
        ("timestamp", times.epoch_text(F.col("ts"))),
        ("correlation-id", F.coalesce("correlation_id", F.lit(""))),
    ]
    return F.array(*[F.struct(F.lit(k).alias("key"), v.cast("binary").alias("value")) for k, v in pairs])


def kafka_record(events: DataFrame) -> DataFrame:
    """Event table to ``key, value, headers``; the user is the key."""
    return events.select(
        F.col("user_id").cast("binary").alias("key"),
        wire_json(events).cast("binary").alias("value"),
        record_headers().alias("headers"),
    )


def header(headers: Column, key: str) -> Column:
    """Text of the last header with this key; null when it is absent."""
    hits = F.filter(headers, lambda h: h["key"] == key)
    return F.try_element_at(hits, F.lit(-1))["value"].cast("string")


def enum_header(headers: Column, key: str) -> Column:
    """A header that holds an enumerated value, with or without the name of its enumeration."""
    return text.strip_enum_prefix(header(headers, key))


def log_line() -> Column:
    """One line of text per event."""
    def part(c):
        return F.coalesce(c.cast("string"), F.lit("None"))
    session = F.when(F.coalesce("session_id", F.lit("")) == "", F.lit("N/A")).otherwise(F.col("session_id"))
    return F.concat(
        part(F.col("event_type")), F.lit(": User "), part(F.col("user_id")),
        F.lit(" ("), part(F.col("user_type")), F.lit(") from "), text.city_country(F.col("geo_location")),
        F.lit(" | IP: "), part(F.col("ip_address")), F.lit(" | Session: "), session,
        F.lit(" | Status: "), part(F.col("status_code")), F.lit(" | Severity: "), part(F.col("severity")),
        F.lit(" | Tags: "), text.join_tags(F.col("tags")))


def detail_line() -> Column:
    """Second line for a severe event."""
    def part(c):
        return F.coalesce(F.col(c), F.lit("None"))
    return F.concat(F.lit("DETAILS: "), part("message"), F.lit(" | Source: "), part("source_system"),
                    F.lit(" | Target: "), part("target_system"),
                    F.lit(" | Additional Info: "), F.coalesce("additional_info", F.lit("{}")))


def severe_lines(events: DataFrame) -> DataFrame:
    """The side output: HIGH and CRITICAL events with level, line and detail."""
    return (events.filter(codes.is_high(F.col("severity")))
            .select("event_id", codes.log_level(F.col("severity")).alias("log_level"),
                    log_line().alias("line"), detail_line().alias("detail")))
