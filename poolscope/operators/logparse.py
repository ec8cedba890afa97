"""Log lines to typed events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --------------------------------------------------------------------------------------
# The messages the monitoring runs write. Patterns match anywhere in a line.
# --------------------------------------------------------------------------------------
_NUMBER = r"([+-]?(?:[0-9]+(?:\.[0-9]+)?|\.[0-9]+))"
_COUNT = r"\b([0-9]+)\b"
_POSITIVE = r"\b([1-9][0-9]*)\b"
_QUOTED = r"""("(?:\\.|[^\\"])*"|'(?:\\.|[^\\'])*')"""

# (message type, literal part, pattern, captured fields)
MESSAGES: list[tuple[str, str, str, tuple[str, ...]]] = [
    (
        "history_schedd_response",
        "history: response count:",
        rf"Schedd (.*?)\s*history: response count:\s*{_COUNT}; last completion .*?; query time {_NUMBER} min",
        ("schedd_name", "response_count", "query_time"),
    ),
    (
        "queue_schedd_response",
        "queue: response count:",
        rf"Schedd (.*?)\s*queue: response count:\s*{_COUNT}; query time {_NUMBER} min;",
        ("schedd_name", "response_count", "query_time"),
    ),
    (
        "queue_end",
        "Processing time for queues:",
        rf"Processing time for queues: {_NUMBER} mins, {_COUNT}/{_COUNT} docs sent in {_NUMBER} min of total upload time",
        ("queue_processing_time", "total_sent", "total_received", "total_upload_time"),
    ),
    (
        "history_end",
        "Processing time for history:",
        rf"Processing time for history: {_NUMBER} mins",
        ("history_processing_time",),
    ),
    (
        "es_failed_to_index",
        "documents to ES:",
        rf"Failed to index {_POSITIVE} documents to ES: (.*)",
        ("n_failed_to_index", "es_error_message"),
    ),
    (
        "failed_to_query",
        "Failed to query schedd for job history:",
        r"Failed to query schedd for job history: (.*?)",
        ("schedd_name",),
    ),
    (
        "failed_to_process_history",
        "Failure when processing schedd history query on",
        r"Failure when processing schedd history query on (.*?): (.*)",
        ("schedd_name", "error_message"),
    ),
    (
        "failed_to_query",
        "Failed to query schedd",
        r"Failed to query schedd (.*?) for jobs: (.*)",
        ("schedd_name", "error_message"),
    ),
    (
        "failed_to_convert",
        "Failure when converting document on",
        r"Failure when converting document on (.*?) history: (.*)",
        ("schedd_name", "error_message"),
    ),
    (
        "schedd_history_timeout",
        "history timed out; ignoring progress",
        r"Schedd (.*?) history timed out; ignoring progress.",
        ("schedd_name",),
    ),
    (
        "schedd_queue_outoftime",
        "Queue crawler on",
        rf"Queue crawler on (.*?) has been running for more than {_COUNT} minutes; exiting",
        ("schedd_name", "timelimit"),
    ),
    (
        "schedd_queue_nostart",
        "No time remaining to run queue crawler on",
        r"No time remaining to run queue crawler on (.*?); exiting.",
        ("schedd_name",),
    ),
    (
        "schedd_queue_timeout",
        "queue timed out; ignoring progress",
        r"Schedd (.*?) queue timed out; ignoring progress.",
        ("schedd_name",),
    ),
    (
        "listener_end",
        "Closing listener, received",
        rf"Closing listener, received {_POSITIVE} documents total",
        ("listener_total_received",),
    ),
    (
        "es_timeout_error",
        "ConnectionTimeout: ConnectionTimeout caused by -",
        r"ConnectionTimeout: ConnectionTimeout caused by - (.*)",
        ("es_error_message",),
    ),
    (
        "load_local_validation_schema",
        "Successfully loaded local schema",
        r"Successfully loaded local schema (.*?) for validation",
        ("validation_schema",),
    ),
    (
        "invalid_local_validation",
        "is not json compliant",
        r"Local schema (.*?) is not json compliant",
        ("validation_schema",),
    ),
    (
        "validation_schema_not_found",
        "Schema not found:",
        rf"Schema not found: {_QUOTED}",
        ("validation_schema",),
    ),
    (
        "validation_fail_unknown_key",
        "contains keys not present in schema",
        rf"Document (.*?) contains keys not present in schema {_QUOTED}",
        ("globaljobid", "schema"),
    ),
    (
        "validation_fail_conflict",
        "conflicts with schema",
        rf"Document (.*?) conflicts with schema {_QUOTED}",
        ("globaljobid", "schema"),
    ),
    (
        "validator_unknown_key",
        "SCHEMA_VALIDATOR: unknown key=",
        r"SCHEMA_VALIDATOR: unknown key=(.*?), val=(.*)",
        ("unknown_key", "unknown_key_value"),
    ),
    (
        "validator_invalid_nested",
        "SCHEMA_VALIDATOR: for sub schema=",
        r"SCHEMA_VALIDATOR: for sub schema=.*? val=.*? has wrong data-types",
        (),
    ),
    (
        "validator_inconsistent_list",
        "has inconsistent data-types",
        r"SCHEMA_VALIDATOR: for key=(.*?) val=(.*?) has inconsistent data-types",
        ("offending_key", "offending_value"),
    ),
    (
        "validator_incorrect_type_in_list",
        "has incorrect data-type in list, found",
        r"SCHEMA_VALIDATOR: for key=(.*?) val=(.*?) has incorrect data-type in list, found .*? expect ",
        ("offending_key", "offending_value"),
    ),
    (
        "validator_incorrect_type",
        "has incorrect data-type, found",
        r"SCHEMA_VALIDATOR: for key=(.*?) val=(.*?) has incorrect data-type, found .*? expect ",
        ("offending_key", "offending_value"),
    ),
    (
        "amq_bunching",
        "Bunching records for AMQP in sizes of",
        rf"Bunching records for AMQP in sizes of {_COUNT}",
        ("amq_bunch_size",),
    ),
    (
        "script_start",
        "&&& There are",
        rf"&&& There are {_POSITIVE} schedds to query.",
        ("n_schedds",),
    ),
    (
        "script_end",
        "@@@ Total processing time:",
        rf"@@@ Total processing time: {_NUMBER} mins",
        ("total_processing_time",),
    ),
    (
        "inconsistent_doc_number",
        "Number of queried docs not equal to number of processed docs",
        r"Number of queried docs not equal to number of processed docs.",
        (),
    ),
    (
        "listener_premature_close",
        "Closing listener before all schedds were processed",
        r"Closing listener before all schedds were processed",
        (),
    ),
    (
        "listener_abort",
        "Listener did not shut down properly; terminating",
        r"Listener did not shut down properly; terminating.",
        (),
    ),
]

# Lines that are not worth keeping.
NOISE = "SCHEMA_VALIDATOR: unknown key="

# "2019-03-26 09:48:02,689 : root:WARNING - text"
_HEADER = (
    r"(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:[.,]\d+)?) : (\w+):"
    r"(TRACE|DEBUG|NOTICE|INFO|WARN(?:ING)?|ERR(?:OR)?|CRIT(?:ICAL)?|FATAL|SEVERE|EMERG(?:ENCY)?|ALERT) - (.*)"
)

FIELD_TYPES = {
    "bigint": """
        response_count total_sent total_received n_failed_to_index timelimit
        listener_total_received amq_bunch_size n_schedds
    """.split(),
    "double": """
        query_time queue_processing_time total_upload_time history_processing_time
        total_processing_time
    """.split(),
}


def parse_headers(lines: DataFrame) -> DataFrame:
    """Split lines into time, source, level and message; drop noise.

    A line without a header is a message as a whole. ``timestamp`` is a zone-free timestamp.
    """
    kept = lines.filter(~F.col("value").contains(NOISE))
    part = lambda group: F.nullif(F.regexp_extract("value", _HEADER, group), F.lit(""))
    stamp = F.regexp_replace(part(1), ",", ".")
    headed = F.col("value").rlike(_HEADER)
    return kept.select(
        "*",
        stamp.try_cast("timestamp_ntz").alias("timestamp"),
        part(2).alias("log_source"),
        part(3).alias("log_level"),
        F.when(headed, F.regexp_extract("value", _HEADER, 4)).otherwise(F.col("value")).alias("message"),
    )


def classify_messages(events: DataFrame) -> DataFrame:
    """Message types and the values inside the messages.

    ``message_types`` lists every pattern that fits; ``message_type`` is the first of them.
    Patterns are tried only on messages that contain their literal part, and values are taken
    only from messages of a fitting type.
    """
    message = F.col("message")
    fits = [message.contains(literal) & message.rlike(pattern) for _, literal, pattern, _ in MESSAGES]
    matches = F.array_compact(
        F.array(*[F.when(fit, F.lit(number)) for number, fit in enumerate(fits)])
    )
    rows = events.withColumn("_fits", matches)
    names = F.array(*[F.lit(name) for name, *_ in MESSAGES])
    types = F.transform("_fits", lambda i: F.get(names, i))

    sources: dict[str, list[tuple[int, str, int]]] = {}
    for number, (_, _, pattern, fields) in enumerate(MESSAGES):
        for position, field in enumerate(fields, 1):
            sources.setdefault(field, []).append((number, pattern, position))
    values = [_field(field, places).alias(field) for field, places in sources.items()]
    return rows.select(
        "*",
        F.get(types, F.lit(0)).alias("message_type"),
        types.alias("message_types"),
        *values,
    ).drop("_fits")


def _field(name: str, places: list[tuple[int, str, int]]) -> Column:
    found = F.coalesce(
        *[
            F.when(
                F.array_contains("_fits", number),
                F.nullif(F.regexp_extract("message", pattern, position), F.lit("")),
            )
            for number, pattern, position in places
        ]
    )
    for dtype, fields in FIELD_TYPES.items():
        if name in fields:
            return found.try_cast(dtype)
    return found


def parse_logs(lines: DataFrame) -> DataFrame:
    """Log lines (value, spider_source) to events; works on batches and streams alike."""
    return classify_messages(parse_headers(lines))


def route_logs(events: DataFrame, template: str, arrived: Column) -> DataFrame:
    """Events with their day and daily index ``template-YYYY-MM-DD``.

    A line without a time of its own belongs to the day it ``arrived`` (a date, or a time).
    """
    day = F.coalesce(F.to_date("timestamp"), F.to_date(arrived))
    return events.withColumn("date", day).withColumn(
        "index", F.concat(F.lit(template + "-"), day.cast("string"))
    )
