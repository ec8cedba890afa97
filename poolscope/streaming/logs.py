"""Events from growing log folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from poolscope.operators.logparse import parse_logs, route_logs


def log_stream(lines: DataFrame, template: str, arrived: Column | None = None) -> DataFrame:
    """Parsed and routed events of a line stream. No state.

    ``arrived`` is the day of lines without a time; by default that of the micro-batch.
    """
    return route_logs(parse_logs(lines), template, F.current_timestamp() if arrived is None else arrived)


def write_log_stream(
    events: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append events to a store partitioned by day."""
    writer = (
        events.writeStream.format("parquet")
        .partitionBy("date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime="1 minute").start()
