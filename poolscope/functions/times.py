"""Clocks and record times. All values are epoch seconds; nothing depends on a session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def epoch_seconds(ntz: str) -> Column:
    """Epoch seconds of a ``timestamp_ntz`` SQL expression read as UTC."""
    return F.expr(f"timestampdiff(SECOND, {_EPOCH}, {ntz})")


def record_time(status: Column, completion: Column, hook_done: Column, launch_time: int) -> Column:
    """When the job left the queue, else when the document was made."""
    left_queue = F.coalesce(F.nullif(completion, F.lit(0)), F.nullif(hook_done, F.lit(0)))
    return F.when(status.isin(3, 4, 6), F.coalesce(left_queue, F.lit(launch_time))).otherwise(
        F.lit(launch_time)
    )


def task_creation_time(workflow: Column) -> Column:
    """Creation time carried by a task name: ``190309_085131:user_...``; NULL when there is none."""
    stamp = F.split_part(workflow, F.lit(":"), F.lit(1))
    iso = F.regexp_replace(
        stamp,
        r"^(\d{2})(\d{2})(\d{2})_(\d{2})(\d{2})(\d{2})$",
        "20$1-$2-$3 $4:$5:$6",
    )
    # text that does not have the pattern is left as it was, so check the shape too
    shaped = F.when(stamp.rlike(r"^\d{6}_\d{6}$"), iso)
    parsed = shaped.try_cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", F.expr(_EPOCH), parsed)


def utc_day(epoch: Column) -> Column:
    """Calendar day of an epoch second in UTC, as a date."""
    days = F.floor(epoch / F.lit(86400)).cast("int")
    return F.date_add(F.to_date(F.lit("1970-01-01")), days)


def bucket_start(epoch: Column, width: int) -> Column:
    """Start of the tumbling window of ``width`` seconds that holds an epoch second."""
    return epoch - F.pmod(epoch, F.lit(width))


def to_millis(epoch: Column) -> Column:
    """Epoch seconds to milliseconds; NULL stays NULL."""
    return epoch * F.lit(1000)
