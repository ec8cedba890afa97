"""Resource use: processors, time, memory, efficiency and benchmark-weighted values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolscope.functions.casting import to_long

SECONDS_PER_HOUR = 3600.0


def hours(seconds: Column) -> Column:
    """Seconds as hours; a missing duration is zero."""
    return F.coalesce(seconds, F.lit(0)) / F.lit(SECONDS_PER_HOUR)


def _digits(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("bigint")


def requested_cpus(
    requested: Column, gateway_text: Column, grid_text: Column, xcount: Column
) -> Column:
    """Processors asked for: stated, else read from the gateway texts, else a count, else one.

    ``requested`` is an integer that may be NULL; a stated value that is no number counts as
    one, see :func:`stated_cpus`.
    """
    derived = F.coalesce(
        # The notations of two gateway types.
        _digits(gateway_text, r"CPUNumber = (\d+)"),
        _digits(grid_text, r"\(count=(\d+)\)"),
        xcount,
        F.lit(1).cast("bigint"),
    )
    return F.coalesce(requested, derived)


def stated_cpus(requested: Column, dtype: T.DataType) -> Column:
    """The stated number of processors: text that is no integer counts as one."""
    if isinstance(dtype, T.LongType):
        return requested
    stated = F.coalesce(to_long(requested, dtype), F.lit(1).cast("bigint"))
    return F.when(requested.isNotNull(), stated)


def running_since(status: Column, entered: Column, now: int) -> Column:
    """Seconds a job has been running when it is running, else NULL."""
    return F.when((status == 2) & (entered < F.lit(now)), F.lit(now) - entered)


def pilot_minutes_left(
    analysis: Column, status: Column, last_match: Column, pilot_end: Column, entered: Column
) -> Column:
    """Whole minutes between the start of a running analysis job and the end of its pilot.

    -1 for other jobs, minus three days when the pilot's end is not known.
    """
    left = ((pilot_end - entered) / F.lit(60)).cast("bigint")
    known = F.coalesce(left, F.lit(-72 * 60).cast("bigint"))
    applies = analysis & (status == 2) & last_match.isNotNull()
    return F.when(applies, known).otherwise(F.lit(-1).cast("bigint"))


def cpu_efficiency(wall_hours: Column, cpu_hours: Column, cpus: Column) -> Column:
    """Processor time over wall time per processor, in percent; 0 for jobs without wall time."""
    per_wall = F.try_divide(F.lit(100) * cpu_hours, wall_hours)
    return F.when(wall_hours == 0, F.lit(0.0)).otherwise(
        F.try_divide(per_wall, cpus.cast("double"))
    )


def lost_hours(used: Column, useful: Column) -> Column:
    """Hours used beyond the useful ones, never negative."""
    return F.greatest(used - useful, F.lit(0.0))


def weighted_by_score(name: str, value: Column, score: Column) -> Column:
    """Benchmark-weighted value: rates are divided by the score, the rest is multiplied by it.

    Rates and times per event are weighted only when they are positive.
    """
    if name.endswith("EventRate"):
        return F.when(value > 0, F.try_divide(value, score))
    if name.endswith("PerEvent"):
        return F.when(value > 0, value * score)
    return value * score
