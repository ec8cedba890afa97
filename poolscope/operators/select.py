"""Which records a run looks at.

Predicates are three-valued like those of the scheduler: a comparison with a missing
attribute does not select a record. They are plain column comparisons, so they reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
VANILLA_UNIVERSE = 5
UNMONITORED = "DONOTMONIT"
RUN_BUDGET_MINUTES = 60

# Salts of the first pass of a capped scan; bounds what one task may have to rank.
_CAP_SALTS = 64


def _column(ads: DataFrame, name: str, dtype: str) -> Column:
    return F.col(name) if name in ads.columns else F.lit(None).cast(dtype)


def monitored(ads: DataFrame) -> DataFrame:
    """Ordinary jobs that are not excluded from monitoring."""
    return ads.filter(
        (F.col("JobUniverse") == VANILLA_UNIVERSE) & (F.col("CMS_Type") != UNMONITORED)
    )


def changed_since(ads: DataFrame, since: Column) -> Column:
    """The job changed its state, or its post-processing was updated, since then."""
    return (F.col("EnteredCurrentStatus") >= since) | (
        _column(ads, "CRAB_PostJobLastUpdate", "double") >= since
    )


def select_history(ads: DataFrame, since: Column | int) -> DataFrame:
    """Finished-job records to read: monitored and changed since a time."""
    since = since if isinstance(since, Column) else F.lit(since)
    return monitored(ads).filter(changed_since(ads, since))


def select_queue(ads: DataFrame, start_time: int, minutes: int = RUN_BUDGET_MINUTES) -> DataFrame:
    """Queue records to read: jobs in the queue, and ended ones that changed lately."""
    since = F.lit(start_time - (minutes + 1) * 60)
    in_queue = (F.col("JobStatus") < 3) | (F.col("JobStatus") > 4)
    return monitored(ads).filter(in_queue | changed_since(ads, since))


def only_schedulers(rows: DataFrame, names: str | None, column: str = "Name") -> DataFrame:
    """Rows of the schedulers in a comma-separated list (all without a list)."""
    return rows.filter(F.col(column).isin(names.split(","))) if names else rows


def capped_per_scheduler(
    rows: DataFrame,
    limit: int | None,
    scheduler: str = "ScheddName",
    order: tuple[str, ...] = ("GlobalJobId",),
) -> DataFrame:
    """At most ``limit + 1`` rows of each scheduler, the first in order (no cap without a limit).

    A run stops a scheduler once its count exceeds the limit, hence the extra row. Ranks are
    taken per scheduler and salt first, so a scheduler with a large part of all rows is cut
    down in many tasks before one task sees the rest.
    """
    if not limit:
        return rows
    salt = F.pmod(F.xxhash64(*order), F.lit(_CAP_SALTS))
    near = Window.partitionBy(scheduler, "_salt").orderBy(*order)
    final = Window.partitionBy(scheduler).orderBy(*order)
    return (
        rows.withColumn("_salt", salt)
        .withColumn("_rank", F.row_number().over(near))
        .filter(F.col("_rank") <= limit + 1)
        .withColumn("_rank", F.row_number().over(final))
        .filter(F.col("_rank") <= limit + 1)
        .drop("_salt", "_rank")
    )


def lookup(
    ads: DataFrame,
    start_time: int,
    *,
    history: bool = False,
    minutes: int | None = None,
    constraint: str | None = None,
    schedulers: str | None = None,
    projection: str | None = None,
    limit: int | None = 1,
) -> DataFrame:
    """Ad-hoc look at records of the last minutes, with a SQL constraint of the user."""
    minutes = minutes or 12
    if history:
        rows = select_history(ads, start_time - (minutes + 1) * 60)
    else:
        rows = select_queue(ads, start_time, minutes)
    if constraint:
        rows = rows.filter(F.expr(constraint))
    if schedulers:
        rows = rows.filter(F.substring_index("GlobalJobId", "#", 1).isin(schedulers.split(",")))
    if projection:
        rows = rows.select([name.strip() for name in projection.split(",")])
    return rows if limit is None else rows.limit(limit)


