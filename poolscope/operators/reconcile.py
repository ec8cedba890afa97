"""Do independent stores agree on the number of jobs?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolscope.functions.times import bucket_start

# Fixed values.
STATUSES = ("Completed", "Running", "Idle")
INDEX_STEP, SERIES_STEP = 300, 720
LOOKBACK = 6 * 3600
THRESHOLD, SERIOUS = 0.05, 0.5


def bucket_spine(spark: SparkSession, first: int, last: int, step: int, statuses) -> DataFrame:
    """All buckets of all statuses of a time range; its size depends on the range only."""
    start = first - first % step
    return spark.range(start, last + 1, step).select(
        F.explode(F.array(*[F.lit(s) for s in statuses])).alias("Status"),
        F.col("id").alias("bucket"),
    )


def _in_range(docs: DataFrame, now: int, lookback: int, statuses) -> DataFrame:
    return docs.filter(
        F.col("RecordTime").between(now - lookback, now) & F.col("Status").isin(*statuses)
    )


def index_histogram(
    docs: DataFrame, now: int, lookback: int = LOOKBACK, step: int = INDEX_STEP, statuses=STATUSES
) -> DataFrame:
    """Documents and distinct jobs per five minutes and status; empty buckets are zero.

    The distinct count is shuffled by bucket and job, so a full bucket is spread.
    """
    counts = (
        _in_range(docs, now, lookback, statuses)
        .groupBy("Status", bucket_start(F.col("RecordTime"), step).alias("bucket"))
        .agg(F.count("*").alias("documents"), F.count_distinct("GlobalJobId").alias("jobs"))
    )
    spine = bucket_spine(docs.sparkSession, now - lookback, now, step, statuses)
    return spine.join(counts, ["Status", "bucket"], "left").fillna(0, ["documents", "jobs"])


def series_histogram(
    docs: DataFrame, now: int, lookback: int = LOOKBACK, step: int = SERIES_STEP, statuses=STATUSES
) -> DataFrame:
    """Values of ``MemoryMB`` per twelve minutes and status; empty buckets are null."""
    counts = (
        _in_range(docs, now, lookback, statuses)
        .groupBy("Status", bucket_start(F.col("RecordTime"), step).alias("bucket"))
        .agg(F.count("MemoryMB").alias("points"))
    )
    spine = bucket_spine(docs.sparkSession, now - lookback, now, step, statuses)
    return spine.join(counts, ["Status", "bucket"], "left")


def total_by_status(histogram: DataFrame, count: str, name: str) -> DataFrame:
    """Sum of a histogram column per status. Null buckets add nothing."""
    return histogram.groupBy("Status").agg(F.sum(count).alias(name))


def source_gaps(monitoring_index: DataFrame, own_index: DataFrame, series: DataFrame) -> DataFrame:
    """Relative gaps between three stores per status, with a severity.

    Inputs have Status and one of ``own_total``, ``index_total``, ``series_total``. Severity is
    0, 2 above 5 % and 3 above 50 % between the monitoring index and the time series. The gap
    between the two indexes is only reported, and only for completed jobs.
    """
    aligned = own_index.join(monitoring_index, "Status", "full").join(series, "Status", "full")
    # gaps are cut to four digits, like the thresholds expect
    gap = _cut(F.try_divide(F.col("index_total") - F.col("series_total"), F.col("index_total")))
    index_gap = F.when(
        F.col("Status") == "Completed",
        _cut(F.try_divide(F.col("own_total") - F.col("index_total"), F.col("own_total"))),
    )
    severity = F.when(F.abs(gap) > SERIOUS, 3).when(F.abs(gap) > THRESHOLD, 2).otherwise(0)
    return aligned.select(
        "Status",
        "own_total",
        "index_total",
        "series_total",
        gap.alias("gap"),
        index_gap.alias("index_gap"),
        F.coalesce(F.abs(index_gap) > THRESHOLD, F.lit(False)).alias("index_differs"),
        severity.alias("severity"),
    )


def _cut(value):
    scaled = (value * F.lit(10000)).cast("bigint")
    return scaled / F.lit(10000.0)


def overall_severity(gaps: DataFrame) -> DataFrame:
    """Exit code of a comparison: the worst severity of all statuses."""
    return gaps.agg(F.max("severity").alias("severity"))
