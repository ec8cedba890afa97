"""Histograms of a document stream: buckets are appended once, when the watermark has closed them.

State is the open buckets only. A document that comes after its bucket was closed is refused; it is not counted later. Gaps
are filled when the buckets are read, so an empty bucket costs nothing while the stream runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from poolscope.operators.reconcile import INDEX_STEP, SERIES_STEP, STATUSES, bucket_spine

DELAY = "12 minutes"
INDEX_BUCKETS = "Status string, bucket long, documents long, jobs long"
SERIES_BUCKETS = "Status string, bucket long, points long"


def _timed(docs: DataFrame, delay: str, statuses) -> DataFrame:
    timed = docs.withColumn("_at", F.timestamp_seconds("RecordTime")).withWatermark("_at", delay)
    return timed.filter(F.col("Status").isin(*statuses))


def _bucket(window: str):
    return F.unix_timestamp(F.col(window)["start"]).alias("bucket")


def index_buckets(docs: DataFrame, step: int = INDEX_STEP, delay: str = DELAY, statuses=STATUSES) -> DataFrame:
    """Documents and distinct jobs of every closed bucket and status that has some.

    Two aggregations in a row: by bucket and job, whose state is spread by job however full a bucket is, then by bucket.
    """
    timed = _timed(docs, delay, statuses)
    jobs = timed.groupBy(F.window("_at", f"{step} seconds").alias("_window"), "Status", "GlobalJobId").agg(F.count("*").alias("_n"))
    closed = jobs.groupBy(F.window("_window", f"{step} seconds").alias("_closed"), "Status").agg(
        F.sum("_n").alias("documents"), F.count("GlobalJobId").alias("jobs"))
    return closed.select("Status", _bucket("_closed"), "documents", "jobs")


def series_buckets(docs: DataFrame, step: int = SERIES_STEP, delay: str = DELAY, statuses=STATUSES) -> DataFrame:
    """Values of ``MemoryMB`` in every closed bucket and status that has documents."""
    closed = _timed(docs, delay, statuses).groupBy(F.window("_at", f"{step} seconds").alias("_window"), "Status").agg(
        F.count("MemoryMB").alias("points"))
    return closed.select("Status", _bucket("_window"), "points")


def write_buckets(buckets: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append closed buckets to a table; the file sink takes each micro-batch once."""
    writer = buckets.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if available_now else writer.trigger(processingTime=DELAY).start()


def read_buckets(
    spark: SparkSession, path: str, schema: str, first: int, last: int, step: int, statuses=STATUSES, empty: int | None = 0
) -> DataFrame:
    """All buckets of a time range with the closed ones' counts; a bucket without documents has ``empty``."""
    closed = spark.read.schema(schema).parquet(path)
    filled = bucket_spine(spark, first, last, step, statuses).join(closed, ["Status", "bucket"], "left")
    counts = [c for c in closed.columns if c not in ("Status", "bucket")]
    return filled if empty is None else filled.fillna(empty, counts)
