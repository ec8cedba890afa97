"""Log files of the monitoring runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_logs(spark: SparkSession, queue_path: str, history_path: str) -> DataFrame:
    """Lines of the two logs, tagged by the run they come from."""
    return _tagged(spark.read.text(queue_path), spark.read.text(history_path))


def tail_logs(spark: SparkSession, queue_dir: str, history_dir: str) -> DataFrame:
    """The same as a stream over folders that new log files are put into."""
    return _tagged(spark.readStream.text(queue_dir), spark.readStream.text(history_dir))


def _tagged(queue: DataFrame, history: DataFrame) -> DataFrame:
    return queue.select("value", F.lit("condor_queue").alias("spider_source")).unionByName(
        history.select("value", F.lit("condor_history").alias("spider_source"))
    )
