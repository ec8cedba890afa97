"""One row per key.

``row_number() == 1`` is cut down to one row per key in every map task before the shuffle
(window group limit), so a key with a large part of all rows is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def latest_documents(docs: DataFrame, sequence: list[str], key: str = "doc_id") -> DataFrame:
    """The last written document of each id. ``sequence`` must order the copies of an id fully."""
    return first_per_key(docs, [key], [F.desc(name) for name in sequence])


def union_sources(history: DataFrame, queue: DataFrame) -> DataFrame:
    """Documents of finished and queued jobs in one set, told apart by ``spider_source``."""
    return history.withColumn("spider_source", F.lit("condor_history")).unionByName(
        queue.withColumn("spider_source", F.lit("condor_queue")), allowMissingColumns=True
    )
