"""Rows dealt over the cores of a cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(rows: DataFrame, parts_a_core: int = 1) -> DataFrame:
    """Rows dealt evenly over all cores where their source has fewer parts.

    For work that is dear in each row. A source in one file, or in few row groups, would be worked on by as many tasks; a large one has
    enough parts and stays where it is. Parts of a file may be empty or uneven, so more than one a core is asked of narrow rows, which cost little
    to deal before they are widened.
    """
    parts = parts_a_core * rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(parts) if rows.rdd.getNumPartitions() < parts else rows
