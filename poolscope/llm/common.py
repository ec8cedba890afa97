"""Tables in the shared folder, table access and connected components."""

from __future__ import annotations

import ctypes
import ctypes.util
import functools
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolscope.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = 1000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Tables stored on the way to a result that ``settled`` makes; None outside of one.
_ON_THE_WAY: ContextVar[list[str] | None] = ContextVar("on_the_way", default=None)


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: a cut in the lineage that outlives executors."""
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    if (paths := _ON_THE_WAY.get()) is not None:
        paths.append(path)
    before = spark.conf.get(_BATCH_ROWS)
    small_batches(spark)
    try:
        rows.write.parquet(path)
    finally:
        spark.conf.set(_BATCH_ROWS, before)
    return spark.read.schema(rows.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """From now on at most ``BATCH_ROWS`` rows at once go to a Python worker and back.

    Rows here are whole texts: ten thousand of them, Spark's default, are held by the executor and by the worker, outside the heap.
    """
    if not 0 < int(spark.conf.get(_BATCH_ROWS)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_ROWS, str(BATCH_ROWS))


def settled(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """The rows that ``make()`` gives, stored; the tables that it stores on the way are removed."""
    token = _ON_THE_WAY.set([])
    try:
        rows = make()
        on_the_way = list(_ON_THE_WAY.get())
    finally:
        _ON_THE_WAY.reset(token)
    result = stored(rows, label)
    remove(rows.sparkSession, on_the_way)
    return result


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders through the file system that Spark resolves them on."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@functools.cache
def _trim() -> Callable[[int], int] | None:
    name = ctypes.util.find_library("c")
    return getattr(ctypes.CDLL(name), "malloc_trim", None) if name else None


def give_back_memory() -> None:
    """Return freed memory of this worker process to the system.

    Workers live on between tasks and keep what their largest arrays took, beside the next task's worker.
    """
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def crc_remainder(doc_id: str, modulus: int):
    """``crc32`` of the id as text, modulo ``modulus``; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """Smallest reachable node of every node that has an edge, as ``(node, component)``.

    ``edges`` has the columns ``a`` and ``b`` of one orderable type. Large-star and small-star steps
    alternate until only stars are left, which the aggregate that a round needs anyway shows. Each step is an
    aggregate (combined before the shuffle) and a join with its result, so a node with very many edges is no
    task of its own. Every round is written to the shared folder. A null end or a loop is no edge.
    """
    now = stored(
        edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        f"{label}-edges",
    )
    while True:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = stored(both.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high")), f"{label}-near")
        least = F.least("a", "low")
        # centres have larger neighbours only, all others have one neighbour
        if near.filter("low < a AND low <> high").isEmpty():
            return near.select(F.col("a").alias("node"), least.alias("component"))
        # every end above a node goes to the node's least neighbour, then all below an end go to the least of them
        down = now.join(near.select(F.col("a").alias("b"), least.alias("m")), "b").select("a", F.col("m").alias("b"))
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(lowest, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        now = stored(small.filter("a > b").distinct(), f"{label}-stars")
