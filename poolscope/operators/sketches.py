"""Summaries that runs store and readers unite: distinct jobs and frequent values without a second look at old documents.

Each run overwrites a folder of its own, so a repeated run adds nothing. The exact forms are ``reconcile.index_histogram`` and
``quality.most_frequent_value``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from poolscope.functions.times import bucket_start
from poolscope.operators.enrich import BROADCAST_ROWS
from poolscope.operators.quality import most_frequent_value
from poolscope.operators.reconcile import INDEX_STEP

#: A distinct count has 2 ** LG_SIZE registers and a standard error of ``ERROR``; within three of them in 99.7 % of the cases.
LG_SIZE = 12
ERROR = 1.04 / 2 ** (LG_SIZE / 2)
#: Values that a frequency sketch tracks. A value that it does not show occurs at most ``MISSED`` times as often as all.
TRACKED = 1024
MISSED = 4 / TRACKED


def store_run(rows: DataFrame, path: str, run: int) -> None:
    """Store the sketches of one run; the same run again replaces its own."""
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/run={run}")  # a row per group


# --------------------------------------------------------------------------- distinct jobs


def job_sketches(docs: DataFrame, step: int = INDEX_STEP) -> DataFrame:
    """Per status and bucket of ``step`` seconds: documents and a sketch of their jobs.

    Combined in the map tasks, so what is exchanged is a sketch for each bucket and task.
    """
    return docs.groupBy("Status", bucket_start(F.col("RecordTime"), step).alias("bucket")).agg(
        F.count("*").alias("documents"), F.hll_sketch_agg("GlobalJobId", F.lit(LG_SIZE)).alias("jobs"))


def estimated_jobs(spark: SparkSession, path: str, *groups: str) -> DataFrame:
    """Distinct jobs of all stored runs by ``groups`` of (``Status``, ``bucket``): a job in several runs counts once."""
    stored = spark.read.parquet(path)
    return stored.groupBy(*groups).agg(F.hll_sketch_estimate(F.hll_union_agg("jobs")).alias("jobs"))


# --------------------------------------------------------------------------- frequent values


def value_sketches(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per key: how many values there are, and a sketch of the frequent ones."""
    text = F.col(value).cast("string")
    return rows.filter(text.isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k_accumulate(CAST(`{value}` AS STRING), {TRACKED})").alias("frequent"))


def survivors(spark: SparkSession, path: str, keys: list[str], value: str) -> DataFrame:
    """Per key the values that may be the most frequent ones over all stored runs, and how often others occur at most.

    At most ``TRACKED`` rows for a key.
    """
    united = spark.read.parquet(path).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent"))
    shown = F.explode(F.expr(f"approx_top_k_estimate(frequent, {TRACKED})"))
    return united.select(*keys, F.ceil(F.col("n") * MISSED).alias("others"), shown.alias("s")).select(
        *keys, F.col("s.item").alias(value), "others")


def _same(keys: list[str], left: str, right: str) -> Column:
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return same


def top_values(rows: DataFrame, keys: list[str], value: str, sketches: str, top: int = 1) -> DataFrame:
    """The ``top`` most frequent values of every key, exactly; the smaller of equally frequent ones first.

    The sketches of all runs name the values that can be among them; a pass over ``rows`` counts only these, so its exchange has at most
    ``TRACKED`` rows for each key and task. Where a value that no sketch shows could still be among them, because the counts are close
    together, the key's values are all counted.
    """
    spark = rows.sparkSession
    text = rows.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("string").alias(value))
    known = survivors(spark, sketches, keys, value)
    chosen = text.alias("a").join(
        _narrow(known).alias("b"), _same(keys, "a", "b") & (F.col(f"a.{value}") == F.col(f"b.{value}")))
    counts = chosen.groupBy(*(F.col(f"a.{c}").alias(c) for c in (*keys, value))).agg(F.count("*").alias("occurrences"), F.max("b.others").alias("others"))
    ranked = counts.groupBy(*keys).agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("occurrences")).alias("o"), F.col(value).alias("v")))), 1, top).alias("best"),
        F.max("others").alias("others"), F.count("*").alias("shown"))
    # fewer shown values than a sketch tracks: it has lost none
    last = -F.element_at("best", -1)["o"]
    ranked = ranked.withColumn("certain", (F.col("shown") < TRACKED // 2) | ((F.size("best") == top) & (last > F.col("others"))))
    sure = ranked.filter("certain").select(*keys, F.explode("best").alias("b")).select(
        *keys, F.col("b.v").alias(value), (-F.col("b.o")).alias("occurrences"))
    # of some keys a sketch shows nothing
    every = spark.read.parquet(sketches).select(*keys).distinct()
    open_keys = every.alias("a").join(sure.alias("b"), _same(keys, "a", "b"), "left_anti")
    rest = text.alias("a").join(_narrow(open_keys).alias("b"), _same(keys, "a", "b"), "left_semi")
    return sure.unionByName(_all_counted(rest, keys, value, top))


def _all_counted(rows: DataFrame, keys: list[str], value: str, top: int) -> DataFrame:
    if top == 1:
        return most_frequent_value(rows, keys, value).select(*keys, value, "occurrences")
    counts = rows.groupBy(*keys, value).agg(F.count("*").alias("occurrences"))
    order = Window.partitionBy(*keys).orderBy(F.desc("occurrences"), F.asc(value))
    return counts.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= top).select(*keys, value, "occurrences")


def _narrow(rows: DataFrame) -> DataFrame:
    """Broadcast up to ``BROADCAST_ROWS`` rows; more are joined by a shuffle."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows
