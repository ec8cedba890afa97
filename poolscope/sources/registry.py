"""Registry of schedulers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolscope.operators.dedupe import first_per_key
from poolscope.operators.select import only_schedulers


def parse_pools(lines: DataFrame, column: str = "value") -> DataFrame:
    """(CMS_Pool, collector, pool_order, collector_order) of pool files: ``{pool: [host, ...]}``.

    Text that is no such object gives no rows.
    """
    pools = F.map_entries(F.from_json(F.col(column), "map<string,array<string>>"))
    return (
        lines.select(F.posexplode(pools).alias("pool_order", "_pool"))
        .select(
            "pool_order",
            F.col("_pool.key").alias("CMS_Pool"),
            F.posexplode("_pool.value").alias("collector_order", "collector"),
        )
        .select("CMS_Pool", "collector", "pool_order", "collector_order")
    )


def read_pools(spark: SparkSession, path: str) -> DataFrame:
    """Pools of a JSON file."""
    return parse_pools(spark.read.text(path, wholetext=True))


def registered(registry: DataFrame) -> DataFrame:
    """Schedulers of the workload system: identity and addresses."""
    return registry.filter(F.col("CMSGWMS_Type").isNotNull() & F.col("Name").isNotNull()).select(
        "Name", "MyAddress", "ScheddIpAddr", "collector"
    )


def schedulers(registry: DataFrame, pools: DataFrame | None, names: str | None = None) -> DataFrame:
    """One row per scheduler with its pool.

    Inside a pool the last collector that knows a scheduler wins; between pools the first
    pool does. Without pools every scheduler belongs to the pool Unknown.
    """
    rows = registered(registry)
    if pools is None:
        alone = first_per_key(rows, ["Name"], [F.desc("collector"), F.desc("MyAddress")])
        return only_schedulers(alone.withColumn("CMS_Pool", F.lit("Unknown")), names)
    placed = rows.join(pools, "collector")
    in_pool = first_per_key(
        placed, ["Name", "pool_order"], [F.desc("collector_order"), F.desc("MyAddress")]
    )
    single = first_per_key(in_pool, ["Name"], [F.asc("pool_order")])
    return only_schedulers(
        single.select("Name", "MyAddress", "ScheddIpAddr", "CMS_Pool"), names
    )
