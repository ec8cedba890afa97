"""Alerts: which configuration applies to a case, and what is to be sent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CASE = (
    "struct<targets:array<string>,source:string,alert_name:string,status:string,"
    "entities:array<string>>"
)
_CONFIG = f"struct<cases:map<string,{_CASE}>,default_case:{_CASE}>"
CASE_FIELDS = ["targets", "source", "alert_name", "status", "entities"]


def parse_config(lines: DataFrame, column: str = "value") -> DataFrame:
    """(case, config) rows of a configuration text; the default case is the null case."""
    config = F.from_json(F.col(column), _CONFIG)
    parsed = lines.select(config.alias("_config"))
    cases = parsed.select(F.explode(F.map_entries("_config.cases")).alias("_entry")).select(
        F.regexp_extract("_entry.key", r"^exit_(\d+)$", 1).try_cast("int").alias("case"),
        F.col("_entry.value").alias("config"),
    )
    default = parsed.select(
        F.lit(None).cast("int").alias("case"), F.col("_config.default_case").alias("config")
    )
    return cases.unionByName(default)


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """Configuration of a JSON file."""
    return parse_config(spark.read.text(path, wholetext=True))


def alerts(results: DataFrame, config: DataFrame, timestamp: int, summary: Column | str) -> DataFrame:
    """Alert records of results (case, description); cases without targets send nothing.

    The configuration is a handful of rows.
    """
    cases = config.filter(F.col("case").isNotNull()).select("case", F.col("config").alias("_own"))
    default = config.select(
        F.coalesce("case", F.lit(-1)).alias("_fallback"), F.col("config").alias("_default")
    )
    subject = summary if isinstance(summary, Column) else F.lit(summary)
    description = F.nullif(F.ltrim("description"), F.lit(""))
    return (
        results.join(F.broadcast(cases), "case", "left")
        .withColumn("_fallback", F.when(F.col("_own").isNull(), -1))
        .join(F.broadcast(default), "_fallback", "left")
        .withColumn("_config", F.coalesce("_own", "_default"))
        .filter(F.size("_config.targets") > 0)
        .select(
            "case",
            *[F.col(f"_config.{name}").alias(name) for name in CASE_FIELDS],
            subject.alias("summary"),
            F.coalesce(description, F.lit("No message provided")).alias("description"),
            F.lit(timestamp).cast("bigint").alias("timestamp"),
        )
    )
