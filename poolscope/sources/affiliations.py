"""Affiliation directory of users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from poolscope.operators.dedupe import first_per_key

_PERSON = (
    "struct<institute:string,institute_country:string,dn:string,profiles:array<struct<login:string>>>"
)
COLUMNS = ["login", "institute", "country", "dn"]


def directory_from_people(people: DataFrame, order: str) -> DataFrame:
    """One row per login out of person records.

    ``people`` has the columns institute, institute_country, dn and profiles. The first
    profile with a login names a person; persons without login or institute are left out. Of
    several persons with one login the last in ``order`` stays.
    """
    named = people.select(
        F.get(
            F.filter("profiles", lambda p: p["login"].isNotNull()), F.lit(0)
        )["login"].alias("login"),
        "institute",
        F.col("institute_country").alias("country"),
        "dn",
        F.col(order).alias("_order"),
    ).filter((F.col("login") != "") & F.col("institute").isNotNull())
    return first_per_key(named, ["login"], [F.desc("_order")]).select(*COLUMNS)


def people_from_json(lines: DataFrame, column: str = "value") -> DataFrame:
    """Person records of account dumps: ``{id: {institute, institute_country, dn, profiles}}``."""
    people = F.map_entries(F.from_json(F.col(column), f"map<string,{_PERSON}>"))
    return lines.select(F.posexplode(people).alias("position", "_entry")).select(
        "position", "_entry.value.*"
    )


def read_people(spark: SparkSession, path: str) -> DataFrame:
    """Person records of a dump file."""
    return people_from_json(spark.read.text(path, wholetext=True))


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    """The newest stored directory below a path; a missing path is an error."""
    stored = spark.read.parquet(path)
    newest = stored.agg(F.max("built_at")).first()[0]
    return stored.filter(F.col("built_at") == F.lit(newest)).select(*COLUMNS)


def refresh_directory(
    spark: SparkSession, directory: DataFrame, path: str, now: int, max_age_days: float = 1
) -> bool:
    """Store a directory when there is none or the stored one is too old.

    Every build goes to a folder of its own, so readers never see half a directory. An empty
    build is never stored. Returns whether something was written.
    """
    try:
        built_at = spark.read.parquet(path).agg(F.max("built_at")).first()[0]
    except AnalysisException:
        built_at = None
    if built_at is not None and built_at >= now - max_age_days * 86400:
        return False
    if directory.isEmpty():
        return False
    directory.select(*COLUMNS).write.mode("overwrite").parquet(f"{path}/built_at={now}")
    return True
