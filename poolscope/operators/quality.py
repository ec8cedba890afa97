"""Data quality: unusable records, and documents that disagree with the schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolscope import catalog
from poolscope.operators.documents import ERRORS

# The schema is configuration: a bounded number of field names, always safe to broadcast.
_JSON_TYPES = {"string": "STRING", "long": "BIGINT", "date": "BIGINT", "bool": "BOOLEAN"}


def split_bad_records(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable documents, and quarantined ones with their reasons."""
    good = docs.filter(F.size(ERRORS) == 0).drop(ERRORS)
    bad = docs.filter(F.size(ERRORS) > 0)
    return good, bad


def schema_of_example(spark: SparkSession, path: str) -> DataFrame:
    """(field, expected) out of an example document: its values stand for the types."""
    fields = F.map_entries(F.from_json("value", "map<string,variant>"))
    return (
        spark.read.text(path, wholetext=True)
        .select(F.explode(fields).alias("_entry"))
        .select(
            F.col("_entry.key").alias("field"),
            F.schema_of_variant("_entry.value").alias("expected"),
        )
    )


def schema_of_catalog(spark: SparkSession) -> DataFrame:
    """(field, expected) out of the declared kinds."""
    rows = [(name, _JSON_TYPES[kind]) for name, kind, *_ in catalog.field_descriptors()]
    return spark.createDataFrame(rows, "field string, expected string")


def _family(json_type):
    """Coarse type: every number with a fraction is a float."""
    return (
        F.when(json_type.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "float")
        .when(json_type.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "int")
        .when(json_type == "STRING", "str")
        .when(json_type == "BOOLEAN", "bool")
        .when(json_type.startswith("ARRAY"), "list")
        .when(json_type.startswith("OBJECT"), "dict")
        .otherwise("null")
    )


def schema_violations(documents: DataFrame, schema: DataFrame, key: str = "doc_id", body: str = "document") -> DataFrame:
    """Fields of JSON documents that disagree with a schema, one row per violation.

    Kinds: ``unknown_key``, ``incorrect_type`` (also an integer where a float is expected is
    fine, the reverse is not), ``incorrect_type_in_list``, ``inconsistent_list`` and
    ``invalid_nested``. Missing fields and nulls are fine. Documents are taken apart in place
    and meet the broadcast schema, so nothing is shuffled.
    """
    fields = F.map_entries(F.from_json(F.col(body), "map<string,variant>"))
    found = documents.select(key, F.explode(fields).alias("_entry")).select(
        key,
        F.col("_entry.key").alias("field"),
        F.schema_of_variant("_entry.value").alias("found"),
    )
    checked = found.join(F.broadcast(schema), "field", "left")
    found_type, expected_type = _family(F.col("found")), _family(F.col("expected"))
    element = F.regexp_extract("found", r"^ARRAY<(.*)>$", 1)
    wanted_element = F.regexp_extract("expected", r"^ARRAY<(.*)>$", 1)
    kind = (
        F.when(F.col("expected").isNull(), "unknown_key")
        .when((found_type == "null") | (expected_type == "null"), None)
        .when((found_type == "int") & (expected_type == "float"), None)
        .when(found_type != expected_type, "incorrect_type")
        .when(
            found_type == "list",
            F.when(element.isin("VOID", ""), None)
            .when(element == "VARIANT", "inconsistent_list")
            .when((_family(element) == "int") & (_family(wanted_element) == "float"), None)
            .when(_family(element) != _family(wanted_element), "incorrect_type_in_list"),
        )
        .when((found_type == "dict") & (F.col("found") != F.col("expected")), "invalid_nested")
    )
    return (
        checked.withColumn("violation", kind)
        .filter(F.col("violation").isNotNull())
        .select(key, "field", "violation", "found", "expected")
    )


def conflicting_documents(violations: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document: number of unknown keys and of conflicts. Unknown keys are no conflict."""
    unknown = F.col("violation") == "unknown_key"
    return violations.groupBy(key).agg(
        F.count(F.when(unknown, 1)).alias("unknown_keys"),
        F.count(F.when(~unknown, 1)).alias("conflicts"),
    )


def missing_fields(lines: DataFrame, schema: DataFrame, column: str = "value") -> DataFrame:
    """Fields the logs report that the schema does not have, in order."""
    reported = (
        lines.select(F.explode(F.regexp_extract_all(column, F.lit("key=([^,]*)"), 1)).alias("field"))
        .filter(F.col("field") != "")
        .distinct()
    )
    return reported.join(F.broadcast(schema.select("field")), "field", "left_anti").orderBy("field")


def most_frequent_value(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Most frequent value per key; the smallest of equally frequent ones.

    Counts are made first, so a frequent value is one row per task before the shuffle.
    """
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count("*").alias("_n")
    )
    # the largest count wins; ties go to the smaller value
    best = F.min_by(value, F.struct(-F.col("_n"), F.col(value)))
    return counts.groupBy(*keys).agg(best.alias(value), F.max("_n").alias("occurrences"))
