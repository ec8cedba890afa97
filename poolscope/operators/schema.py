"""Schemas of nested documents: walk, inference from many examples, stored versions, recursive check.

A document is walked inside its row, by higher-order functions over variants: no shuffle, one parse. A *path* names the keys down to
a value, with ``[]`` for the elements of a list (``Site``, ``ToE.Who``, ``Steps[].Name``); names are taken to have neither dots nor brackets. A *kind* is one of
``null bool int float str list dict``. Kinds form a lattice: null lies below all, int below float, and anything else that meets
is the set of both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from poolscope.functions.rowwise import once
from poolscope.operators.spread import spread
from poolscope.session import scratch_path

#: Levels below a document that are looked into; what lies deeper counts as a list or dict.
DEPTH = 4
_WALKED = "array<struct<path:string,kind:string,keys:array<string>>>"
#: What a path can have against a schema, the one that is told first where it has several.
_VIOLATIONS = ("unknown_key", "incorrect_type", "inconsistent_list", "incorrect_type_in_list", "missing_nested_key")


def kind_of(value: Column) -> Column:
    """Kind of a variant; a missing one has none."""
    return once(
        F.schema_of_variant(value),
        lambda written: F.when(written == "STRING", "str")
        .when(written.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "int")
        .when(written.startswith("OBJECT"), "dict")
        .when(written.startswith("ARRAY"), "list")
        .when(written == "BOOLEAN", "bool")
        .when(written.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "float")
        .when(written.isNotNull(), "null"),
    )


def _walk(value: Column, path: Column, depth: int) -> Column:
    """Path, kind and (of dicts) keys of a value and all that lies below it."""
    none = F.array().cast(_WALKED)

    def members_of(members: Column) -> Column:
        here = F.array(F.struct(path.alias("path"), kind_of(value).alias("kind"), F.map_keys(members).alias("keys")))
        if not depth:
            return here
        below = F.transform(
            F.map_entries(members), lambda e: _walk(e["value"], F.concat(path, F.lit("."), e["key"]), depth - 1)
        )
        return F.concat(here, F.coalesce(F.flatten(below), none))

    found = once(F.try_variant_get(value, "$", "map<string,variant>"), members_of)
    if not depth:
        return found
    elements = F.transform(
        F.try_variant_get(value, "$", "array<variant>"), lambda v: _walk(v, F.concat(path, F.lit("[]")), depth - 1)
    )
    return F.concat(found, F.coalesce(F.flatten(elements), none))


def paths_of(body: Column, depth: int = DEPTH) -> Column:
    """All paths of a JSON document, each with its kinds and the different key sets of its dicts.

    NULL for a text that is no JSON object.
    """
    top = F.from_json(body, "map<string,variant>")
    each = F.flatten(F.transform(F.map_entries(top), lambda e: _walk(e["value"], e["key"], depth)))

    def grouped(walked: Column) -> Column:
        def of(path: Column) -> Column:
            return once(F.filter(walked, lambda w: w["path"] == path), lambda same: F.struct(
                path.alias("path"),
                F.array_distinct(F.transform(same, lambda w: w["kind"])).alias("kinds"),
                F.array_distinct(F.filter(F.transform(same, lambda w: w["keys"]), lambda k: k.isNotNull())).alias("key_sets"),
            ))

        return F.transform(F.array_distinct(F.transform(walked, lambda w: w["path"])), of)

    # a list of equal objects is one entry for each path before it is grouped
    return once(F.array_distinct(each), grouped)


def _joined(kinds: Column) -> Column:
    """Least kinds that hold all given: no null beside others, no int beside float; in order."""
    given = F.array_distinct(kinds)
    known = F.filter(given, lambda k: k != "null")
    known = F.when(F.array_contains(known, "float"), F.array_remove(known, "int")).otherwise(known)
    return F.when(F.size(known) == 0, F.array(F.lit("null"))).otherwise(F.array_sort(known))


def infer_schema(documents: DataFrame, body: str = "document", depth: int = DEPTH) -> DataFrame:
    """``path``, ``kinds``, ``documents`` that have it and their ``share`` of all that are JSON objects.

    Counted per path and kind before the shuffle, so what is exchanged grows with the schema and not with the documents.
    """
    # texts that are no JSON object have no paths and give no row; a filter would walk each document a second time
    walked = spread(documents.select(body)).select(paths_of(F.col(body), depth).alias("_paths"))
    # one row more for each document, without a path, counts the documents in the same pass
    marked = walked.select(F.explode(F.concat(
        F.array(F.struct(F.lit(None).cast("string").alias("path"), F.array(F.lit("dict")).alias("kinds"))),
        F.transform("_paths", lambda p: F.struct(p["path"].alias("path"), F.array_sort(p["kinds"]).alias("kinds"))),
    )).alias("_p")).select("_p.*")
    counted = marked.groupBy("path", "kinds").agg(F.count("*").alias("n"))
    merged = counted.groupBy("path").agg(
        _joined(F.flatten(F.collect_set("kinds"))).alias("kinds"), F.sum("n").alias("documents"))
    # a schema is small: one task
    total = F.max(F.when(F.col("path").isNull(), F.col("documents"))).over(Window.partitionBy(F.lit(0)))
    return merged.withColumn("share", F.col("documents") / total).filter("path IS NOT NULL").select("path", "kinds", "documents", "share")


def widened(old: DataFrame, new: DataFrame) -> DataFrame:
    """The schema that both fit: ``path``, ``kinds`` and how it ``change``\\ d from ``old``.

    ``added`` (unknown before), ``widened`` (null to anything, int to float), ``conflict`` (kinds that have no common one but their
    set), ``same``. A path that only the old schema has stays.
    """
    both = old.select("path", F.col("kinds").alias("_old")).join(
        new.select("path", F.col("kinds").alias("_new")), "path", "full")
    none = F.array().cast("array<string>")
    kinds = _joined(F.concat(F.coalesce("_old", none), F.coalesce("_new", none)))
    change = (
        F.when(F.col("_old").isNull(), "added")
        .when(kinds == F.col("_old"), "same")
        .when(F.size(kinds) > 1, "conflict")
        .otherwise("widened")
    )
    return both.select("path", kinds.alias("kinds"), change.alias("change"))


def store_schema(spark: SparkSession, new: DataFrame, path: str, version: int) -> DataFrame:
    """Widen the newest stored schema older than ``version`` by ``new`` and store it as that version.

    Each version is a folder of its own: one that is made again replaces itself, a lost one leaves the older ones in place.
    """
    merged = widened(read_schema(spark, path, before=version), new)
    place = f"{path}/version={version}"
    merged.coalesce(1).write.mode("overwrite").parquet(place)  # a schema is small
    return spark.read.parquet(place)


def read_schema(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The newest stored version (older than ``before``); no paths without one."""
    try:
        stored = spark.read.parquet(path)
        if before is not None:
            stored = stored.filter(F.col("version") < before)
        newest = stored.agg(F.max("version")).first()[0]
    except AnalysisException:
        newest = None
    if newest is None:
        return spark.createDataFrame([], "path string, kinds array<string>, change string")
    return stored.filter(F.col("version") == F.lit(newest)).select("path", "kinds", "change")


def nested_violations(
    documents: DataFrame, schema: DataFrame, key: str = "doc_id", body: str = "document", depth: int = DEPTH
) -> DataFrame:
    """Where JSON documents disagree with a schema, at any level: ``key``, ``path``, ``violation``, one row per path.

    ``unknown_key``           a key that the schema does not have; what lies below it is not looked at
    ``incorrect_type``        a kind that the schema does not have there (an int passes for a float, null for anything)
    ``inconsistent_list``     elements of several kinds where the schema has one
    ``incorrect_type_in_list``  elements of another kind
    ``missing_nested_key``    an object inside the document without a key that the schema has there

    Keys missing at the top are fine. The schema (``path``, ``kinds``) is configuration: it is broadcast, and documents stay where
    they are. Only violations are brought together by path.
    """
    place = scratch_path(documents.sparkSession, "schema-to-check")
    schema.select("path", "kinds").coalesce(1).write.parquet(place)  # small, and read three times
    schema = documents.sparkSession.read.parquet(place)
    parent = F.regexp_replace("path", r"(\.[^.]*|\[\])$", "")
    child = F.when(~F.col("path").endswith("[]") & F.col("path").contains("."), F.regexp_extract("path", r"\.([^.]*)$", 1))
    inner = schema.filter(child.isNotNull()).groupBy(parent.alias("path")).agg(F.collect_set(child).alias("_inner"))
    known = schema.select("path", F.col("kinds").alias("_expected")).join(F.broadcast(inner), "path", "left")
    rows = spread(documents.select(key, body)).select(key, F.explode(paths_of(F.col(body), depth)).alias("_p")).select(key, "_p.*")
    rows = rows.withColumn("_parent", parent).join(F.broadcast(known), "path", "left")
    parents = schema.select(F.col("path").alias("_parent"), F.lit(True).alias("_known_parent"))
    rows = rows.join(F.broadcast(parents), "_parent", "left")

    found = F.filter("kinds", lambda k: k != "null")
    wrong = F.filter(found, lambda k: ~F.array_contains("_expected", k) & ~((k == "int") & F.array_contains("_expected", "float")))
    in_list = F.col("path").endswith("[]")
    top = F.col("path") == F.col("_parent")
    untyped = F.array_contains("_expected", "null") & (F.size("_expected") == 1)
    several = F.size(_joined(found)) > 1
    violation = (
        F.when(F.col("_expected").isNull(), F.when(top | F.coalesce("_known_parent", F.lit(False)), "unknown_key"))
        .when(untyped | (F.size(wrong) == 0), None)
        .when(in_list & several & (F.size("_expected") == 1), "inconsistent_list")
        .when(in_list, "incorrect_type_in_list")
        .otherwise("incorrect_type")
    )
    # an unknown key's elements and members have an unknown parent and are passed over; a list of unknown elements is no key
    violation = F.when(~(F.col("_expected").isNull() & in_list), violation)
    absent = F.array_distinct(F.flatten(F.transform("key_sets", lambda keys: F.array_except(F.col("_inner"), keys))))
    # both kinds of rows from one walk; a wrong kind in one element of a list comes before the lack in another one
    rank = F.coalesce(*[F.when(violation == name, number) for number, name in enumerate(_VIOLATIONS)])
    here = F.array_compact(F.array(F.when(violation.isNotNull(), F.struct(F.col("path").alias("path"), rank.alias("rank")))))
    lacking = F.transform(
        F.when(F.col("_inner").isNotNull(), absent),
        lambda k: F.struct(F.concat_ws(".", "path", k).alias("path"), F.lit(_VIOLATIONS.index("missing_nested_key")).alias("rank")))
    nothing = F.array().cast("array<struct<path:string,rank:int>>")
    all_rows = rows.select(key, F.explode(F.concat(here, F.coalesce(lacking, nothing))).alias("_v")).select(key, "_v.*")
    first = all_rows.groupBy(key, "path").agg(F.min("rank").alias("_rank"))
    return first.select(key, "path", F.element_at(F.array(*map(F.lit, _VIOLATIONS)), F.col("_rank") + 1).alias("violation"))
