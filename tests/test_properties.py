"""Properties over many generated values, checked against plain Python."""

import random
import re

from pyspark.sql import functions as F

from poolscope.functions import casting, identity
from poolscope.operators.dedupe import latest_documents
from poolscope.operators.quality import most_frequent_value


def test_lists_split_like_the_pattern(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab ,\t_") for _ in range(rng.randint(0, 14))) for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = dict(frame.select("i", casting.text_to_list(F.col("t"))).collect())
    assert all(got[i] == re.split(r"[\s,]+\s*", t) for i, t in enumerate(texts))


def test_padded_indexes_sort_like_numbers(spark):
    numbers = list(range(0, 120000, 977))
    frame = spark.createDataFrame([(n, str(n)) for n in numbers], "n int, t string")
    ordered = frame.orderBy(identity.sortable_task_index(F.col("t"))).collect()
    assert [r.n for r in ordered] == numbers


def test_latest_document_survives_a_hot_id(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("d"), F.col("id") % 50)).alias("doc_id"),
        F.col("id").alias("seq"),
    )
    got = {r.doc_id: r.seq for r in latest_documents(rows, ["seq"]).collect()}
    expected = {}
    for i in range(20000):
        expected["hot" if i % 3 == 0 else f"d{i % 50}"] = i
    assert got == expected


def test_most_frequent_value_prefers_the_smaller_on_ties(spark):
    rows = spark.createDataFrame(
        [("a", "x"), ("a", "y"), ("a", "y"), ("a", "x"), ("a", None), ("b", "z")], "k string, v string"
    )
    got = {r.k: (r.v, r.occurrences) for r in most_frequent_value(rows, ["k"], "v").collect()}
    assert got == {"a": ("x", 2), "b": ("z", 1)}
