"""From raw documents to packed training sequences: language, near duplicates, benchmark leaks, secrets, packing.

Each stage works on all rows its predecessor kept; all but the last return the columns of ``documents``, names, types and values. Between
stages the rows are written as Parquet to the shared folder and read again; ``run`` removes a stage's rows when the next stage's
are written, and every stage removes its own tables but a narrow one with its decisions.

Rows are told apart by their text, so those without an id, or with an id that others have, are treated like all others: near duplicates
are groups of texts, of which the row with the smallest id stays (rows without an id come last, equal ids by text and other
columns); leaks and secrets are looked for in each text. Null and empty texts are no language and go in the first stage.

The stages set the session's number of rows that go to Python workers at once to ``common.BATCH_ROWS``, unless it is lower.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poolscope.llm import jaccard, langid, packing, secretscan, templates
from poolscope.llm.common import remove, settled, small_batches, table
from poolscope.session import scratch_path

#: Texts whose best language scores less are rejected.
LEAST_LANGUAGE_SCORE = 0.25


def _text_key() -> Column:
    """A text's key. Two texts with one key would be taken as copies; 64 bits make that rare."""
    return F.xxhash64(F.col("text").cast("string"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a language, or with none that scores enough, go."""
    small_batches(spark)
    # the scorer adds columns, so the input's have other names meanwhile
    names = [name if name == "text" else f"in_{k}" for k, name in enumerate(docs.columns)]
    scored = langid.predict(docs.toDF(*names), langid.fit(docs), keep_text=True)
    known = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return scored.filter(known).select(*(F.col(name).cast(docs.schema[given].dataType).alias(given) for name, given in zip(names, docs.columns)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts the row with the smallest id stays, and all rows without words."""
    small_batches(spark)
    keyed = docs.select(_text_key().alias("doc_id"), "text")

    def chosen() -> DataFrame:
        groups = jaccard.jaccard_components(keyed).filter("n_shingles > 0").select(F.col("doc_id").alias("key"), "component_id").distinct()
        ids = docs.select(_text_key().alias("key"), F.col("doc_id").cast("long").alias("id")).distinct()
        order = F.struct(F.col("id").isNull().alias("last"), "id", "key")
        return ids.join(groups, "key").groupBy("component_id").agg(F.min(order).alias("least")).select("least.key", "least.id")

    stay = settled(chosen, "pipeline-chosen")
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns))
    plain = [name for name in docs.columns if name != "text" and docs.schema[name].dataType.typeName() in
             ("long", "integer", "short", "byte", "double", "float", "string", "boolean", "date", "timestamp")]
    tie = F.struct(*(F.col(f"`{name}`") for name in plain))
    rows = docs.select(_text_key().alias("key"), F.col("doc_id").cast("long").alias("id"), row.alias("row"), tie.alias("tie"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]").alias("worded"))
    same = (F.col("a.key") == F.col("b.key")) & F.col("a.id").eqNullSafe(F.col("b.id"))
    kept = rows.filter("worded").alias("a").join(stay.alias("b"), same, "left_semi")
    # equal rows of one id and text: the first by their other columns
    one = kept.groupBy("key", "id").agg(F.min_by("row", "tie").alias("row"))
    return one.select("row").unionByName(rows.filter("NOT worded").select("row")).select("row.*")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a benchmark item's template go."""
    small_batches(spark)

    def leaked() -> DataFrame:
        rows = docs.select(_text_key().alias("doc_id"), "text")
        return templates.contaminated(rows, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("key")).distinct()

    leaks = settled(leaked, "pipeline-leaks")
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row")
    return docs.select(row, _text_key().alias("key")).join(leaks, "key", "left_anti").select("row.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts where they were found; no document goes."""
    spans = settled(lambda: secretscan.places(secretscan.scan(docs.select("doc_id", "text"))), "pipeline-secrets")
    clean = secretscan.replace_places(docs, spans)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 ids."""
    small_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), keep_space=False, end_id=2)


STAGES = [
    ("language", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("benchmark leaks", drop_benchmark_leaks),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: SQL can express neither the trained stages nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that the stages keep."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, [before])
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
