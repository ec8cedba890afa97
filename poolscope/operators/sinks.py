"""Outputs: daily indexes, broker messages, run metadata and send reports.

Index and broker are tables and files here; the connectors of a deployment take them from
there (``write_messages`` has the columns of the Kafka sink).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poolscope import catalog
from poolscope.functions.times import to_millis, utc_day
from poolscope.operators.dedupe import first_per_key

# How JSON lines are stored: compressed, as they spell out every field name. Such a file is read by one task, so it has a bounded number of lines.
LINES = {"compression": "gzip", "maxRecordsPerFile": 250_000}
# How documents are stored: a quarter smaller than by Spark's own choice.
COLUMNS = {"compression": "zstd"}

# Columns that belong to the pipeline, not to a document.
INTERNAL = ("doc_id", "_error", "index", "idx_date", "feed", "batch", "written", "metadata")


def index_name(template: str, queued: Column) -> Column:
    """Daily index of a job: ``template-YYYY-MM-DD`` of its queue date in UTC."""
    return F.concat(F.lit(template + "-"), utc_day(queued).cast("string"))


def route(docs: DataFrame, template: str) -> DataFrame:
    """Documents with their daily index. Each row is routed by its own queue date."""
    return docs.withColumn("index", index_name(template, F.col("QDate"))).withColumn(
        "idx_date", utc_day(F.col("QDate"))
    )


def stamp(docs: DataFrame, metadata: dict[str, str | int]) -> DataFrame:
    """Put the values of a run into the metadata of every document."""
    added = [F.lit(value).alias(name) for name, value in metadata.items()]
    if "metadata" not in docs.columns:
        return docs.withColumn("metadata", F.struct(*added))
    for name, value in metadata.items():
        docs = docs.withColumn("metadata", F.col("metadata").withField(name, F.lit(value)))
    return docs


def run_metadata(git_hash: str, hostname: str, username: str, start_time: int, source: str) -> dict:
    """Metadata of a run; the caller supplies the values."""
    return {
        "spider_git_hash": git_hash,
        "spider_hostname": hostname,
        "spider_username": username,
        "spider_runtime": start_time * 1000,
        "spider_source": source,
    }


def payload_columns(docs: DataFrame) -> list[str]:
    """Document fields, in order."""
    return [c for c in docs.columns if c not in INTERNAL]


def dates_to_millis(docs: DataFrame) -> DataFrame:
    """Date fields in milliseconds, as the broker expects them, those inside the maps too.

    Only fields whose own name is declared a date: one that lost a decoration on its way into
    the document keeps its seconds.
    """
    dates = sorted(set(catalog.DATE_ATTRS) & set(docs.columns))
    scaled = {name: to_millis(F.col(name)) for name in dates}
    if "extra" in docs.columns:
        scaled["extra"] = F.transform_values(
            "extra",
            lambda k, v: F.when(
                k.isin(catalog.DATE_ATTRS), (v.try_cast("bigint") * 1000).cast("string")
            ).otherwise(v),
        )
    if "chirp" in docs.columns:
        scaled["chirp"] = F.transform_values(
            "chirp", lambda k, v: F.when(k.isin(catalog.DATE_ATTRS), v * 1000).otherwise(v)
        )
    return docs.withColumns(scaled)


def document_json(docs: DataFrame, with_metadata: bool = True) -> Column:
    """A document as one flat JSON object; missing fields are left out.

    The attributes without a column of their own, and the application statistics, become
    fields like all others. A column with a value beats an entry of the same name. Values have
    their declared kind; undeclared ones are the number, truth value, list or object that their
    text spells, else text.
    """
    maps = [c for c in ("chirp", "extra") if c in docs.columns]
    names = [c for c in payload_columns(docs) if c not in maps]
    if with_metadata and "metadata" in docs.columns:
        names.append("metadata")
    parts, taken = [_members(F.to_json(F.struct(*names)))], []
    for name in maps:
        kept = _without(F.col(name), names, taken)
        parts.append(_members(F.to_json(_typed(kept) if name == "extra" else kept)))
        taken.append(F.col(name))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _members(json_object: Column) -> Column:
    """Text of an object without its outer braces; NULL without members."""
    return F.nullif(F.regexp_replace(json_object, r"^\{|\}$", ""), F.lit(""))


def _without(entries: Column, names: list[str], taken: list[Column]) -> Column:
    """Entries whose name no column with a value and no earlier map has, in one pass.

    A column is looked at only for an entry of its name: a lambda evaluates all that it mentions for each entry, so it
    must not mention the text of a document.
    """

    def beaten(name: Column) -> Column:
        filled = F.lit(False)
        if names:
            first, *others = names
            filled = F.when(name == first, F.col(first).isNotNull())
            for other in others:
                filled = filled.when(name == other, F.col(other).isNotNull())
            filled = name.isin(names) & filled
        for earlier in taken:
            filled = filled | F.array_contains(F.coalesce(F.map_keys(earlier), F.array().cast("array<string>")), name)
        return filled

    return F.map_filter(entries, lambda k, _: ~beaten(k))


_SPELLED_VALUE = r"^(true|false|-?(0|[1-9]\d{0,17})(\.\d{1,17})?|\{[\s\S]*\}|\[[\s\S]*\])$"
_TEXT_FIELDS = sorted(name for name, kind, *_ in catalog.field_descriptors() if kind == "string")


def _typed(extra: Column) -> Column:
    """Attributes without a column as values of their kind."""
    return F.transform_values(
        extra,
        lambda k, v: F.coalesce(
            F.when(~k.isin(_TEXT_FIELDS) & v.rlike(_SPELLED_VALUE), F.try_parse_json(v)),
            v.cast("variant"),
        ),
    )


def index_bodies(docs: DataFrame) -> DataFrame:
    """Bulk requests: the action line with the id, and the document line."""
    action = F.to_json(F.struct(F.struct(F.col("doc_id").alias("_id")).alias("index")))
    return docs.select(
        *[c for c in ("index",) if c in docs.columns],
        "doc_id",
        action.alias("action"),
        document_json(docs).alias("document"),
    )


def broker_messages(docs: DataFrame) -> DataFrame:
    """Notifications: id, record time in milliseconds, payload and metadata."""
    sent = dates_to_millis(docs)
    metadata = F.col("metadata") if "metadata" in docs.columns else F.struct()
    envelope = F.struct(
        document_json(sent, with_metadata=False).alias("payload"), metadata.alias("metadata")
    )
    return sent.select(
        F.col("doc_id").alias("key"),
        F.col("RecordTime").alias("ts"),
        F.to_json(envelope).alias("value"),
    )


# ---------------------------------------------------------------------------- writing


def write_index(
    docs: DataFrame, path: str, batch: int, feed: str = "run", written: int | None = None, rebalance: bool = True
) -> None:
    """Store routed documents by day, as one numbered batch of a feed.

    Feeds (history, queue, a stream) number their batches on their own. A repeated batch
    replaces itself, so a batch that is retried adds nothing. ``written`` (default: the batch
    number) is a time in seconds that orders the batches of all feeds. Days are rebalanced
    before the write: a day with many documents gets many files of a sensible size, small days
    share a task. That shuffles whole documents, which takes several times the disk of the index; without ``rebalance`` each
    task sorts its own rows and writes a file for each of their days.
    """
    time = F.lit(batch if written is None else written).cast("bigint")
    timed = docs.withColumn("written", time)
    (
        (timed.hint("rebalance", "idx_date") if rebalance else timed)
        .write.mode("overwrite")
        .options(**COLUMNS)
        .partitionBy("idx_date")
        .parquet(batch_path(path, feed, batch))
    )


def batch_path(path: str, feed: str, batch: int) -> str:
    """Folder of one batch of a feed."""
    return f"{path}/feed={feed}/batch={batch}"


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Current documents of an index: what was written last wins for every id.

    Of two feeds that wrote at the same time the first by name wins (history before queue). A
    filter on ``idx_date`` prunes folders: all copies of a document share their queue date.
    """
    stored = spark.read.parquet(path)
    latest = [F.desc("written"), F.asc("feed"), F.desc("batch")]
    return first_per_key(stored, ["idx_date", "doc_id"], latest)


def compact_index(spark: SparkSession, path: str, target: str) -> None:
    """Rewrite an index without replaced documents to a new path, as batch 0."""
    write_index(read_index(spark, path).drop("feed", "batch", "written"), target, 0, "compacted")


def write_messages(messages: DataFrame, path: str, batch: int, feed: str = "run") -> None:
    """Store broker messages (key, value) as compressed JSON lines, one folder per batch of a feed."""
    messages.write.mode("overwrite").options(**LINES).json(batch_path(path, feed, batch))


def write_quarantine(bad: DataFrame, path: str, batch: int, feed: str = "run") -> None:
    """Store unusable records with their reasons, one folder per batch of a feed."""
    names = [c for c in ("GlobalJobId", "doc_id", "ScheddName", "EnteredCurrentStatus", "QDate") if c in bad.columns]
    reasons = bad.select(*names, F.col("_error").alias("reasons"))
    reasons.write.mode("overwrite").parquet(batch_path(path, feed, batch))


def write_everywhere(
    docs: DataFrame,
    batch: int,
    *,
    template: str,
    index_paths: Iterable[str] = (),
    broker_path: str | None = None,
    metadata: dict | None = None,
    feed: str = "run",
    written: int | None = None,
    rebalance: bool = True,
) -> None:
    """Send one batch to all index stores and to the broker.

    Each target reads ``docs`` again, so they should come from a stored table. ``rebalance``: see ``write_index``.
    """
    stamped = stamp(docs, metadata) if metadata else docs
    routed = route(stamped, template)
    for path in index_paths:
        write_index(routed, path, batch, feed, written, rebalance)
    if broker_path is not None:
        write_messages(broker_messages(routed), broker_path, batch, feed)


# ---------------------------------------------------------------------------- reports


def failure_summary(responses: DataFrame, reason: str = "reason", top: int = 3) -> DataFrame:
    """The most frequent reasons of failed items, after a row (null reason) with all failures."""
    counts = (
        responses.filter(F.col(reason) != "")
        .rollup(F.col(reason).alias("reason"))
        .agg(F.count("*").alias("failures"), F.grouping_id().alias("_all"))
    )
    ordered = counts.orderBy(F.desc("_all"), F.desc("failures"), F.asc("reason"))
    return ordered.limit(top + 1).drop("_all")


def documents_per_scheduler(docs: DataFrame) -> DataFrame:
    """Number of documents per scheduler."""
    return docs.groupBy("ScheddName").agg(F.count("*").alias("documents"))


def count_check(queried: DataFrame, processed: DataFrame) -> DataFrame:
    """Records read and documents made per scheduler, and whether they agree."""
    left = queried.select("ScheddName", F.lit(1).alias("queried"), F.lit(0).alias("processed"))
    right = processed.select("ScheddName", F.lit(0).alias("queried"), F.lit(1).alias("processed"))
    return (
        left.unionByName(right)
        .groupBy("ScheddName")
        .agg(F.sum("queried").alias("queried"), F.sum("processed").alias("processed"))
        .withColumn("consistent", F.col("queried") == F.col("processed"))
    )


def upload_totals(uploads: DataFrame) -> DataFrame:
    """Sent and received documents, their ratio and the upload minutes of a run.

    ``uploads`` has one row per upload: sent, received, elapsed seconds.
    """
    return uploads.agg(
        F.sum("sent").alias("total_sent"),
        F.sum("received").alias("total_received"),
        F.try_divide(F.sum("sent"), F.sum("received")).alias("send_ratio"),
        (F.sum("elapsed") / F.lit(60.0)).alias("upload_minutes"),
    )
