"""Documents from a growing folder of records."""

from __future__ import annotations

import time
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from poolscope.operators.dedupe import first_per_key
from poolscope.operators.documents import ERRORS, build_documents
from poolscope.operators.quality import split_bad_records
from poolscope.operators.sinks import write_everywhere, write_quarantine

CADENCE = "12 minutes"


def document_stream(
    ads: DataFrame, launch_time: int, keep_unusable: bool = False, **options
) -> DataFrame:
    """Usable documents of a record stream. No state: each record is its own document.

    ``keep_unusable`` leaves the others in, with their reasons, for the quarantine of
    :func:`write_stream`.
    """
    built = build_documents(ads, launch_time, **options)
    return built if keep_unusable else split_bad_records(built)[0]


def dedupe_stream(docs: DataFrame, event_time: str, delay: str = CADENCE) -> DataFrame:
    """Drop copies of a document that come within the delay of each other.

    For sinks without ids. Keyed state holds one entry per id for the time of the delay.
    """
    return docs.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["doc_id"])


def write_stream(
    docs: DataFrame,
    checkpoint: str,
    *,
    template: str,
    index_paths: list[str],
    broker_path: str | None = None,
    quarantine_path: str | None = None,
    metadata: dict | None = None,
    available_now: bool = True,
    after_batch: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Write a document stream to all sinks, batch by batch.

    Copies inside a batch are dropped before the shuffle where they can be; copies in
    different batches are resolved by id when the index is read. A batch that is retried
    replaces what its first try wrote, and progress is stored only after all sinks have it.
    Batches are numbered per checkpoint, so each checkpoint is a feed of its own; the time of
    writing orders its batches among those of other feeds. Unusable records that are still in
    the stream go to the quarantine.
    """
    feed = f"stream-{zlib.crc32(checkpoint.encode()):08x}"

    def send(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        good, bad = split_bad_records(batch) if ERRORS in batch.columns else (batch, None)
        try:
            write_everywhere(
                first_per_key(good, ["doc_id"], [F.desc("EnteredCurrentStatus")]),
                number,
                template=template,
                index_paths=index_paths,
                broker_path=broker_path,
                metadata=metadata,
                feed=feed,
                written=int(time.time()),
            )
            if bad is not None and quarantine_path is not None:
                write_quarantine(bad, quarantine_path, number, feed)
        finally:
            batch.unpersist()
        if after_batch:
            after_batch(batch, number)

    writer = docs.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=CADENCE).start()
