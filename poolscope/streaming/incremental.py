"""Incremental reading as one stream: what a run reads, and keyed state with each scheduler's place.

A run has a fixed time ``now`` and takes each scheduler up where the last run left it, so which records it reads is known from the
stored places: records are chosen where they are, without a shuffle (:func:`history_stream`). What moves is the place. Each task
sends one row for each scheduler and Arrow batch, however many records that are, to the scheduler's keyed state
(:func:`place_stream`), which outlives restarts in the stream's checkpoint.

The state of a scheduler holds its place and a timer in event time. Late records and late post-job updates move nothing back: the
place is a maximum. When the watermark leaves the place behind by the retention time, the timer moves the place up to it, where any
later run would begin anyway, and reports it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.utils import AnalysisException

from poolscope.functions.identity import source_name
from poolscope.operators.enrich import row_bound
from poolscope.operators.incremental import DEFAULT_MINUTES, OVERLAP, RETENTION, history_to_read

# The code itself travels to the Python workers: they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PARTIAL = "schedd string, records long, latest long, start long, event_time timestamp"
PLACES = "schedd string, last_completion long, records long, expired boolean"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def history_stream(
    ads: DataFrame, places: DataFrame, now: int, minutes: int = DEFAULT_MINUTES
) -> DataFrame:
    """Records of a stream that the run of time ``now`` reads, each with the ``_start`` of its scheduler.

    ``places`` are the stored ones from before the run (a static table, read once when the stream starts), so a restart of the same
    run chooses the same records.
    """
    return history_to_read(ads, places, now, row_bound(places), minutes)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per scheduler of each Arrow batch."""
    for batch in batches:
        table = pa.Table.from_batches([batch]).group_by("schedd").aggregate(
            [("latest", "count"), ("latest", "max"), ("start", "max"), ("event_time", "max")])
        columns = [table.column(c) for c in ("schedd", "latest_count", "latest_max", "start_max", "event_time_max")]
        yield from pa.table(columns, names=["schedd", "records", "latest", "start", "event_time"]).to_batches()


class SchedulerPlace(StatefulProcessor):
    """The place of one scheduler: how far its records have been read."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.place = handle.getValueState("place", "last_completion long")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        known = initialState["last_completion"].dropna()
        if len(known):
            self._move(int(known.max()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        reached, records = [self._now()], 0
        for part in rows:
            reached += [part[c].max() for c in ("latest", "start")]
            records += int(part["records"].sum())
        place = max((int(x) for x in reached if x is not None and not pd.isna(x)), default=None)
        if place is not None:
            self._move(place)
            yield self._row(key[0], place, records, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        place = max(self._now(), timerValues.getCurrentWatermarkInMs() // 1000 - RETENTION)
        self._move(place)
        yield self._row(key[0], place, 0, True)

    def close(self) -> None:
        pass

    def _now(self) -> int | None:
        return self.place.get()[0] if self.place.exists() else None

    def _move(self, place: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.place.update((place,))
        self.handle.registerTimer((place + RETENTION + 1) * 1000)

    @staticmethod
    def _row(schedd: str, place: int, records: int, expired: bool) -> pd.DataFrame:
        return pd.DataFrame({"schedd": [schedd], "last_completion": [place], "records": [records], "expired": [expired]})


def place_stream(read: DataFrame, places: DataFrame, now: int) -> DataFrame:
    """Places as they move, one row per scheduler of each micro-batch, and per timer that ran out.

    ``read`` is a :func:`history_stream`; ``places`` is the state that a new stream begins with. Event time is the last change of a
    record, at most ``now``, so a time in the future does not end the state of others; the watermark trails by the retention time, and
    what is later than that is in no run.
    """
    changed = F.greatest("EnteredCurrentStatus", F.col("CRAB_PostJobLastUpdate").cast("bigint")) if (
        "CRAB_PostJobLastUpdate" in read.columns) else F.col("EnteredCurrentStatus")
    narrow = read.select(
        source_name(F.col("GlobalJobId")).alias("schedd"),
        F.col("EnteredCurrentStatus").cast("bigint").alias("latest"),
        F.col("_start").cast("bigint").alias("start"),
        F.timestamp_seconds(F.least(changed, F.lit(now))).alias("event_time"),
    )
    partial = narrow.mapInArrow(_summed, _PARTIAL).withWatermark("event_time", f"{RETENTION + OVERLAP} seconds")
    known = places.select("schedd", F.col("last_completion").cast("bigint").alias("last_completion"))
    return partial.groupBy("schedd").transformWithStateInPandas(
        SchedulerPlace(), PLACES, "Update", "EventTime", initialState=known.groupBy("schedd"))


def write_place_stream(moved: DataFrame, path: str, checkpoint: str, run: int, available_now: bool = True) -> StreamingQuery:
    """Store places as they move, one folder for each micro-batch of a run; a repeated micro-batch replaces its own."""
    spark = moved.sparkSession

    def send(batch: DataFrame, number: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(f"{path}/run={run}/batch={number}")  # a row per scheduler

    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)  # timers need it; the query keeps what holds when it starts
    try:
        writer = moved.writeStream.outputMode("update").foreachBatch(send).option("checkpointLocation", checkpoint)
        trigger = {"availableNow": True} if available_now else {"processingTime": f"{OVERLAP} seconds"}
        return writer.trigger(**trigger).start()
    finally:
        spark.conf.set(_STORE, before)


def write_history_stream(read: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append the chosen records to a table, each file of them exactly once."""
    writer = read.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{OVERLAP} seconds"}
    return writer.trigger(**trigger).start()


def read_places(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The furthest stored place of every scheduler, of runs before a time; nothing without stored places."""
    try:
        stored = spark.read.schema(f"{PLACES}, run long, batch long").parquet(path)
        if before is not None:
            stored = stored.filter(F.col("run") < before)
        return stored.groupBy("schedd").agg(F.max("last_completion").alias("last_completion"))
    except AnalysisException:
        return spark.createDataFrame([], "schedd string, last_completion long")
