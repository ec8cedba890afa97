"""Messages in bunches of a bounded number, as the broker takes them: a data source that counts what it delivers.

Every task cuts its messages into bunches, writes each as a file of JSON lines and reports how many messages it was given (*received*),
how many it delivered (*sent*) and how long that took. Files have fresh names and count only when the batch's report, which is
written once when all tasks are done, names them: a task that is tried again, or runs twice, adds nothing.
"""

from __future__ import annotations

import json
import sys
import time
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from poolscope.session import qualified

# The code itself travels to the Python workers: they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Messages of a bunch (fixed value).
BUNCH_SIZE = 5000
REPORT = "received long, sent long, elapsed double, bunches array<struct<file:string,messages:long>>"


@dataclass
class Delivered(WriterCommitMessage):
    """What a task delivered."""

    received: int
    sent: int
    elapsed: float
    bunches: list


class BunchWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.batch = options["path"].rstrip("/"), options["batch"]
        self.size = int(options.get("size", BUNCH_SIZE))
        self.most_bytes = int(options.get("mostbytes", 1 << 30))

    def _save(self, place: str, lines: list[str]) -> None:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(place)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(path) as out:
            out.write("".join(line + "\n" for line in lines).encode())

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        begin, received, bunches, held = time.monotonic(), 0, [], []

        def deliver(lines: list[str]) -> None:
            name = f"bunch-{uuid.uuid4().hex}.json"
            self._save(f"{self.path}/bunches/{name}", lines)
            bunches.append({"file": name, "messages": len(lines)})

        for batch in iterator:
            received += batch.num_rows
            # a message that the broker would not take is received but not sent
            held += [line for line in batch.column(0).to_pylist() if line is not None and len(line.encode()) <= self.most_bytes]
            while len(held) >= self.size:
                deliver(held[: self.size])
                held = held[self.size :]
        if held:
            deliver(held)
        sent = sum(b["messages"] for b in bunches)
        return Delivered(received, sent, time.monotonic() - begin, bunches)

    def commit(self, messages: list) -> None:
        done = [asdict(m) for m in messages if m is not None]
        self._save(f"{self.path}/reports/batch-{self.batch}.json", [json.dumps(d) for d in done])

    def abort(self, messages: list) -> None:
        pass  # files that no report names do not count


class BunchSink(DataSource):
    """Format ``bunches``; options ``path`` (a URI), ``batch``, ``size``, ``mostBytes``. Takes one text column."""

    @classmethod
    def name(cls) -> str:
        return "bunches"

    def writer(self, schema, overwrite: bool) -> BunchWriter:
        return BunchWriter({k.lower(): v for k, v in self.options.items()})


def write_bunches(messages: DataFrame, path: str, batch: int, size: int = BUNCH_SIZE, most_bytes: int | None = None) -> None:
    """Deliver messages in bunches of at most ``size``. The same batch again replaces its report, and so its bunches."""
    spark = messages.sparkSession
    spark.dataSource.register(BunchSink)
    options = {"path": qualified(spark, path), "batch": str(batch), "size": str(size)}
    if most_bytes is not None:
        options["mostBytes"] = str(most_bytes)
    lines = messages.select(F.to_json(F.struct(*messages.columns)).alias("line"))
    lines.write.format("bunches").options(**options).mode("append").save()


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """What was received and sent, a row per task of every batch, with its bunches."""
    return spark.read.schema(REPORT).json(f"{path}/reports")


def read_bunches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Delivered messages with the file of their bunch. Files that no report names are passed over."""
    named = read_reports(spark, path).select(F.explode("bunches.file").alias("bunch"))
    rows = spark.read.schema(schema).json(f"{path}/bunches").withColumn("bunch", F.col("_metadata.file_name"))
    return rows.join(named, "bunch", "left_semi")
