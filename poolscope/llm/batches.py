"""Batches of whole documents as files, and questions of batches that one task per key range answers.

Counting or ordering all n-grams or substrings of a corpus by a plain group-by would shuffle a row for each
occurrence. Here each batch of documents asks once for each of its distinct keys, with what it knows of them, as packed
arrays; a range of keys is one *bucket*, whose task sees all batches' arrays and answers in the order of the question.
What a bucket holds is bounded by the number of batches for any key, however often the key occurs, and buckets grow in
number with the data.

Batch files are written once under fresh names and count only when their row is in the stored manifest; every later
step derives from those files alone, so a repeated task asks the same questions.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolscope.llm.common import give_back_memory, stored
from poolscope.llm.words import text_slices
from poolscope.session import scratch_path

BATCH_BYTES = 8_000_000

#: What a batch asks: sorted distinct 64-bit keys and, for each key, what it tells of it (arrays of one length).
Question = tuple[np.ndarray, tuple[np.ndarray, ...]]


@dataclass(frozen=True)
class Batch:
    """Documents of one batch: their rows without the text, and their bytes."""

    rows: pa.Table
    texts: pa.Array

    def slices(self, most: int = 2_000_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        return text_slices(self.texts, most)


def _system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def save(uri: str, table: pa.Table) -> None:
    system, path = _system(uri)
    with system.open_output_stream(path) as out, pa.ipc.new_file(
        out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")
    ) as writer:
        writer.write_table(table)


def load(uri: str) -> pa.Table:
    system, path = _system(uri)
    with system.open_input_file(path) as source:
        return pa.ipc.open_file(source).read_all()


def load_batch(uri: str) -> Batch:
    table = load(uri).combine_chunks()
    texts = table.column("text").combine_chunks() if table.num_rows else pa.array([], pa.string())
    return Batch(table.drop_columns(["text"]), texts)


def _cut(folder: str, size: int):
    """Files of about ``size`` bytes of text, in the order the rows come; one row for each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        bytes_held = 0

        def close() -> pa.RecordBatch:
            nonlocal held, bytes_held
            uri, table = f"{folder}/{uuid.uuid4().hex}.arrow", pa.Table.from_batches(held)
            save(uri, table.set_column(table.schema.get_field_index("text"), "text", table.column("text").fill_null("")))
            held, bytes_held = [], 0
            return pa.record_batch([pa.array([uri])], names=["path"])

        for batch in batches:
            lengths = np.cumsum(np.asarray(pa.compute.binary_length(batch.column("text")).fill_null(0), dtype=np.int64))
            first = 0
            while first < batch.num_rows:
                before = lengths[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(lengths, before + size - bytes_held, side="right")))
                held.append(batch.slice(first, last - first))
                bytes_held += int(lengths[min(last, batch.num_rows) - 1] - before)
                first = last
                if bytes_held >= size or first < batch.num_rows:
                    yield close()
        if held:
            yield close()

    return run


@dataclass(frozen=True)
class Batches:
    """The files of a corpus. ``number`` is how many there are, and so how many buckets are used."""

    manifest: DataFrame
    number: int
    folder: str


def write_batches(rows: DataFrame, label: str, size: int = BATCH_BYTES) -> Batches:
    """Write ``rows`` (``text`` and other columns) as batch files in the shared folder."""
    folder = scratch_path(rows.sparkSession, label)
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    _system(folder)[0].create_dir(_system(folder)[1], recursive=True)
    names = stored(rows.mapInArrow(_cut(folder, size), "path string"), f"{label}-manifest")
    number = names.count()
    return Batches(names, number, folder)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of keys of equal width: monotonic in the key."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _packed(values: np.ndarray) -> bytes:
    """The values' lowest bytes, then their next ones, and so on: high bytes, mostly zero, cost almost nothing once compressed."""
    values = np.ascontiguousarray(values)
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _unpacked(data: pa.Scalar, kind: type) -> np.ndarray:
    planes = np.frombuffer(data.as_buffer(), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as the steps between them."""
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _unpacked_keys(data: pa.Scalar) -> np.ndarray:
    return np.cumsum(_unpacked(data, np.uint64), dtype=np.uint64)


def ask(
    batches: Batches,
    question: Callable[..., Question],
    kinds: tuple[type, ...],
    answer: Callable[[np.ndarray, tuple[np.ndarray, ...], np.ndarray], tuple[np.ndarray, tuple[int, int]]],
    label: str,
    known: DataFrame | None = None,
) -> DataFrame:
    """Answers of all batches as ``path``, ``bucket`` and ``answer`` (bytes), written to the shared folder.

    ``total_a`` and ``total_b`` are numbers of the bucket, on one row of it (0 on others), to be summed.

    ``question(path)``, or with ``known`` answers ``question(path, its known answers)``, gives a batch's keys and facts (of the types ``kinds``). ``answer(keys, facts, batch)`` gets all
    rows of one bucket, with the batch each came from, and returns one number for each row, and the two totals.
    """
    buckets = max(1, batches.number)

    def packed(path: str, asked: Question) -> pa.Table:
        keys, facts = asked
        of = bucket_of(keys, buckets)
        used, begins = np.unique(of, return_index=True)
        ends = np.append(begins[1:], len(keys))
        if not len(used):
            used, begins, ends = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        columns = [(keys.astype(np.uint64), _packed_keys), *((f.astype(k), _packed) for f, k in zip(facts, kinds))]
        parts = [pa.array([pack(c[b:e]) for b, e in zip(begins, ends)], pa.binary()) for c, pack in columns]
        return pa.table([pa.array(used), pa.array([path] * len(used)), *parts],
                        names=["bucket", "path", "keys", *(f"fact{k}" for k in range(len(kinds)))])

    def asked(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows:
            for path in row.column("path").to_pylist():
                yield from packed(path, question(path)).to_batches()
                give_back_memory()

    def answered(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        give_back_memory()
        rows = rows.sort_by("path")
        parts = [_unpacked_keys(x) for x in rows.column("keys")]
        sizes = [len(p) for p in parts]
        facts = tuple(
            np.concatenate([_unpacked(x, kind) for x in rows.column(f"fact{k}")]) for k, kind in enumerate(kinds))
        found, totals = answer(np.concatenate(parts), facts, np.repeat(np.arange(len(sizes)), sizes))
        places = np.concatenate([[0], np.cumsum(sizes)])
        return pa.table({"path": rows.column("path"), "bucket": rows.column("bucket"),
                         **{f"total_{k}": pa.array([n] + [0] * (len(sizes) - 1), pa.int64()) for k, n in zip("ab", totals)},
                         "answer": pa.array([_packed(found[s:e]) for s, e in zip(places[:-1], places[1:])], pa.binary())})

    schema = "bucket long, path string, keys binary" + "".join(f", fact{k} binary" for k in range(len(kinds)))
    if known is None:
        questions = batches.manifest.repartition(buckets, "path").mapInArrow(asked, schema)
    else:
        questions = per_batch(known, lambda path, rows: packed(path, question(path, rows)), schema)
    return stored(questions.groupBy("bucket").applyInArrow(answered, "path string, bucket long, total_a long, total_b long, answer binary"), label)


def answers_of(rows: pa.Table, kind: type) -> np.ndarray:
    """A batch's answers in the order of its keys."""
    rows = rows.sort_by("bucket")
    return np.concatenate([_unpacked(x, kind) for x in rows.column("answer")])


def per_batch(answers: DataFrame, use: Callable[[str, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``use(path, its answers)`` for every batch."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        try:
            return use(key[0].as_py(), rows)
        finally:
            give_back_memory()

    return answers.drop("total_a", "total_b").groupBy("path").applyInArrow(run, schema)
