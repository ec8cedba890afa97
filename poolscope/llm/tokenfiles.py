"""Token ids of documents in binary files: fixed-width bit packing.

Every id takes the least number of bits that holds the vocabulary. A file has a header, its documents' ids and
first places, the byte offset of each block, and the packed blocks; a block is a whole number of 64-id groups, which
fill whole 64-bit words, so numpy unpacks many groups at once and any range of ids needs its own blocks only.

Documents are range-partitioned and sorted by id. Each task streams its part and closes a file every ``FILE_IDS`` ids;
a file is written once, under a name of its own, and counts only if the task's row reaches the manifest (a table in
the same folder), so a repeated or lost task leaves at most a file that nothing refers to. What all tasks need
together is one row per file.

Results by case: null or empty text has the end id only. Rows without an id come first; rows of one id follow one
another in the order of their texts. An empty table makes an empty manifest. Extra columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from poolscope.llm.tokens import encoder
from poolscope.llm.words import text_slices

MAGIC = b"TOKBITS1"
HEADER = np.dtype([("magic", "S8"), ("bits", "<u4"), ("block_ids", "<u4"), ("docs", "<u8"), ("ids", "<u8"), ("blocks", "<u8")])
GROUP = 64
BLOCK_IDS = 64 * 256
FILE_IDS = 16_000_000
MANIFEST = "path string, number int, first_doc long, docs long, ids long"


def bits_for(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """Ids as 64-bit words, ``bits`` words for each group of 64 ids (zeros fill the last group)."""
    groups = np.zeros(-(-len(ids) // GROUP) * GROUP, dtype=np.uint64)
    groups[: len(ids)] = ids
    groups = groups.reshape(-1, GROUP)
    words = np.zeros((len(groups), bits), dtype="<u8")
    for k in range(GROUP):
        word, shift = divmod(k * bits, 64)
        words[:, word] |= groups[:, k] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= groups[:, k] >> np.uint64(64 - shift)
    return words.ravel()


def unpack(words: np.ndarray, bits: int) -> np.ndarray:
    """The ids of whole groups."""
    words = words.reshape(-1, bits)
    ids = np.empty((len(words), GROUP), dtype=np.uint32)
    mask = np.uint64(2**bits - 1)
    for k in range(GROUP):
        word, shift = divmod(k * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        ids[:, k] = value & mask
    return ids.ravel()


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, ids: np.ndarray, begins: np.ndarray, doc_ids: pa.Array, bits: int) -> None:
    """One file: ``begins`` has the first id of each document and, last, the number of ids."""
    blocks = -(-len(ids) // BLOCK_IDS)
    offsets = np.minimum(np.arange(blocks + 1) * (BLOCK_IDS // GROUP), -(-len(ids) // GROUP)) * bits * 8
    header = np.array([(MAGIC, bits, BLOCK_IDS, len(doc_ids), len(ids), blocks)], dtype=HEADER)
    system, path = _open(uri)
    with system.open_output_stream(path) as out:
        out.write(header.tobytes())
        out.write(np.asarray(doc_ids.is_valid(), dtype=np.uint8).tobytes())
        out.write(np.asarray(doc_ids.fill_null(0), dtype="<i8").tobytes())
        out.write(begins.astype("<u8").tobytes())
        out.write(offsets.astype("<u8").tobytes())
        for k in range(0, len(ids), BLOCK_IDS * 64):
            out.write(pack(ids[k : k + BLOCK_IDS * 64], bits).tobytes())


class TokenFile:
    """Random access to a file of packed ids."""

    def __init__(self, uri: str):
        system, path = _open(uri)
        self.file = system.open_input_file(path)
        head = np.frombuffer(self.file.read_at(HEADER.itemsize, 0), dtype=HEADER)[0]
        if head["magic"] != MAGIC:
            raise ValueError(f"{uri} is no file of packed ids")
        self.bits, self.block_ids, self.docs, self.count = (int(head[k]) for k in ("bits", "block_ids", "docs", "ids"))
        at = HEADER.itemsize
        valid = np.frombuffer(self.file.read_at(self.docs, at), np.uint8).astype(bool)
        at += self.docs
        ids = np.frombuffer(self.file.read_at(8 * self.docs, at), "<i8")
        self.doc_ids = pa.array(ids, pa.int64(), mask=~valid)
        at += 8 * self.docs
        self.begins = np.frombuffer(self.file.read_at(8 * (self.docs + 1), at), "<u8").astype(np.int64)
        at += 8 * (self.docs + 1)
        size = 8 * (int(head["blocks"]) + 1)
        self.offsets = np.frombuffer(self.file.read_at(size, at), "<u8").astype(np.int64)
        self.payload = at + size

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop``; reads the blocks they lie in."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, -(-stop // self.block_ids)
        begin, end = int(self.offsets[first]), int(self.offsets[last])
        words = np.frombuffer(self.file.read_at(end - begin, self.payload + begin), "<u8")
        return unpack(words, self.bits)[start - first * self.block_ids : stop - first * self.block_ids]

    def document(self, place: int) -> np.ndarray:
        return self.ids(int(self.begins[place]), int(self.begins[place + 1]))


def _written(vocabulary_path: str, keep_space: bool, end_id: int, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary_path, keep_space)
        bits = bits_for(max(encode.vocabulary, end_id + 1))
        ids, begins, docs, held, number = [], [np.zeros(1, np.int64)], [], 0, 0

        def close() -> pa.RecordBatch:
            nonlocal ids, begins, docs, held, number
            uri, names = f"{folder}/{uuid.uuid4().hex}.tok", pa.concat_arrays(docs)
            write_file(uri, np.concatenate(ids), np.concatenate(begins), names, bits)
            row = pa.record_batch([[uri], pa.array([number], pa.int32()), names.slice(0, 1), [len(names)], [held]],
                                  names=["path", "number", "first_doc", "docs", "ids"])
            ids, begins, docs, held, number = [], [np.zeros(1, np.int64)], [], 0, number + 1
            return row

        for batch in batches:
            for first, data, offsets in text_slices(batch.column("text")):
                some, places = encode.encode(data, offsets, end_id)
                ids.append(some), begins.append(places[1:] + held), docs.append(batch.column("doc_id").slice(first, len(places) - 1))
                held += len(some)
                if held >= FILE_IDS:
                    yield close()
        if docs:
            yield close()

    return run


def write_tokens(docs: DataFrame, folder: str, vocabulary_path: str, *, keep_space: bool, end_id: int) -> None:
    """Write the ids of all documents below ``folder`` (a URI that every executor can reach)."""
    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).repartitionByRange("doc_id")
    rows = ordered.sortWithinPartitions("doc_id", "text").mapInArrow(
        _written(vocabulary_path, keep_space, end_id, f"{folder}/files"), MANIFEST)
    _open(f"{folder}/files")[0].create_dir(_open(f"{folder}/files")[1], recursive=True)
    rows.write.parquet(f"{folder}/manifest")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files in order, each with the number of ids before it. One row per file."""
    before = Window.orderBy(F.col("first_doc").asc_nulls_first(), "number").rowsBetween(Window.unboundedPreceding, -1)
    rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    return rows.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
            file = TokenFile(path)
            done = 0
            while done < file.docs:
                # as many documents as have about a million ids, one at least
                stop = max(done + 1, int(np.searchsorted(file.begins, file.begins[done] + 1_000_000)))
                stop = min(stop, file.docs)
                begins = file.begins[done : stop + 1]
                ids = file.ids(int(begins[0]), int(begins[-1])).astype("<u4")
                local = (begins - begins[0]).tolist()
                sums = [zlib.crc32(ids[s:e]) for s, e in zip(local[:-1], local[1:])]
                yield pa.record_batch(
                    [file.doc_ids.slice(done, stop - done), pa.array(begins[:-1] + start), pa.array(np.diff(begins)), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])
                done = stop


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: its place, length and the checksum of its ids."""
    files = manifest(spark, folder).select("path", "start")
    files = files.repartition(max(1, files.count()), "path")  # a file is much work for so short a row
    return files.mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")
