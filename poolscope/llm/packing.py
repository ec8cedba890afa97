"""Packing documents into sequences of one length: lexical retrieval packing.

Documents are dealt into shards of about ``SHARD_BYTES`` of text by a hash. A shard is encoded once and stored as one
row. Each shard gets its own BM25 inverted index over the ids of its whole documents, with idf and the mean length
counted over *all* documents. A document longer than a sequence gives full sequences; what is left of each
document is a seed or a neighbour. The longest unused rest is the seed; its strongest terms (``QUERY_TERMS``) look up
the index, and unused neighbours fill the window in order of score. What then remains is filled by
the longest rests that fit, and by a cut of the best unused rest if at least ``LEAST_CUT`` ids have room. So each shard
pads its last sequence only, but for a few ids.

The shard is the bound of memory: one task holds one shard's ids and index. Shards grow in number, not in size.

Results by case: null or empty text is the end id alone. Repeated rows and rows of one id are documents of their own.
Rows without an id are packed too. An empty table gives no rows. Extra columns are ignored. One text larger than a
shard makes a larger shard.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolscope.llm.common import give_back_memory, stored
from poolscope.llm.tokens import encoder
from poolscope.llm.words import text_slices

SHARD_BYTES = 8_000_000
QUERY_TERMS = 32
LEAST_CUT = 16
K1, B = 1.2, 0.75
SHARDS = "shard int, doc_ids array<long>, lengths array<long>, ids binary, terms array<int>, doc_counts array<long>"
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def _encoded(vocabulary_path: str, keep_space: bool, end_id: int):
    """One row per shard: its documents' ids, and in how many documents each id occurs."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
        encode = encoder(vocabulary_path, keep_space)
        texts = rows.column("text").combine_chunks() if rows.num_rows else pa.array([], pa.string())
        vocabulary = max(encode.vocabulary, end_id + 1)
        kind = np.uint16 if vocabulary <= 65536 else np.uint32
        parts, lengths, found = [], [], np.zeros(vocabulary, dtype=np.int64)
        for _, data, offsets in text_slices(texts):
            ids, begins = encode.encode(data, offsets, end_id)
            sizes = np.diff(begins)
            parts.append(ids.astype(kind)), lengths.append(sizes)
            # no document is in two slices, so its distinct ids are counted in its own
            seen = np.unique(np.repeat(np.arange(len(sizes)), sizes) * vocabulary + ids) % vocabulary
            found += np.bincount(seen, minlength=vocabulary)
        ids, lengths = np.concatenate(parts).tobytes(), np.concatenate(lengths)
        terms = np.flatnonzero(found)
        counts = found[terms]
        parts = seen = None
        give_back_memory()
        return pa.table({
            "shard": pa.array([key[0].as_py()], pa.int32()), "doc_ids": pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64())),
            "lengths": pa.array([lengths.tolist()], pa.list_(pa.int64())), "ids": pa.array([ids], pa.binary()),
            "terms": pa.array([terms.tolist()], pa.list_(pa.int32())), "doc_counts": pa.array([counts.tolist()], pa.list_(pa.int64()))})

    return run


class Index:
    """BM25 weights of a shard's documents, by document and by term."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, idf: np.ndarray, mean: float):
        vocabulary = len(idf)
        of = np.repeat(np.arange(len(lengths)), lengths)
        pairs, counts = np.unique(of * vocabulary + ids, return_counts=True)
        self.size, docs, terms = len(lengths), (pairs // vocabulary).astype(np.int32), (pairs % vocabulary).astype(np.int32)
        del of, pairs
        weights = idf[terms] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * lengths[docs] / mean))
        self.first = np.searchsorted(docs, np.arange(self.size + 1))
        self.terms, self.weights = terms, weights
        order = np.argsort(terms, kind="stable")
        self.posted, self.posted_weights = docs[order], weights[order]
        self.begins = np.searchsorted(terms[order], np.arange(vocabulary + 1))

    def scores(self, doc: int) -> np.ndarray:
        """Scores of all documents for the strongest terms of one."""
        own = slice(self.first[doc], self.first[doc + 1])
        terms, weights = self.terms[own], self.weights[own]
        if len(terms) > QUERY_TERMS:
            terms = terms[np.argpartition(weights, -QUERY_TERMS)[-QUERY_TERMS:]]
        spans = [slice(self.begins[t], self.begins[t + 1]) for t in terms.tolist()]
        docs = np.concatenate([self.posted[s] for s in spans])
        return np.bincount(docs, np.concatenate([self.posted_weights[s] for s in spans]), minlength=self.size)


def fill(lengths: np.ndarray, index: Index, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of pieces ``(document, start, length)``."""
    rest = {}
    for doc, n in enumerate(lengths.tolist()):
        for start in range(0, n - window + 1, window):
            yield [(doc, start, window)]
        if n % window:
            rest[doc] = n // window * window  # where the rest begins
    unused = sorted((int(lengths[d]) - s, d) for d, s in rest.items())  # by length

    def take(doc: int) -> None:
        unused.pop(bisect.bisect_left(unused, (int(lengths[doc]) - rest[doc], doc)))

    while unused:
        n, seed = unused.pop()
        pieces, room = [(seed, rest.pop(seed), n)], window - n
        if room and unused:
            scores = index.scores(seed)
            near = np.flatnonzero(scores)
            near = [d for d in near[np.argsort(-scores[near], kind="stable")].tolist() if d in rest]
            for doc in near:
                size = int(lengths[doc]) - rest[doc]
                if size <= room:
                    take(doc)
                    pieces.append((doc, rest.pop(doc), size))
                    room -= size
            while room and unused and unused[0][0] <= room:
                size, doc = unused.pop(bisect.bisect_right(unused, (room, len(lengths))) - 1)
                pieces.append((doc, rest.pop(doc), size))
                room -= size
            if room >= LEAST_CUT and unused:
                doc = next((d for d in near if d in rest), unused[-1][1])
                take(doc)
                pieces.append((doc, rest[doc], room))
                rest[doc] += room
                bisect.insort(unused, (int(lengths[doc]) - rest[doc], doc))
        yield pieces


def _packed(idf, mean: float, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = idf.value
        for batch in batches:
            for shard, doc_ids, lengths, payload in zip(*(batch.column(k) for k in ("shard", "doc_ids", "lengths", "ids"))):
                lengths, doc_ids = np.asarray(lengths.values), doc_ids.values
                ids = np.frombuffer(payload.as_buffer(), np.uint16 if len(weights) <= 65536 else np.uint32)
                index = Index(ids, lengths, weights, mean)
                begins = np.concatenate([[0], np.cumsum(lengths)])
                docs, starts, sizes, sums, numbers, offsets = [], [], [], [], [], []
                for number, pieces in enumerate(fill(lengths, index, window)):
                    offset = 0
                    for doc, start, size in pieces:
                        at = int(begins[doc]) + start
                        docs.append(doc), starts.append(start), sizes.append(size), offsets.append(offset)
                        sums.append(zlib.crc32(ids[at : at + size].astype("<u4"))), numbers.append((shard.as_py() << 32) + number)
                        offset += size
                docs = np.array(docs, dtype=np.int64)
                yield pa.record_batch(
                    [doc_ids.take(pa.array(docs)), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()),
                     pa.array(lengths[docs]), pa.array(numbers, pa.int64()), pa.array(offsets, pa.int64())],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
        give_back_memory()

    return run


def pack_documents(docs: DataFrame, vocabulary_path: str, *, keep_space: bool, end_id: int, window: int = 4096) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most ``window`` ids."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-int(size) // SHARD_BYTES))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int"))
    encoded = stored(dealt.groupBy("shard").applyInArrow(_encoded(vocabulary_path, keep_space, end_id), SHARDS), "packing-shards")
    counts = encoded.select(F.explode(F.arrays_zip("terms", "doc_counts")).alias("t")).groupBy(F.col("t.terms").alias("term"))
    vocabulary = max(Tokenizer.from_file(vocabulary_path).get_vocab_size(), end_id + 1)
    found = np.zeros(vocabulary)  # one number for each id of the vocabulary
    for row in counts.agg(F.sum("t.doc_counts").alias("n")).collect():
        found[row.term] = row.n
    total = encoded.agg(F.sum(F.size("lengths")).alias("docs"),
                        F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda x, y: x + y)).alias("ids")).first()
    n = total.docs or 0
    idf = spark.sparkContext.broadcast(np.log1p((n - found + 0.5) / (found + 0.5)))
    return encoded.select("shard", "doc_ids", "lengths", "ids").mapInArrow(_packed(idf, (total.ids or 1) / max(n, 1), window), PIECES)
