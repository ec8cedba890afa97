"""Removal of word sequences that an earlier document has, by matching statistics over sharded FM-indexes.

A word goes if it lies in a window of ``length`` words that also starts in a document with a smaller id. Nothing is decided by
hashes: they only say where sequences are compared.

1. Anchors. Every window has one anchor, its smallest hash of ``ANCHOR`` words, at the same place in all copies of the window.
   Consecutive windows of one anchor make a *segment*. Batches ask (``batches``) which anchors occur in several documents; only
   their segments can have repeated windows. Anchors of more than ``HOT`` segments (a common phrase in ever new
   surroundings) are dealt out by window instead, so they are spread like any other text.
2. Shards. A segment goes to the shard of its anchor, so all copies of a window meet in one shard, and once for each batch however
   often the batch has it. A shard builds a compressed FM-index (``fmindex``) of its distinct segments and streams the
   segments' words through it: backward search gives the matching statistics, and each window whose statistic reaches ``length``
   gets the smallest document id in its interval.
3. Removal. Batches mark the windows whose smallest id is below their document's and write what is left.

Text crosses the network only in segments with an anchor of several documents, about three times the repeated text. Shards grow in
number with the segments, so a shard's index is bounded.

Results by case: null text has no words; texts shorter than a window stay whole; a very long text is a batch of its own. Rows that repeat
an id are one document: none of them is earlier than another. Rows without an id have no place in the order: they stay whole and
remove nothing. Extra columns are ignored, whatever they are called.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolscope.llm.batches import answers_of, ask, load_batch, per_batch, write_batches
from poolscope.llm.common import stored
from poolscope.llm.fmindex import FMIndex
from poolscope.llm.words import mixed, powers, prefix_hashes, sequence_hashes, span_hashes, word_spans

ANCHOR = 3
HOT = 5_000
SHARD_SEGMENTS = 50_000
BATCH_BYTES = 8_000_000
NONE = np.iinfo(np.int64).max
UNIQUE, SHARED, MANY = 0, 1, 2


@dataclass(frozen=True)
class _Segments:
    """Runs of windows with one anchor: anchor, document id (``NONE`` without one), first word, windows, hash of the words."""

    anchor: np.ndarray
    doc: np.ndarray
    word: np.ndarray
    windows: np.ndarray
    digest: np.ndarray


class _Text:
    """A batch's words: hashes, places in the bytes of their slice, and each row's first word (and the end)."""

    def __init__(self, path: str, length: int):
        self.batch, self.length = load_batch(path), length
        ids = self.batch.rows.column("doc_id").combine_chunks()
        self.ids = np.asarray(ids.fill_null(NONE)) if len(ids) else np.zeros(0, np.int64)
        hashes, bytes_, sizes, counts = [], [], [], []
        for _, data, offsets in self.batch.slices():
            starts, ends, first = word_spans(data, offsets)
            hashes.append(span_hashes(prefix_hashes(data, lower=False), starts, ends))
            inside = np.zeros(len(data) + 1, dtype=np.int8)
            inside[starts] += 1
            inside[ends] -= 1
            bytes_.append(data[np.cumsum(inside[:-1], dtype=np.int8) > 0])
            sizes.append(ends - starts)
            counts.append(np.diff(first))
        none = [np.zeros(0, np.int64)]
        self.hashes = np.concatenate(hashes or [np.zeros(0, np.uint64)])
        self.bytes = np.concatenate(bytes_ or [np.zeros(0, np.uint8)])
        self.ends = np.cumsum(np.concatenate(sizes or none))
        self.starts = self.ends - np.concatenate(sizes or none)
        self.first = np.concatenate([[0], np.cumsum(np.concatenate(counts or none))])

    def joined(self, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and offsets of runs of ``counts`` words, which begin at ``words``, a space after each word."""
        sizes = self.ends - self.starts + 1
        places = np.concatenate([[0], np.cumsum(sizes)])
        spaced = np.full(int(places[-1]), 0x20, dtype=np.uint8)
        inside = np.ones(len(spaced), dtype=bool)
        inside[places[1:] - 1] = False
        spaced[inside] = self.bytes
        begins, ends = places[words], places[words + counts]
        lengths = ends - begins
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        return spaced[np.repeat(begins - offsets[:-1], lengths) + np.arange(offsets[-1])], offsets

    def segments(self) -> _Segments:
        n, length = len(self.hashes), self.length
        row = np.repeat(np.arange(len(self.ids)), np.diff(self.first))
        last = n - length + 1
        empty = np.zeros(0, np.int64)
        if last <= 0:
            return _Segments(empty.astype(np.uint64), empty, empty, empty, empty.astype(np.uint64))
        grams = sequence_hashes(self.hashes, ANCHOR)
        # the place in the low half settles ties; within a window it is the same in all copies
        ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        chosen = ranked[:last].copy()
        for k in range(1, length - ANCHOR + 1):
            np.minimum(chosen, ranked[k : k + last], out=chosen)
        chosen = (chosen & np.uint64(0xFFFFFFFF)).astype(np.int64)
        valid = (row[:last] == row[length - 1 :]) & (self.ids[row[:last]] != NONE)
        start = np.flatnonzero(valid)
        chosen = chosen[start]
        fresh = np.ones(len(start), dtype=bool)
        fresh[1:] = (chosen[1:] != chosen[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(fresh)
        word, windows = start[first], np.diff(np.append(first, len(start)))
        up, down = powers(n + 1)
        running = np.concatenate([[np.uint64(0)], np.cumsum(mixed(self.hashes) * up[:n])])
        digest = mixed((running[word + windows + length - 1] - running[word]) * down[word] + windows.astype(np.uint64))
        return _Segments(grams[chosen[first]], self.ids[row[word]], word, windows, digest)


def _anchors(s: _Segments) -> tuple[np.ndarray, ...]:
    """Distinct anchors with their least and greatest document, different segments, and each segment's anchor."""
    order = np.lexsort((s.digest, s.anchor))
    a, d = s.anchor[order], s.digest[order]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = a[1:] != a[:-1]
    other = fresh.copy()
    other[1:] |= d[1:] != d[:-1]
    begins = np.flatnonzero(fresh)
    back = np.empty(len(order), dtype=np.int64)
    back[order] = np.cumsum(fresh) - 1
    if not len(begins):
        return a, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), back
    docs = s.doc[order]
    return (a[begins], np.minimum.reduceat(docs, begins), np.maximum.reduceat(docs, begins),
            np.add.reduceat(other.astype(np.int64), begins), back)


def _ask_anchors(length: int):
    def question(path: str):
        keys, low, high, count, _ = _anchors(_Text(path, length).segments())
        return keys, (low, low != high, np.minimum(count, HOT + 1))

    return question


def _judge_anchors(keys: np.ndarray, facts: tuple[np.ndarray, ...], batch: np.ndarray):
    """Whether an anchor is in one document, in several, or in more segments than a shard should have of it."""
    low, several, count = facts
    distinct, back = np.unique(keys, return_inverse=True)
    least, most = np.full(len(distinct), NONE), np.full(len(distinct), -NONE - 1)
    np.minimum.at(least, back, low)
    np.maximum.at(most, back, low)
    shared = (least < most) | (np.bincount(back, several, len(distinct)) > 0)
    segments = np.bincount(back, count, len(distinct)).astype(np.int64)
    found = np.where(shared, np.where(segments > HOT, MANY, SHARED), UNIQUE).astype(np.uint8)
    windows = np.where(found == MANY, 6, 1) * segments  # segments are cut into windows where there are many
    return found[back], (int(windows[shared].sum()), int(np.count_nonzero(found == MANY)))


class _Asked:
    """Distinct sequences a batch asks for: text, key, number of windows, least document; and all places that have them."""

    def __init__(self, text: _Text, answer: np.ndarray):
        segments = text.segments()
        kind = answer[_anchors(segments)[4]] if len(answer) else np.zeros(len(segments.word), np.uint8)
        whole, cut = kind == SHARED, kind == MANY
        parts = segments.windows[cut]
        inside = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        each = np.repeat(segments.word[cut], parts) + inside
        windows = sequence_hashes(text.hashes, text.length)
        self.word = np.concatenate([segments.word[whole], each])
        self.windows = np.concatenate([segments.windows[whole], np.ones(len(each), np.int64)])
        self.doc = np.concatenate([segments.doc[whole], np.repeat(segments.doc[cut], parts)])
        key = np.concatenate([segments.anchor[whole], windows[each]])
        data, offsets = text.joined(self.word, self.windows + text.length - 1)
        made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.word), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = made.dictionary_encode()
        self.number = coded.indices.to_numpy().astype(np.int64)
        self.texts = coded.dictionary
        n = len(self.texts)
        self.low = np.full(n, NONE)
        np.minimum.at(self.low, self.number, self.doc)
        self.key, self.size = np.zeros(n, np.uint64), np.zeros(n, np.int64)
        self.key[self.number], self.size[self.number] = key, self.windows


SEGMENTS = "shard long, batch string, number long, low long, words binary"


def _send_segments(length: int, shards: int):
    def use(path: str, rows: pa.Table) -> pa.Table:
        asked = _Asked(_Text(path, length), answers_of(rows, np.uint8))
        n = len(asked.texts)
        return pa.table({
            "shard": pa.array((mixed(asked.key) % np.uint64(shards)).astype(np.int64)),
            "batch": pa.array([path.rsplit("/", 1)[-1]] * n, pa.string()), "number": pa.array(np.arange(n)),
            "low": pa.array(asked.low), "words": asked.texts.cast(pa.binary())})

    return use


def _search_shard(length: int):
    """For sequences in which a window occurs in an earlier document than the batch knows: the least document of each window."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        coded = pa.chunked_array([rows.column("words").combine_chunks()]).dictionary_encode().combine_chunks()
        number, low = coded.indices.to_numpy(), rows.column("low").to_numpy()
        texts = coded.dictionary.cast(pa.large_binary())
        least = np.full(len(texts), NONE)
        np.minimum.at(least, number, low)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        starts, ends, first = word_spans(data, offsets - offsets[0])
        spaces = np.ones(len(data), dtype=bool)
        spaces[ends] = False  # every word is followed by one space
        bytes_, places = data[spaces], np.concatenate([[0], np.cumsum(ends - starts)])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(bytes_.copy())])
        symbols = words.dictionary_encode().indices.to_numpy().astype(np.int64) + 1
        text = np.insert(symbols, first[1:], 0)
        begins = first[:-1] + np.arange(len(texts))
        counts = np.diff(first)
        index = FMIndex(text, length)
        windows = counts - length + 1
        at = np.concatenate([[0], np.cumsum(windows)])
        asked = np.repeat(begins - at[:-1], windows) + np.arange(at[-1])
        statistic, lo, hi = index.matches(asked, length)
        found = np.repeat(least, windows)
        again = np.flatnonzero(statistic >= length)
        owner = np.repeat(least, counts + 1)
        found[again] = index.least(owner, lo[again], hi[again])
        earlier = np.minimum.reduceat(found, at[:-1]) if len(texts) else found
        rows = rows.filter(pa.array(earlier[number] < low))
        number = number[earlier[number] < low]
        packed = [found[s:e].tobytes() for s, e in zip(at[number].tolist(), at[number + 1].tolist())]
        return pa.table({"batch": rows.column("batch"), "number": rows.column("number"), "least": pa.array(packed, pa.binary())})

    return run


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _removed(length: int, with_text: bool):
    def use(path: str, rows: pa.Table) -> pa.Table:
        text = _Text(path, length)
        kind = rows.column("kind").to_numpy()
        asked = _Asked(text, answers_of(rows.filter(pa.array(kind == 1)), np.uint8))
        found = rows.filter(pa.array(kind == 2))
        at = np.concatenate([[0], np.cumsum(asked.size)])
        least = np.repeat(asked.low, asked.size)
        for number, packed in zip(found.column("number").to_pylist(), found.column("least").to_pylist()):
            least[at[number] : at[number + 1]] = np.frombuffer(packed, np.int64)
        inside = np.arange(asked.windows.sum()) - np.repeat(np.cumsum(asked.windows) - asked.windows, asked.windows)
        later = least[np.repeat(at[asked.number], asked.windows) + inside] < np.repeat(asked.doc, asked.windows)
        starts = (np.repeat(asked.word, asked.windows) + inside)[later]
        n = len(text.hashes)
        edges = np.bincount(starts, minlength=n + 1) - np.bincount(starts + length, minlength=n + 1)
        kept = np.cumsum(edges[:n]) == 0
        counts = np.concatenate([[0], np.cumsum(kept)])
        words = np.flatnonzero(kept)
        data, offsets = text.joined(words, np.ones(len(words), np.int64))
        begins, ends = offsets[counts[text.first[:-1]]], offsets[counts[text.first[1:]]]
        left = [data[s : max(s, e - 1)].tobytes() for s, e in zip(begins.tolist(), ends.tolist())]
        sizes = np.diff(text.first)
        columns = {"doc_id": text.batch.rows.column("doc_id"), "n_words": pa.array(sizes, pa.int64()),
                   "n_removed": pa.array(sizes - np.diff(counts[text.first]), pa.int64()),
                   "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string())}
        return pa.table({**columns, "kept": pa.array([x.decode() for x in left], pa.string())} if with_text else columns)

    return use


def remove_repeated_words(docs: DataFrame, length: int = 13, with_text: bool = True) -> DataFrame:
    """What is left of every document: counts, a digest and (``with_text``) the words in ``kept``."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    batches = write_batches(rows, "substrings", BATCH_BYTES)
    anchors = ask(batches, _ask_anchors(length), (np.int64, np.uint8, np.int16), _judge_anchors, "substrings-anchors")
    segments = anchors.agg(F.sum("total_a")).first()[0] or 0
    shards = -(-segments // SHARD_SEGMENTS) or 1
    sent = per_batch(anchors, _send_segments(length, shards), SEGMENTS)
    found = stored(sent.groupBy("shard").applyInArrow(_search_shard(length), "batch string, number long, least binary"), "substrings-found")
    known = anchors.select("path", "bucket", "answer", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("number"), F.lit(None).cast("binary").alias("least"))
    folder = F.lit(f"{batches.folder}/")
    new = found.select(F.concat(folder, "batch").alias("path"), F.lit(None).cast("long").alias("bucket"), F.lit(None).cast("binary").alias("answer"), F.lit(2).alias("kind"), "number", "least")
    both = known.unionByName(new)
    return both.groupBy("path").applyInArrow(
        lambda key, rows: _removed(length, with_text)(key[0].as_py(), rows), RESULT + (", kept string" if with_text else ""))
