"""Exact removal of repeated substrings by prefix-free parsing.

Every byte covered by a ``length``-byte string that also starts earlier (in a document of a smaller id, or earlier in
the same document) is removed. Matches never cross documents; strings are judged on the input.

Parsing: a rolling hash over ``trigger`` bytes selects triggers that cut texts into phrases. A trigger is the smallest
hash of a string of ``length`` bytes (winnowing), so each such string has exactly one trigger, at the same place in all
its copies. A trigger's *context*, all bytes of the strings it stands for, is the phrases around it. As in
prefix-free parsing, positions are then compared through the dictionary of phrases and not through every
suffix of the text. What is compared is equality over ``length`` bytes only; so where the classic construction sorts
dictionary and parse into suffix arrays, this one sorts 64-bit hashes of triggers, contexts and strings by ranges:

1. triggers and contexts: per trigger, which occurrence of each context comes first, and whether the trigger has
   several contexts. Occurrences of a context after its first are repeated as a whole;
2. strings: only for first contexts of triggers with several contexts, which string comes first. The first
   occurrence of any string lies in the first occurrence of its context, so nothing is missed.

Each step is a question of batches (``batches``): a batch asks once for each key, however often the key occurs in it,
and a bucket compares first places by (document id, batch). Strings of step 2 are told apart by 96 bits made from one hash.

Results by case: null text counts as empty; texts shorter than ``length`` stay whole. Rows that repeat an id are
compared in the order of batches and rows. Rows without an id come before all others. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolscope.llm.batches import answers_of, ask, load, load_batch, per_batch, save, write_batches
from poolscope.llm.common import stored
from poolscope.llm.words import mixed, powers, prefix_hashes

TRIGGER = 32
#: Text of a batch: the arrays made for it take up to about a hundred times as much.
BATCH_BYTES = 4_000_000
NO_ID = -(2**63)


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every window, by block-wise running minima from both sides."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    right = np.minimum.accumulate(blocks, axis=1).ravel()
    left = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(left[:n], right[width - 1 : width - 1 + n])


def _hashes(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return (running[ends] - running[starts]) * powers(len(running))[1][starts]


def parse(data: np.ndarray, offsets: np.ndarray, length: int, running: np.ndarray) -> tuple[np.ndarray, ...]:
    """Triggers of all texts: place, and the first and last start of the strings it stands for."""
    none = (np.zeros(0, np.int64),) * 3
    if len(data) < length:
        return none
    places = np.arange(len(data) - TRIGGER + 1)
    # the place in the low half settles ties; within a string it is the same in all copies
    rolled = (mixed(_hashes(running, places, places + TRIGGER)) & np.uint64(0xFFFFFFFF00000000)) | places.astype(np.uint64)
    chosen = (_window_minimum(rolled, length - TRIGGER + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.arange(len(chosen))
    within = starts + length <= np.repeat(offsets[1:], np.diff(offsets))[: len(chosen)]
    starts, chosen = starts[within], chosen[within]
    if not len(starts):
        return none
    fresh = np.ones(len(starts), dtype=bool)
    fresh[1:] = (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(fresh)
    return chosen[first], starts[first], starts[np.append(first[1:], len(starts)) - 1]


class _Parsed:
    """A batch with its triggers, in the order of (document id, place)."""

    def __init__(self, path: str, length: int):
        self.batch, self.length = load_batch(path), length
        ids = self.batch.rows.column("doc_id").combine_chunks()
        self.ids = np.asarray(ids.fill_null(NO_ID)) if len(ids) else np.zeros(0, np.int64)
        self.rank = np.empty(len(self.ids), dtype=np.int64)
        self.rank[np.argsort(self.ids, kind="stable")] = np.arange(len(self.ids))
        stored = load(f"{path}.parse")
        self.t, self.low, self.high, part = (stored.column(k).to_numpy() for k in ("t", "low", "high", "slice"))
        self.slices = list(self.batch.slices())
        self.spans = np.searchsorted(part, np.arange(len(self.slices) + 1))

    def each(self):
        """For each slice: number, first row, bytes, offsets and the range of its triggers."""
        for k, (first, data, offsets) in enumerate(self.slices):
            yield k, first, data, offsets, slice(self.spans[k], self.spans[k + 1])

    def described(self):
        """Trigger hash, context hash and row of every trigger."""
        triggers, contexts, rows = [], [], []
        for _, first, data, offsets, span in self.each():
            running = prefix_hashes(data, lower=False)
            t, low, end = self.t[span], self.low[span], self.high[span] + self.length
            triggers.append(mixed(_hashes(running, t, t + TRIGGER)))
            shape = (end - low).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + (t - low).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
            contexts.append(mixed(_hashes(running, low, end) + shape))
            rows.append(np.searchsorted(offsets, t, side="right") - 1 + first)
        empty = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        return tuple(np.concatenate(x or e) for x, e in zip((triggers, contexts, rows), empty))

    def contexts(self):
        """Distinct (trigger, context) pairs in order, the first occurrence of each, and each trigger's pair."""
        trigger, context, row = self.described()
        place = np.lexsort((self.t, self.rank[row])) if len(row) else np.zeros(0, np.int64)
        turn = np.empty(len(row), dtype=np.int64)
        turn[place] = np.arange(len(row))
        order = np.lexsort((turn, context, trigger))
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (trigger[order][1:] != trigger[order][:-1]) | (context[order][1:] != context[order][:-1])
        first = order[fresh]
        pair = np.empty(len(order), dtype=np.int64)
        pair[order] = np.cumsum(fresh) - 1
        return trigger[first], context[first], row, first, pair

    def strings(self, chosen: np.ndarray, row: np.ndarray):
        """Hashes (two) and places of all strings of the chosen triggers, by (document id, place)."""
        out = []
        for k, _, data, _, span in self.each():
            some = np.flatnonzero(chosen[span]) + span.start
            counts = self.high[some] - self.low[some] + 1
            starts = np.repeat(self.low[some] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            raw = _hashes(prefix_hashes(data, lower=False), starts, starts + self.length)
            rank = np.repeat(self.rank[row[some]], counts)
            # the second hash comes from the bytes around a third of the string, by another mix
            out.append((mixed(raw), (mixed(raw ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(32)).astype(np.uint32), starts, np.full(len(starts), k), rank))
        if not out:
            return (np.zeros(0, np.uint64), np.zeros(0, np.uint32), *(np.zeros(0, np.int64) for _ in range(3)))
        columns = [np.concatenate(c) for c in zip(*out)]
        order = np.lexsort((columns[2], columns[4]))
        return tuple(c[order] for c in columns)


def _save_parse(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                parts = []
                for k, (_, data, offsets) in enumerate(load_batch(path).slices()):
                    t, low, high = parse(data, offsets, length, prefix_hashes(data, lower=False))
                    parts.append((t, low, high, np.full(len(t), k)))
                columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 4
                save(f"{path}.parse", pa.table(dict(zip(("t", "low", "high", "slice"), (c.astype(np.int64) for c in columns)))))
            yield batch

    return run


def _first_contexts(keys: np.ndarray, facts: tuple[np.ndarray, ...], batch: np.ndarray):
    """1: the first occurrence of the context; 2: the trigger has several contexts."""
    context, doc = facts
    order = np.lexsort((batch, doc, context, keys))
    k, c = keys[order], context[order]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    new = np.ones(len(order), dtype=bool)
    new[1:] = k[1:] != k[:-1]
    group = np.cumsum(new) - 1
    several = np.bincount(group, fresh) > 1 if len(order) else np.zeros(0, bool)
    found = np.empty(len(order), dtype=np.uint8)
    found[order] = fresh + 2 * several[group]
    return found, (0, 0)


def _first_strings(keys: np.ndarray, facts: tuple[np.ndarray, ...], batch: np.ndarray):
    """1 where the string's first occurrence is."""
    check, doc = facts
    order = np.lexsort((batch, doc, check, keys))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (keys[order][1:] != keys[order][:-1]) | (check[order][1:] != check[order][:-1])
    found = np.empty(len(order), dtype=np.uint8)
    found[order] = fresh
    return found, (0, 0)


def _ask_contexts(length: int):
    def question(path: str):
        parsed = _Parsed(path, length)
        keys, context, row, first, _ = parsed.contexts()
        return keys, (context, parsed.ids[row[first]])

    return question


def _marked(parsed: _Parsed, rows: pa.Table):
    """Each trigger's row; whether its strings are all repeated; whether they are to be looked at one by one."""
    _, _, row, first, pair = parsed.contexts()
    answer = answers_of(rows, np.uint8)
    own = np.zeros(len(row), dtype=bool)
    own[first] = (answer & 1).astype(bool)
    return row, ~own, own & (answer[pair] >= 2)


def _ask_strings(length: int):
    def question(path: str, rows: pa.Table):
        parsed = _Parsed(path, length)
        row, _, open_ = _marked(parsed, rows)
        key, check, _, _, rank = parsed.strings(open_, row)
        keys, first = np.unique(key, return_index=True)
        return keys, (check[first], np.sort(parsed.ids, kind="stable")[rank[first]])

    return question


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _removed(length: int, with_text: bool):
    def use(path: str, rows: pa.Table) -> pa.Table:
        parsed = _Parsed(path, length)
        kind = rows.column("kind").to_numpy()
        row, repeated, open_ = _marked(parsed, rows.filter(pa.array(kind == 1)))
        key, _, start, part, _ = parsed.strings(open_, row)
        keys, first, back = np.unique(key, return_index=True, return_inverse=True)
        later = np.ones(len(key), dtype=bool)
        later[first] = answers_of(rows.filter(pa.array(kind == 2)), np.uint8) == 0
        out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
        for k, _, data, offsets, span in parsed.each():
            edges = np.zeros(len(data) + 1, dtype=np.int64)
            some = np.flatnonzero(repeated[span]) + span.start
            np.add.at(edges, parsed.low[some], 1)
            np.add.at(edges, parsed.high[some] + length, -1)
            mine = start[later & (part == k)]
            np.add.at(edges, mine, 1)
            np.add.at(edges, mine + length, -1)
            gone = np.cumsum(edges[:-1]) > 0
            for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                cut = gone[s:e]
                kept = data[s:e][~cut].tobytes()
                out["n_bytes"].append(e - s)
                out["n_removed"].append(int(cut.sum()))
                out["n_spans"].append(int(np.count_nonzero(cut[1:] & ~cut[:-1])) + int(e > s and cut[0]))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    out["kept"].append(kept)
        columns = {"doc_id": parsed.batch.rows.column("doc_id"), **{n: pa.array(out[n], pa.int64()) for n in ("n_bytes", "n_removed", "n_spans")},
                   "kept_sha256": pa.array(out["kept_sha256"], pa.string())}
        return pa.table({**columns, "kept": pa.array(out["kept"], pa.binary())} if with_text else columns)

    return use


def remove_repeats(docs: DataFrame, length: int = 100, with_text: bool = True) -> DataFrame:
    """What is left of every document, as digests and (``with_text``) as bytes in ``kept``."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    batches = write_batches(rows, "repeats", BATCH_BYTES)
    parsed = batches.manifest.repartition(max(1, batches.number), "path").mapInArrow(_save_parse(length), "path string")
    batches = replace(batches, manifest=stored(parsed, "repeats-parsed"))
    contexts = ask(batches, _ask_contexts(length), (np.uint64, np.int64), _first_contexts, "repeats-contexts")
    strings = ask(batches, _ask_strings(length), (np.uint32, np.int64), _first_strings, "repeats-strings", known=contexts)
    both = contexts.withColumn("kind", F.lit(1)).unionByName(strings.withColumn("kind", F.lit(2)))
    return per_batch(both, _removed(length, with_text), RESULT + (", kept binary" if with_text else ""))
