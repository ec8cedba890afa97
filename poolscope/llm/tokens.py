"""Token ids of many texts at once, by the tokenizers library.

Neither vocabulary used here has tokens across the start of a run of white space, so a text's ids are those of its
chunks one after another. Texts repeat most of their chunks: each distinct chunk is encoded once per worker process
and looked up by its hash. The cache is bounded by ``CACHED`` chunks and starts anew beyond it.
"""

from __future__ import annotations

import functools
import os

import numpy as np

from poolscope.llm.words import SPACES, prefix_hashes, span_hashes, word_spans

CACHED = 4_000_000
AT_ONCE = 10_000


class ChunkEncoder:
    """Ids of texts given as bytes and offsets; ``keep_space``: a chunk has the white space before its word."""

    def __init__(self, path: str, keep_space: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism here
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.keep_space = keep_space
        self._clear()

    def _clear(self) -> None:
        self.keys, self.begins = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.counts, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _spans(self, data: np.ndarray, offsets: np.ndarray):
        if not self.keep_space:
            return word_spans(data, offsets)
        space = SPACES[data]
        begins = np.zeros(len(data) + 1, dtype=bool)
        begins[1:-1] = space[1:] & ~space[:-1]
        begins[offsets] = True  # also the end, which is no start
        starts = np.flatnonzero(begins[:-1])
        return starts, np.append(starts[1:], len(data))[: len(starts)], np.searchsorted(starts, offsets)

    def _learn(self, data: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        raw = data.tobytes()
        texts = [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts.tolist(), ends.tolist())]
        found: list[list[int]] = []
        for k in range(0, len(texts), AT_ONCE):  # an encoding is much larger than its ids
            found += [e.ids for e in self.tokenizer.encode_batch_fast(texts[k : k + AT_ONCE], add_special_tokens=False)]
        counts = np.array([len(ids) for ids in found], dtype=np.int64)
        begins = len(self.ids) + np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
        self.ids = np.concatenate([self.ids, np.fromiter((i for ids in found for i in ids), np.uint32, int(counts.sum()))])
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.begins = np.insert(self.begins, at, begins)
        self.counts = np.insert(self.counts, at, counts)

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another (each followed by ``end_id``), and where each text's ids begin."""
        starts, ends, first = self._spans(data, offsets)
        keys, where, back = np.unique(span_hashes(prefix_hashes(data, lower=False), starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > CACHED:
            self._clear()
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        new = self.keys[at] != keys if len(self.keys) else np.ones(len(keys), dtype=bool)
        if new.any():
            self._learn(data, keys[new], starts[where[new]], ends[where[new]])
            at = np.searchsorted(self.keys, keys)
        at = at[back]
        counts = self.counts[at]
        total = np.concatenate([[0], np.cumsum(counts)])
        ids = self.ids[np.repeat(self.begins[at] - total[:-1], counts) + np.arange(total[-1])]
        places = total[first]
        if end_id is None:
            return ids, places
        return np.insert(ids, places[1:], np.uint32(end_id)), places + np.arange(len(places))


@functools.lru_cache(maxsize=2)
def encoder(path: str, keep_space: bool) -> ChunkEncoder:
    """The encoder of this process for a vocabulary file."""
    return ChunkEncoder(path, keep_space)
