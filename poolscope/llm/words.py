"""Vectorised words, hashes and shingles over the bytes of many texts at once.

Texts come as Arrow strings, so their bytes lie in one buffer. A word is a run of bytes other than
``\\x20`` and ``\\x09-\\x0D``; words never cross texts. Hashes are 64-bit polynomials over random
byte values, with a final mix; ``A-Z`` hash as ``a-z``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; the arrays made for them take about fifty times as much.
SLICE_BYTES = 1_000_000

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_RANDOM = np.random.default_rng(20240131)
_BYTES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 2**64)
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, ``n`` of each."""
    if len(_POWERS["up"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _UNBASE)):
            values = np.full(size, base, dtype=np.uint64)
            values[0] = 1
            _POWERS[name] = np.multiply.accumulate(values)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def prefix_hashes(data: np.ndarray, lower: bool = True) -> np.ndarray:
    """Running polynomial hash; the hash of ``data[s:e]`` is ``(H[e] - H[s]) * base ** -s``."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_LOWER if lower else _BYTES)[data] * powers(len(data))[0], out=out[1:])
    return out


def span_hashes(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed hashes of ``data[starts:ends]``, with the length in them."""
    down = powers(len(running))[1]
    lengths = (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mixed((running[ends] - running[starts]) * down[starts] + lengths)


def text_slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Consecutive texts of at most ``most`` bytes together (a longer one alone): first row, bytes, offsets."""
    if pa.types.is_large_string(texts.type) or pa.types.is_string_view(texts.type):
        texts = texts.cast(pa.string())
    texts = texts.fill_null("") if texts.null_count else texts
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        last = min(last, n)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and where each text's words begin in these lists (one more at the end)."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~SPACES[data]
    fresh = np.zeros(len(data) + 1, dtype=bool)
    fresh[offsets] = True
    here, before = inside[1:], inside[:-1]
    starts = np.flatnonzero(here & (~before | fresh))
    ends = np.flatnonzero(before & (~here | fresh))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's words begin in them."""
    starts, ends, first = word_spans(data, offsets)
    return span_hashes(prefix_hashes(data, lower), starts, ends), first


def sequence_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of ``width`` words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, width, dtype=np.uint64)
    up = powers(width + 1)[0]
    for k in range(width):
        total += words[k : k + n] * up[k + 1]
    return mixed(total)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """For each text, its sorted distinct word shingles; fewer words than ``width`` are one shingle."""
    words, first = word_hashes(data, offsets)
    windows = sequence_hashes(words, width)
    for s, e in zip(first[:-1].tolist(), first[1:].tolist()):
        if e - s >= width:
            yield np.unique(windows[s : e - width + 1])
        elif e > s:
            yield sequence_hashes(words[s:e], e - s)
        else:
            yield np.zeros(0, np.uint64)
