"""Fill-in-middle transformation with a sparse index of multibyte characters.

A text is cut twice, between units, and written with marks in an order in which the middle comes last: ``<P>`` prefix
``<S>`` suffix ``<M>`` middle, or ``<S>`` suffix ``<P>`` prefix ``<M>`` middle. A unit is a run of ``A-Za-z`` or one other character.

Texts are handled as the UTF-8 bytes of Arrow buffers. Only characters of several bytes are recorded, by position and excess
bytes (``Exceptions``); a code point's byte and a byte's code point differ by the excess before them, found by
``searchsorted``. ASCII spans are never looked at one by one for that: there both numbers are the same.

Cuts and forms come from a hash of seed and id alone, so a repeated task, or another partitioning, gives the same rows.

Results by case: null text counts as empty; an empty text, or one with a mark in it, stays plain. A missing id counts as the
empty text in the hash. Repeated rows are transformed each. Rows are independent: no shuffle, and a very long text costs its own
length (its unit starts are counted in blocks and not listed). Extra columns are ignored, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolscope.llm.words import text_slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Of a hundred texts, how many are transformed, and how many of these have the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
BLOCK = 256

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_EXCESS = np.zeros(256, dtype=np.int64)
_EXCESS[0xC0:0xE0], _EXCESS[0xE0:0xF0], _EXCESS[0xF0:] = 1, 2, 3


class Exceptions:
    """Where characters of several bytes are, and how many bytes beyond one each has."""

    def __init__(self, data: np.ndarray):
        self.bytes = np.flatnonzero(data >= 0xC0)
        self.before = np.concatenate([[0], np.cumsum(_EXCESS[data[self.bytes]])])
        self.chars = self.bytes - self.before[:-1]

    def to_chars(self, places: np.ndarray) -> np.ndarray:
        """Code points before each byte place (the start of a character, or the end)."""
        return places - self.before[np.searchsorted(self.bytes, places)]

    def to_bytes(self, places: np.ndarray) -> np.ndarray:
        """Byte places of code points."""
        return places + self.before[np.searchsorted(self.chars, places)]


class Units:
    """Starts of units in the bytes of texts, found by rank through counts of blocks."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        letter = _LETTER[data]
        starts = (data & 0xC0) != 0x80
        starts[1:] &= ~(letter[1:] & letter[:-1])
        starts[offsets[:-1][np.diff(offsets) > 0]] = True
        self.blocks = np.zeros((-(-len(data) // BLOCK) or 1) * BLOCK, dtype=bool)
        self.blocks[: len(data)] = starts
        self.blocks = self.blocks.reshape(-1, BLOCK)
        self.before = np.concatenate([[0], np.cumsum(np.count_nonzero(self.blocks, axis=1))])
        self.first = self.rank(offsets)

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Unit starts before each byte place."""
        block, within = np.divmod(places, BLOCK)
        head = np.minimum(block, len(self.blocks) - 1)
        inside = np.count_nonzero(self.blocks[head] & (np.arange(BLOCK) < within[:, None]), axis=1)
        return self.before[block] + np.where(block == head, inside, 0)

    def select(self, numbers: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Byte places of the units with these numbers; ``end`` for those of the next text."""
        inside = numbers < self.before[-1]
        numbers = np.where(inside, numbers, 0)
        block = np.searchsorted(self.before, numbers, side="right") - 1
        block = np.minimum(block, len(self.blocks) - 1)
        reached = np.cumsum(self.blocks[block], axis=1) > (numbers - self.before[block])[:, None]
        return np.where(inside, np.minimum(block * BLOCK + np.argmax(reached, axis=1), end), end)


def hash_numbers(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits from seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12))


def arrange(text: bytes, first: int, second: int, form: str) -> bytes:
    """The text with its middle from byte ``first`` to ``second`` at the end."""
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if form == "psm":
        return b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    if form == "spm":
        return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return text


def restore(output: bytes, form: str) -> bytes:
    """The text that an output was made of. Parts hold no marks, and no mark can begin in one and end in the next."""
    if form == "plain":
        return output
    second = SUFFIX if form == "psm" else PREFIX
    at = output.index(second, len(PREFIX))
    last = output.index(MIDDLE, at + len(second))
    one, two, middle = output[len(PREFIX) : at], output[at + len(second) : last], output[last + len(MIDDLE) :]
    return one + middle + two if form == "psm" else two + middle + one


def _transformed(seed: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for first, data, offsets in text_slices(batch.column("text")):
                yield from part(ids[first : first + len(offsets) - 1], data, offsets)

    def part(ids: list, data: np.ndarray, offsets: np.ndarray) -> Iterator[pa.RecordBatch]:
        units, odd = Units(data, offsets), Exceptions(data)
        counts, ends = np.diff(units.first), offsets[1:]
        hashes = np.array([hash_numbers(seed, i) for i in ids], dtype=np.int64).reshape(-1, 4)
        cuts = np.sort(hashes[:, :2] % (counts + 1)[:, None], axis=1) + units.first[:-1, None]
        left, right = (units.select(cuts[:, k], ends) for k in (0, 1))
        chars = odd.to_chars(np.concatenate([offsets[:-1], left, right])).reshape(3, -1)
        forms, outputs, digests, restored = [], [], [], []
        for k, (s, e) in enumerate(zip(offsets[:-1].tolist(), ends.tolist())):
            text = data[s:e].tobytes()
            marked = any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE))
            plain = not text or marked or hashes[k, 2] % 100 >= TRANSFORMED
            form = "plain" if plain else "spm" if hashes[k, 3] % 100 < SUFFIX_FIRST else "psm"
            output = arrange(text, int(left[k]) - s, int(right[k]) - s, form)
            forms.append(form)
            digests.append(hashlib.sha256(output).hexdigest())
            restored.append(hashlib.sha256(restore(output, form)).hexdigest())
            if with_text:
                outputs.append(output.decode())
        plain = np.array([f == "plain" for f in forms], dtype=bool)
        columns = {
            "doc_id": pa.array(ids, pa.int64()), "n": pa.array(counts, pa.int64()), "form": pa.array(forms, pa.string()),
            "prefix_chars": pa.array(chars[1] - chars[0], pa.int64(), mask=plain),
            "middle_chars": pa.array(chars[2] - chars[1], pa.int64(), mask=plain),
            "output_sha256": pa.array(digests, pa.string()), "restored_sha256": pa.array(restored, pa.string())}
        yield pa.RecordBatch.from_pydict({**columns, "output": pa.array(outputs, pa.string())} if with_text else columns)

    return run


RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def fill_in_middle(docs: DataFrame, seed: int = 1, with_text: bool = True) -> DataFrame:
    """Every document with its form, cuts, digests and (``with_text``) the transformed text in ``output``."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_transformed(seed, with_text), RESULT + (", output string" if with_text else ""))
