"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, units after numbers, and names (capitalised words inside a sentence) turn into
typed placeholders, other words lose case and punctuation. Windows of ``width`` template words (shorter items: the whole
item) with at least ``literals`` plain words are hash-joined between benchmark and documents, so a question asked
again with other numbers or names still matches. A match counts if its slots are consistent: places with equal
values in the item have equal values in the document, and different ones different values.

The benchmark's window hashes mark a filter of fixed size (``FILTER`` bits), which documents are scanned with; only
windows that pass become rows and are joined, so the join is as small as the overlap, whatever the size of the
benchmark. A document's windows of one item are counted before the join's result is shuffled.

Results by case: null or empty texts, and texts of fewer words than any item's window, match nothing. Items shorter than
``least`` words are left out (they would be found by chance). Items with equal texts each match. Repeated documents match
each; rows that repeat an id, and those without one, count together (a caller that must tell them apart gives a key
of rows as the id). Extra columns are ignored; an empty table on either side gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolscope.llm.common import give_back_memory, stored
from poolscope.llm.words import SLICE_BYTES, _LOWER, mixed, powers, sequence_hashes, text_slices, word_spans

FILTER = 1 << 23
NUMBER, UNIT, NAME = (np.uint64(x) for x in (0x11E0_0000_0000_0001, 0x11E0_0000_0000_0002, 0x11E0_0000_0000_0003))
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb oz ml cl l gal s sec min h hr hour hours minute minutes second seconds day days week weeks"
    " month months year years meter meters metre metres kilometer kilometers kilometre kilometres mile miles foot feet inch inches"
    " gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres percent dollar dollars cent cents euro euros"
    " degree degrees kmh mph hz khz mhz ghz b kb mb gb tb w kw v a"
).split()
_KEPT = np.zeros(256, dtype=bool)
_KEPT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT, _UPPER, _SMALL = (np.zeros(256, dtype=bool) for _ in range(3))
_DIGIT[48:58] = _UPPER[65:91] = _SMALL[97:123] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?:"]] = True
_CLOSE = np.zeros(256, dtype=bool)
_CLOSE[[ord(c) for c in "\"')]"]] = True


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    running = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_LOWER[data] * powers(len(data))[0], out=running[1:])
    down = powers(len(running))[1]
    return mixed((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _known_hashes(words: list[str]) -> np.ndarray:
    text = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return np.sort(_hashes(text, np.concatenate([[0], ends[:-1]]), ends))


_UNIT_HASHES = _known_hashes(UNITS)


def canonical(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template codes and value hashes of all words that have a letter or digit, and where each text's begin."""
    data = data.copy()
    accented = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) if len(data) else np.zeros(0, np.int64)
    upper = _UPPER[data]
    upper[accented] = True
    small = _SMALL[data] | (data >= 0x80)
    small[accented] = False
    small[accented + 1] = False
    data[accented + 1] += 0x20
    starts, ends, first = word_spans(data, offsets)
    kept = np.concatenate([[0], np.cumsum(_KEPT[data])])
    begin, end = kept[starts], kept[ends]
    some = end > begin
    place = np.flatnonzero(_KEPT[data])
    # how many texts' words come before: counted among the words that are kept
    counted = np.concatenate([[0], np.cumsum(some)])[first]
    starts, ends, begin, end = starts[some], ends[some], begin[some], end[some]
    values = _hashes(data[place], begin, end)
    head = place[begin] if len(begin) else np.zeros(0, np.int64)
    number = _DIGIT[data[head]]
    lower_letters = np.concatenate([[0], np.cumsum(small)])
    named = upper[head] & (lower_letters[ends] > lower_letters[starts])
    # a sentence begins with the text, after a line break, or after a word that ends one
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    opens = np.ones(len(starts), dtype=bool)
    if len(starts) > 1:
        last = data[ends[:-1] - 1]
        closed = _CLOSE[last]
        last = np.where(closed & (ends[:-1] - starts[:-1] > 1), data[np.maximum(ends[:-1] - 2, 0)], last)
        opens[1:] = _STOP[last] | (breaks[starts[1:]] > breaks[ends[:-1]])
    opens[counted[:-1][counted[:-1] < len(starts)]] = True
    follows = np.zeros(len(starts), dtype=bool)
    follows[1:] = number[:-1]
    follows[counted[:-1][counted[:-1] < len(starts)]] = False
    unit = follows & np.isin(values, _UNIT_HASHES)
    codes = np.where(number, NUMBER, np.where(unit, UNIT, np.where(named & ~opens, NAME, values)))
    return codes, values, counted


def _pattern(codes: np.ndarray, values: np.ndarray) -> bytes:
    """For each slot, which slot of the window has its value first."""
    slots = np.isin(codes, (NUMBER, UNIT, NAME))
    held = values[slots]
    _, first, back = np.unique(held, return_index=True, return_inverse=True)
    return np.minimum(first[back], 255).astype(np.uint8).tobytes()


def _windows(codes: np.ndarray, counted: np.ndarray, width: int, literals: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first word and text of every window that lies in one text and has enough plain words."""
    hashes = sequence_hashes(codes, width) ^ np.uint64(width)
    if not len(hashes):
        return hashes, np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(counted) - 1), np.diff(counted))
    plain = np.concatenate([[0], np.cumsum(~np.isin(codes, (NUMBER, UNIT, NAME)))])
    at = np.flatnonzero((text[: len(hashes)] == text[width - 1 :]) & (plain[width:] - plain[: len(hashes)] >= literals))
    return hashes[at], at, text[at]


def _windows_of_documents(codes: np.ndarray, values: np.ndarray, counted: np.ndarray, width: int, literals: int):
    """``_windows``, and once more with a name in first place as a plain word.

    A copied passage may begin inside a sentence; its first word then looks like a name. The fourth result tells
    the second reading.
    """
    hashes, at, text = _windows(codes, counted, width, literals)
    # of a window with enough plain words; one more for the word itself
    _, places, texts = _windows(codes, counted, width, literals - 1)
    some = codes[places] == NAME
    places, texts = places[some], texts[some]
    total = np.full(len(places), width, dtype=np.uint64) + values[places] * powers(2)[0][1]
    for k in range(1, width):
        total += codes[places + k] * powers(k + 2)[0][k + 1]
    return (np.concatenate([hashes, mixed(total) ^ np.uint64(width)]), np.concatenate([at, places]), np.concatenate([text, texts]),
            np.concatenate([np.zeros(len(at), bool), np.ones(len(places), bool)]))


ITEM_WINDOWS = "item_id long, hash long, width int, number int, pattern binary, value long"
DOC_WINDOWS = "doc_id long, hash long, at int, pattern binary, value long"


def _of_items(width: int, literals: int, least: int):
    """The windows of items; an item shorter than ``width`` is one window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_slices(batch.column("text")):
                codes, values, counted = canonical(data, offsets)
                out: list[tuple] = []
                for k in range(len(offsets) - 1):
                    own, held = codes[counted[k] : counted[k + 1]], values[counted[k] : counted[k + 1]]
                    size = min(width, len(own))
                    if size < least:
                        continue
                    hashes, at, _ = _windows(own, np.array([0, len(own)]), size, min(literals, -(-size // 2)))
                    for n, (h, a) in enumerate(zip(hashes, at)):
                        w = slice(a, a + size)
                        out.append((batch.column("item_id")[first + k].as_py(), int(h.view(np.int64)), size, n, _pattern(own[w], held[w]),
                                    int(sequence_hashes(held[w], size)[0].view(np.int64))))
                if out:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64()))],
                                          names=["item_id", "hash", "width", "number", "pattern", "value"])

    return run


def _of_documents(widths: list[int], full: int, literals: int, wanted):
    """The windows of documents whose hashes the filter knows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            ids = batch.column("doc_id")
            for first, data, offsets in text_slices(batch.column("text"), SLICE_BYTES // 2):
                codes, values, counted = canonical(data, offsets)
                for width in widths:
                    enough = literals if width == full else min(literals, -(-width // 2))
                    hashes, at, text, plain = _windows_of_documents(codes, values, counted, width, enough)
                    some = bits[(hashes & np.uint64(FILTER - 1)).astype(np.int64)]
                    hashes, at, text, plain = hashes[some], at[some], text[some], plain[some]
                    if not len(hashes):
                        continue
                    spans = [slice(a, a + width) for a in at.tolist()]
                    read = [np.append(values[a : a + 1], codes[a + 1 : a + width]) if first_plain else codes[a : a + width]
                            for a, first_plain in zip(at.tolist(), plain.tolist())]
                    yield pa.record_batch(
                        [ids.take(pa.array(text + first)), pa.array(hashes.view(np.int64)), pa.array((at - counted[text]).astype(np.int32)),
                         pa.array([_pattern(c, values[s]) for c, s in zip(read, spans)], pa.binary()),
                         pa.array([int(sequence_hashes(values[s], width)[0].view(np.int64)) for s in spans], pa.int64())],
                        names=["doc_id", "hash", "at", "pattern", "value"])
        give_back_memory()

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, *, width: int = 13, literals: int = 7, least: int = 8, share: float = 0.0) -> DataFrame:
    """Pairs of documents and benchmark items whose templates overlap.

    ``doc_id``, ``item_id``, ``n_windows`` (different windows of the item found with consistent slots), ``item_windows``,
    ``n_same`` (those whose slots also have the item's values) and the first and last place in the document. ``share``:
    least share of the item's windows.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    windows = stored(items.mapInArrow(_of_items(width, literals, least), ITEM_WINDOWS), "templates-items")
    widths = sorted(row.width for row in windows.select("width").distinct().collect())  # at most ``width``
    bits = np.zeros(FILTER, dtype=bool)
    slots = windows.select(F.col("hash").bitwiseAND(F.lit(FILTER - 1)).cast("int").alias("slot")).distinct()
    bits[np.array(slots.toArrow().column(0), dtype=np.int64)] = True  # at most FILTER rows
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = texts.mapInArrow(_of_documents(widths, width, literals, spark.sparkContext.broadcast(bits)), DOC_WINDOWS)
    sizes = windows.groupBy("item_id").agg(F.count("*").alias("item_windows"))
    asked = windows.withColumnRenamed("pattern", "item_pattern").withColumnRenamed("value", "item_value")
    consistent = found.join(asked, "hash").filter("pattern = item_pattern")
    pairs = consistent.groupBy("doc_id", "item_id").agg(
        F.count_distinct("number").alias("n_windows"),
        F.count_distinct(F.when(F.col("value") == F.col("item_value"), F.col("number"))).alias("n_same"),
        F.min("at").cast("long").alias("first_word"), F.max("at").cast("long").alias("last_word"))
    pairs = pairs.join(sizes, "item_id").filter(F.col("n_windows") >= share * F.col("item_windows"))
    return pairs.select("doc_id", "item_id", "n_windows", "item_windows", "n_same", "first_word", "last_word")
