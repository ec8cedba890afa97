"""Phrase collocations from counts of the longest windows alone, marginalised by Spark's ROLLUP.

A phrase is up to ``longest`` words in a row inside a piece of text (pieces end at ``.,;:!?`` and line ends), lower-cased (A-Z). Each
word opens one window: itself and the words that follow as lead columns, padded at the end of its piece. ROLLUP over (language, word 1,
word 2, ...) sums the windows' counts to those of all shorter prefixes, and as every phrase opens a window, these are the counts of
all phrases; nothing is exploded once for each length.

Windows are counted per batch of documents before they are shuffled. Most long windows occur a few times in all, and would be a shuffle row
each. So batches first ask (``batches``) which word pairs occur ``least`` times, by hash: a window is padded from its
first pair below that, which no candidate or part of one can have (a phrase is at most as frequent as each of its pairs). A hash that two
pairs share only leaves more in. Counts themselves are of words, never of hashes.

A candidate's score is the lowest of its cuts into two parts, ``floor(1000000 * a * a / (l * r))``, in decimals of 38 digits. Candidates
inside a longer one with at least ``share`` percent of their count go. Ranks are made in two steps, so that a language is no single task.
Look-ups of parts join by phrase; a frequent word's many rows are split by adaptive skew joins.

Results by case: null language is ``und``, with those of that name; null or empty text has no words. A very long text is a batch of its
own. Repeated rows count each. An empty table, or none frequent enough, gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from poolscope.llm.batches import Batch, answers_of, ask, load_batch, per_batch, write_batches
from poolscope.llm.common import give_back_memory, stored
from poolscope.llm.words import mixed, prefix_hashes, span_hashes

UNKNOWN = "und"
BATCH_BYTES = 4_000_000
#: Rows of counted windows that a task hands over at once.
ROWS_AT_ONCE = 50_000
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_OUTSIDE = _BREAK.copy()
_OUTSIDE[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Words:
    """A batch's words as numbers of its own dictionary, whether each is followed by the next one, and its language's number."""

    def __init__(self, batch: Batch):
        parts, counts, follows = [], [], []
        for _, data, offsets in batch.slices():
            data = _LOWER[data]
            inside = np.zeros(len(data) + 2, dtype=bool)
            inside[1:-1] = ~_OUTSIDE[data]
            fresh = np.zeros(len(data) + 1, dtype=bool)
            fresh[offsets] = True
            starts = np.flatnonzero(inside[1:] & (~inside[:-1] | fresh))
            ends = np.flatnonzero(inside[:-1] & (~inside[1:] | fresh))
            # a piece ends at a break and with the text
            piece = np.concatenate([[0], np.cumsum(_BREAK[data])])[starts]
            row = np.searchsorted(offsets, starts, side="right")
            follow = np.zeros(len(starts), dtype=bool)
            follow[:-1] = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])
            follows.append(follow)
            counts.append(np.diff(np.searchsorted(starts, offsets)))
            places = np.concatenate([[0], np.cumsum(ends - starts)])
            parts.append(pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(data[inside[1:-1]])))
        coded = pa.chunked_array(parts, pa.large_string()).combine_chunks().dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        self.names = coded.dictionary
        self.word = coded.indices.to_numpy()
        self.follow = np.concatenate(follows or [np.zeros(0, bool)])
        langs = batch.rows.column("lang").combine_chunks().dictionary_encode()
        self.langs = langs.dictionary
        per_row = np.concatenate(counts or [np.zeros(0, np.int64)])
        self.lang = np.repeat(langs.indices.to_numpy(), per_row) if len(langs) else np.zeros(0, np.int32)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the batch's word pairs in order, how often each occurs, and the pair that each joined word opens."""
        at = np.flatnonzero(self.follow)
        word, lang = _hashes(self.names), _hashes(self.langs)
        second = mixed(word[self.word[at]] * np.uint64(3) + word[self.word[at + 1]]) if len(at) else np.zeros(0, np.uint64)
        keys, back, counts = np.unique(
            mixed(second + lang[self.lang[at]]) if len(at) else second, return_inverse=True, return_counts=True)
        return keys, counts, back


def _hashes(names: pa.Array) -> np.ndarray:
    names = names.cast(pa.large_string())
    if not len(names):
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(names.buffers()[1], np.int64)[names.offset : names.offset + len(names) + 1]
    buffer = names.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[: offsets[-1]] if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    return mixed(span_hashes(prefix_hashes(data, lower=False), offsets[:-1], offsets[1:]))


def _ask_pairs(path: str):
    keys, counts, _ = _Words(load_batch(path)).pairs()
    give_back_memory()
    return keys, (counts,)


def _judge_pairs(least: int):
    def judge(keys: np.ndarray, facts: tuple[np.ndarray, ...], batch: np.ndarray):
        distinct, back = np.unique(keys, return_inverse=True)
        often = np.bincount(back, facts[0], len(distinct)) >= least
        return often[back].astype(np.uint8), (int(often.sum()), 0)

    return judge


def _numbered(codes: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of (code, further number) as one code from 0 on: the first place of each, every row's code, and counts."""
    both = codes.astype(np.int64) * (int(more.max(initial=0)) + 1) + more
    _, first, back, counts = np.unique(both, return_index=True, return_inverse=True, return_counts=True)
    return first, back.astype(np.int32), counts


def _windows(longest: int):
    names = [f"w{k + 1}" for k in range(longest)]

    def use(path: str, rows: pa.Table) -> pa.Table:
        words = _Words(load_batch(path))
        _, _, pair = words.pairs()
        go_on = words.follow.copy()
        go_on[words.follow] = answers_of(rows, np.uint8)[pair].astype(bool)
        n = len(words.word)
        codes, first, counts = words.lang, np.zeros(0, np.int64), np.zeros(0, np.int64)
        columns = []
        reach = np.ones(n, dtype=bool)
        for k in range(longest):
            column = np.zeros(n, dtype=np.int32)  # 0 is the padding
            column[: n - k] = np.where(reach[: n - k], words.word[k:] + 1, 0)
            columns.append(column)
            first, codes, counts = _numbered(codes, column)
            reach[: n - k] &= go_on[k:]
            reach[n - k :] = False
        texts = pa.concat_arrays([pa.array([""], pa.large_string()), words.names])

        def part(some: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch({
                "lang": words.langs.take(pa.array(words.lang[some])),
                **{name: texts.take(pa.array(c[some])).cast(pa.string()) for name, c in zip(names, columns)},
                "n": pa.array(n, pa.int64())})

        del codes, pair, reach, go_on
        give_back_memory()
        starts = range(0, max(1, len(first)), ROWS_AT_ONCE)
        return pa.Table.from_batches([part(first[k : k + ROWS_AT_ONCE], counts[k : k + ROWS_AT_ONCE]) for k in starts])

    return use


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 10) -> DataFrame:
    """Phrases of up to ``longest`` words that occur ``least`` times in their language: ``lang``, ``phrase``, ``size``, ``f``.

    Phrases of size 0 are the languages' own counts of words.
    """
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string"))
    batches = write_batches(rows, "phrases", BATCH_BYTES)
    often = ask(batches, _ask_pairs, (np.int32,), _judge_pairs(least), "phrases-pairs")
    names = [f"w{k + 1}" for k in range(longest)]
    windows = per_batch(often, _windows(longest), "lang string, " + ", ".join(f"{w} string" for w in names) + ", n long")
    sums = docs.sparkSession.sql(
        f"SELECT lang, {', '.join(names)}, sum(n) AS f, grouping_id() AS level FROM {{windows}} GROUP BY lang, ROLLUP ({', '.join(names)})",
        windows=windows)
    sums = sums.filter((F.col("f") >= least) | (F.col("level") == 2**longest - 1))
    # a row of a level is a phrase if its last word is no padding
    size = longest - F.bit_count("level").cast("int")
    phrase = F.concat_ws(" ", *names)
    full = F.array_position(F.array(*[F.coalesce(w, F.lit("-")) for w in names]), "") == 0
    return stored(sums.filter(full).select("lang", phrase.alias("phrase"), size.alias("size"), "f"), "phrases-counts")


def mine_phrases(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of every language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    return ranked(phrase_counts(docs, longest, least), share, top)


def ranked(counts: DataFrame, share: int, top: int) -> DataFrame:
    """``mine_phrases`` from counts of phrases as ``phrase_counts`` makes them."""
    candidates = counts.filter("size >= 2").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    part = counts.filter("size >= 1").select("lang", "phrase", "f")

    cuts = candidates.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ").alias("right"))
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    exact = "CAST({} AS DECIMAL(18, 0))"
    product = f"CAST(1000000 * ({exact.format('a')} * {exact.format('a')}) AS DECIMAL(38, 0)) div ({exact.format('l')} * {exact.format('r')})"
    scored = cuts.withColumn("score", F.expr(product))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))

    sizes = F.sequence(F.lit(2), F.col("size") - 1)
    inside = F.flatten(F.transform(sizes, lambda n: F.transform(
        F.sequence(F.lit(1), F.col("size") - n + 1), lambda s: F.array_join(F.slice("words", s, n), " "))))
    longer = candidates.filter("size > 2").select("lang", F.explode(inside).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").filter(f"longer IS NULL OR 100 * longer < {share} * cut.a")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = kept.select("lang", "phrase", "cut.score", "cut.a", "cut.l", "cut.r", F.pmod(F.xxhash64("phrase"), F.lit(64)).alias("part"))
    some = Window.partitionBy("lang", "part").orderBy(*order)
    first = kept.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= top).drop("rank", "part")
    best = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    totals = counts.filter("size = 0").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
