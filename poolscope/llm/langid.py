"""Language of texts by a small byte convolutional network.

Method: filters of several byte widths slide over fixed-length windows, each filter's largest response in a window
goes through a softmax layer. A filter is a table of one weight per place and byte value, so a response is a sum of
looked-up rows and needs no one-hot input. The network is trained in numpy on the driver, on a bounded sample of
labelled rows (``Sample`` states the bound); all whole texts are then cut into windows, batched over many texts,
and scored in tasks. A text's score for a language is the mean over its windows.

Results by case: a null text, or one without a letter, is ``und`` with score 0; so is every text where nothing could
be learned (no labelled rows). Rows without a label are not learned from. Ties go to the alphabetically first
language. Repeated rows and rows without an id are scored like any other; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from poolscope.llm.common import give_back_memory
from poolscope.llm.words import text_slices

WINDOW = 256
UNKNOWN = "und"


@dataclass(frozen=True)
class Sample:
    """Bound of the training data: at most ``texts`` different texts of each language, ``windows`` windows of each text."""

    texts: int = 600
    windows: int = 4


@dataclass(frozen=True)
class ByteNet:
    """A trained network. ``filters[k]`` has the shape (width, 256, filters)."""

    languages: tuple[str, ...]
    filters: tuple[np.ndarray, ...]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def _pair_tables(self) -> list[list[np.ndarray]]:
        """Tables for two neighbouring bytes at once, and one for the last byte of an odd width."""
        tables = []
        for weights in self.filters:
            pairs = [(weights[k][:, None, :] + weights[k + 1][None, :, :]).reshape(65536, -1) for k in range(0, len(weights) - 1, 2)]
            tables.append(pairs + ([weights[-1]] if len(weights) % 2 else []))
        return tables

    def scorer(self):
        """A function from windows (rows of bytes) to probabilities."""
        tables = self._pair_tables()

        def score(windows: np.ndarray) -> np.ndarray:
            pairs = windows[:, :-1].astype(np.int32) * 256 + windows[:, 1:]
            pooled = []
            for weights, parts in zip(self.filters, tables):
                n = windows.shape[1] - len(weights) + 1
                total = None
                for k, part in enumerate(parts):
                    source = pairs if len(part) == 65536 else windows
                    rows = part[source[:, 2 * k : 2 * k + n]]
                    total = rows if total is None else np.add(total, rows, out=total)
                pooled.append(total.max(axis=1))
            return softmax(np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0) @ self.dense + self.dense_bias)

        return score


def softmax(values: np.ndarray) -> np.ndarray:
    values = np.exp(values - values.max(axis=1, keepdims=True))
    return values / values.sum(axis=1, keepdims=True)


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts (rows of bytes), and each text's first window; short texts end in zeros.

    A text's last window ends with it, so every byte is in a full window if the text has one.
    """
    lengths = np.diff(offsets)
    counts = np.maximum(1, -(-lengths // WINDOW))
    first = np.concatenate([[0], np.cumsum(counts)])
    of = np.repeat(np.arange(len(lengths)), counts)
    start = offsets[of] + np.minimum((np.arange(first[-1]) - first[of]) * WINDOW, np.maximum(0, lengths[of] - WINDOW))
    places = start[:, None] + np.arange(WINDOW)
    inside = places < offsets[of + 1][:, None]
    padded = np.append(data, np.uint8(0))
    return np.where(inside, padded[np.minimum(places, len(data))], np.uint8(0)), first


def train(windows: np.ndarray, labels: np.ndarray, languages: tuple[str, ...], *, widths=(2, 3, 4), filters: int = 16,
          epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 7) -> ByteNet:
    """Fit the network with Adam on the cross entropy of single windows."""
    rng = np.random.default_rng(seed)
    weights = [rng.normal(0, 0.3, (w, 256, filters)).astype(np.float32) for w in widths]
    params = [*weights, np.zeros(filters * len(widths), np.float32),
              rng.normal(0, 0.2, (filters * len(widths), len(languages))).astype(np.float32), np.zeros(len(languages), np.float32)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for begin in range(0, len(order), batch):
            some = order[begin : begin + batch]
            x, y = windows[some], labels[some]
            pooled, places = [], []
            for w in weights:
                n = x.shape[1] - len(w) + 1
                total = w[0][x[:, :n]]
                for k in range(1, len(w)):
                    total += w[k][x[:, k : k + n]]
                at = total.argmax(axis=1)
                places.append(at)
                pooled.append(np.take_along_axis(total, at[:, None, :], axis=1)[:, 0])
            raw = np.concatenate(pooled, axis=1) + params[-3]
            hidden = np.maximum(raw, 0)
            slope = softmax(hidden @ params[-2] + params[-1])
            slope[np.arange(len(some)), y] -= 1
            slope /= len(some)
            back = (slope @ params[-2].T) * (raw > 0)
            grads = []
            for j, w in enumerate(weights):
                grad = np.zeros_like(w)
                part = back[:, j * filters : (j + 1) * filters]
                for k in range(len(w)):
                    np.add.at(grad[k], (np.take_along_axis(x, places[j] + k, axis=1), np.arange(filters)[None, :]), part)
                grads.append(grad)
            grads += [back.sum(axis=0), hidden.T @ slope, slope.sum(axis=0)]
            step += 1
            for p, g, (m, v) in zip(params, grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return ByteNet(languages, tuple(weights), params[-3], params[-2], params[-1])


def _training_windows(count: int):
    """A few windows of each text, spread over all of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_slices(batch.column("text")):
                windows, begin = cut_windows(data, offsets)
                chosen = []
                for s, e in zip(begin[:-1].tolist(), begin[1:].tolist()):
                    chosen.append(windows[np.unique(np.linspace(s, e - 1, count).astype(int))].tobytes())
                yield pa.record_batch([batch.column("lang").slice(first, len(chosen)), pa.array(chosen, pa.binary())],
                                      names=["lang", "windows"])

    return run


def fit(labelled: DataFrame, sample: Sample = Sample()) -> ByteNet | None:
    """Train on a bounded sample of ``text`` and ``lang``; None if there is nothing to learn from."""
    usable = labelled.select(F.col("text").cast("string"), F.col("lang").cast("string")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # copies of a text count once; of each language the texts with the smallest keys, however many there are
    different = usable.select("lang", F.xxhash64("text").alias("key")).distinct()
    smallest = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    chosen = different.withColumn("place", smallest).filter(F.col("place") <= sample.texts).select("lang", "key")
    keyed = usable.withColumn("key", F.xxhash64("text"))
    drawn = keyed.join(F.broadcast(chosen), ["lang", "key"], "left_semi")  # at most the sample's size for each language
    # copies become one row in the tasks, so no more than the sample is collected
    rows = drawn.mapInArrow(_training_windows(sample.windows), "lang string, windows binary").distinct().collect()
    rows = sorted((row.lang, bytes(row.windows)) for row in rows)
    languages = tuple(sorted({lang for lang, _ in rows}))
    if not languages:
        return None
    windows = np.concatenate([np.frombuffer(w, np.uint8).reshape(-1, WINDOW) for _, w in rows])
    labels = np.concatenate([np.full(len(w) // WINDOW, languages.index(lang)) for lang, w in rows])
    return train(windows, labels, languages)


def _predicted(net: ByteNet, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = net.scorer()
        for batch in batches:
            for first, data, offsets in text_slices(batch.column("text"), 250_000):
                windows, begin = cut_windows(data, offsets)
                parts = [score(windows[k : k + 64]) for k in range(0, len(windows), 64)]
                mean = np.add.reduceat(np.concatenate(parts), begin[:-1]) / np.diff(begin)[:, None]
                best = mean.argmax(axis=1)
                part = batch.slice(first, len(best))
                part = part if keep_text else part.drop_columns(["text"])
                found = [pa.array([net.languages[k] for k in best], pa.string()),
                         pa.array(np.clip(mean[np.arange(len(best)), best], 0, 1).astype(np.float64))]
                yield pa.record_batch([*part.columns, *found], names=[*part.schema.names, "lang_pred", "score"])
        give_back_memory()

    return run


def predict(docs: DataFrame, net: ByteNet | None, keep_text: bool = False) -> DataFrame:
    """``docs`` (without ``text`` unless ``keep_text``) with ``lang_pred`` and ``score``; columns of these names are replaced."""
    rows = docs.drop("lang_pred", "score").withColumn("text", F.col("text").cast("string"))
    if net is None:
        rest = rows if keep_text else rows.drop("text")
        return rest.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    rows = rows.withColumn("_lettered", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    fields = (rows if keep_text else rows.drop("text")).schema.fields
    schema = StructType(list(fields)).add("lang_pred", "string").add("score", "double")
    scored = rows.mapInArrow(_predicted(net, keep_text), schema)
    return scored.withColumns({
        "lang_pred": F.when(F.col("_lettered"), F.col("lang_pred")).otherwise(UNKNOWN),
        "score": F.when(F.col("_lettered"), F.col("score")).otherwise(0.0),
    }).drop("_lettered")
