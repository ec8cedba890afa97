"""Language-model scores of documents by deleted interpolation.

The probability of a token after its predecessor mixes three estimates: the maximum-likelihood bigram and unigram
and a uniform share of ``1 / (V + 1)``. The weights depend on how often the context was seen (one bucket for each power
of two) and are learned by expectation-maximisation on held-out counts: each training token is scored with itself
deleted from all counts (leave one out). What EM needs of the corpus is a histogram over (bucket, bigram estimate,
unigram estimate), estimates in quarter octaves, whose size does not grow with the corpus; the counts do, and stay
distributed (``batches``).

A document is its lower-cased (A-Z) words and one end token; the first word's context is the start.

Results by case: null or empty text is the end token alone. Without training rows all probabilities are 1 and all scores
0. Repeated rows are counted and scored each. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolscope.llm.batches import Batch, answers_of, ask, load_batch, per_batch, write_batches
from poolscope.llm.words import mixed, word_hashes

END, START = np.uint64(0x5E0F5E0F5E0F5E0F), np.uint64(0x57A7257A7257A725)
ODD = np.uint64(1)
BUCKETS, LEVELS = 48, 161  # context buckets; quarter octaves of an estimate down to 2 ** -40, and "zero"


def _tokens(batch: Batch) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all documents, an end after each, and where each document begins (and the last ends)."""
    words, counts = [], []
    for _, data, offsets in batch.slices():
        hashes, first = word_hashes(data, offsets)
        words.append(np.insert(hashes, first[1:], END))
        counts.append(np.diff(first) + 1)
    if not counts:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    return np.concatenate(words), np.concatenate([[0], np.cumsum(np.concatenate(counts))])


@dataclass(frozen=True)
class _Keys:
    """Distinct keys of a batch, and which of them each token's unigram, bigram and context are."""

    keys: np.ndarray
    unigram: np.ndarray
    bigram: np.ndarray
    context: np.ndarray
    begins: np.ndarray
    train: np.ndarray


def _keys(path: str) -> _Keys:
    batch = load_batch(path)
    tokens, begins = _tokens(batch)
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[begins[:-1]] = START
    # odd keys are tokens, even ones bigrams and the start
    own = mixed(tokens) | ODD
    pairs = mixed(mixed(before) * np.uint64(3) + tokens) & ~ODD
    start = mixed(np.array([START])) & ~ODD
    keys, back = np.unique(np.concatenate([own, pairs, start]), return_inverse=True)
    n = len(tokens)
    context = np.empty(n, dtype=np.int64)
    context[1:] = back[: n - 1] if n else 0
    context[begins[:-1]] = back[2 * n]
    train = np.asarray(batch.rows.column("train").combine_chunks().fill_null(False)).astype(bool)
    return _Keys(keys, back[:n], back[n : 2 * n], context, begins, np.repeat(train, np.diff(begins)))


def _question(path: str):
    k = _keys(path)
    counts = np.bincount(k.unigram[k.train], minlength=len(k.keys)) + np.bincount(k.bigram[k.train], minlength=len(k.keys))
    starts = k.begins[:-1]
    if len(starts):
        counts[k.context[starts[0]]] += int(k.train[starts].sum())
    return k.keys, (counts,)


def _counted(keys: np.ndarray, facts: tuple[np.ndarray, ...], batch: np.ndarray):
    """Sums over all batches, one for each asked key; training tokens and distinct ones of the bucket."""
    distinct, back = np.unique(keys, return_inverse=True)
    sums = np.bincount(back, weights=facts[0], minlength=len(distinct)).astype(np.int64)
    of_tokens = sums[distinct & ODD == ODD]
    return sums[back], (int(of_tokens.sum()), int(np.count_nonzero(of_tokens)))


def _level(values: np.ndarray) -> np.ndarray:
    """Quarter octaves below 1; the last level is zero."""
    with np.errstate(divide="ignore"):
        found = np.round(-4 * np.log2(values))
    return np.where(values > 0, np.minimum(found, LEVELS - 2), LEVELS - 1).astype(np.int64)


def context_bucket(counts: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the power of two below its count."""
    return np.where(counts > 0, 1 + np.floor(np.log2(np.maximum(counts, 1))), 0).astype(np.int64)


def learn_weights(cells: np.ndarray, n: np.ndarray, uniform: float, rounds: int = 60) -> np.ndarray:
    """Weights (bigram, unigram, uniform) of each context bucket, by EM over the held-out histogram."""
    bucket, rest = np.divmod(cells, LEVELS * LEVELS)
    two, one = np.divmod(rest, LEVELS)
    value = np.append(2.0 ** (-np.arange(LEVELS - 1) / 4), 0.0)
    parts = np.stack([value[two], value[one], np.full(len(cells), uniform)], axis=1)
    weights = np.tile([0.4, 0.5, 0.1], (BUCKETS, 1))
    for _ in range(rounds):
        share = weights[bucket] * parts
        share *= (n / np.maximum(share.sum(axis=1), 1e-300))[:, None]
        sums = np.stack([np.bincount(bucket, share[:, k], BUCKETS) for k in range(3)], axis=1)
        seen = sums.sum(axis=1) > 0
        # a little of every part stays, so that no token has probability 0
        weights[seen] = (sums[seen] + 1e-3) / (sums[seen] + 1e-3).sum(axis=1, keepdims=True)
    return weights


def _histogram(tokens: int):
    def use(path: str, rows: pa.Table) -> pa.Table:
        k, counts = _keys(path), answers_of(rows, np.int64)
        t = k.train
        context, two, one = counts[k.context[t]] - 1, counts[k.bigram[t]] - 1, counts[k.unigram[t]] - 1
        cells = (context_bucket(context) * LEVELS + _level(two / np.maximum(context, 1))) * LEVELS + _level(one / max(tokens - 1, 1))
        found, n = np.unique(cells, return_counts=True)
        return pa.table({"cell": pa.array(found), "n": pa.array(n)})

    return use


def _scores(tokens: int, types: int, weights: np.ndarray):
    def use(path: str, rows: pa.Table) -> pa.Table:
        k, counts = _keys(path), answers_of(rows, np.int64)
        batch = load_batch(path)
        context, two, one = counts[k.context], counts[k.bigram], counts[k.unigram]
        w = weights[context_bucket(context)]
        p = w[:, 0] * two / np.maximum(context, 1) + w[:, 1] * one / max(tokens, 1) + w[:, 2] / (types + 1)
        base = np.log10((one + 1) / (tokens + types + 1))
        begins = k.begins[:-1]
        total = lambda v: np.add.reduceat(v, begins) if len(begins) else np.zeros(0)
        return pa.table({
            "doc_id": batch.rows.column("doc_id"), "train": batch.rows.column("train"), "n_tokens": pa.array(np.diff(k.begins)),
            "n_known": pa.array(total((one > 0).astype(np.int64)).astype(np.int64)), "train_tokens": pa.array(np.full(len(begins), tokens)),
            "base_score": pa.array(total(base)), "score": pa.array(total(np.log10(p)) if tokens else np.zeros(len(begins)))})

    return use


def score_documents(docs: DataFrame) -> DataFrame:
    """Scores of all ``docs`` (``doc_id``, ``text``, ``train``: whether the model learns from the row)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.coalesce("train", F.lit(False)).alias("train"))
    batches = write_batches(rows, "interpolation")
    schema = "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    answers = ask(batches, _question, (np.int64,), _counted, "interpolation-counts")

    size = answers.agg(F.sum("total_a").alias("tokens"), F.sum("total_b").alias("types")).first()
    tokens, types = size.tokens or 0, size.types or 0
    cells = per_batch(answers, _histogram(tokens), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    weights = learn_weights(np.array([c.cell for c in cells], dtype=np.int64), np.array([c.n for c in cells], dtype=float), 1 / (types + 1))
    return per_batch(answers, _scores(tokens, types, weights), schema)
