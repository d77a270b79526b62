"""Toxicity from subword bags: character n-grams are embedded, averaged, and judged by a linear softmax.

Embeddings and softmax are trained together. Toxic passages are short, so a text is read in windows of words,
each window is a bag of its own, and a text is as toxic as its worst window; while training, a document's
gradient goes to that window. Words that were never seen share most of their n-grams with seen ones.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZES = (3, 4, 5, 6)
BUCKETS = 1 << 18
WINDOW = 50
#: N-grams that a window's average is taken over at least, so that a few words don't make a whole window.
LEAST_GRAMS = 300
DIMENSIONS = 8
EPOCHS = 6
STEP = 0.5
#: Labelled documents that the model is fitted on, at most: of either label.
SAMPLE = {1: 2000, 0: 4000}
#: N-grams that training keeps in memory, four bytes each.
KEPT_GRAMS = 60_000_000
THRESHOLD = 0.3
HELD_OUT = 2


def held_out(doc_id: F.Column) -> F.Column:
    """Rows whose labels are never learned from."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == HELD_OUT


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Buckets of the n-grams of a text's words with their borders, the window of each, and the count of windows.

    A word counts once in a window, however often it is repeated there.
    """
    every = (text or "").lower().encode("utf-8", "surrogatepass").split()
    if not every:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    windows = [dict.fromkeys(every[i : i + WINDOW]) for i in range(0, len(every), WINDOW)]
    words = [x for own in windows for x in own]
    count = len(windows)
    window_of = np.repeat(np.arange(count), [len(x) for x in windows])
    flat = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8)
    space = flat == 32
    word = np.cumsum(space) - 1
    n = len(flat)
    # the next border at or after each position
    border = np.where(space, np.arange(n), n)
    border = np.minimum.accumulate(border[::-1])[::-1]
    code = flat.astype(np.uint32)
    out, where = [], []
    with np.errstate(over="ignore"):
        hashed = code.copy()
        for size in range(2, max(SIZES) + 1):
            if n < size:
                break
            hashed = hashed[: n - size + 1] * np.uint32(0x01000193) + code[size - 1 :]
            if size in SIZES:
                at = np.flatnonzero(border[1 : n - size + 2] >= np.arange(size - 1, n))
                mixed = (hashed[at] ^ (hashed[at] >> np.uint32(15))) * np.uint32(0x85EBCA6B)
                out.append((mixed >> np.uint32(14)).astype(np.int64))
                where.append(window_of[np.minimum(word[at], len(words) - 1)])
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), count
    return np.concatenate(out), np.concatenate(where), count


def by_window(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's n-grams, window after window, and where each window ends (the first entry is 0)."""
    ids, window, count = grams(text)
    order = np.argsort(window, kind="stable")
    return ids[order].astype(np.int32), np.concatenate([[0], np.cumsum(np.bincount(window, minlength=count))])


class Model:
    """What scoring needs: how much each n-gram speaks for the toxic class, and the bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def score(self, text: str | None) -> float:
        ids, window, count = grams(text)
        if not count:
            return float(_sigmoid(np.array(self.bias)))
        total = np.bincount(window, weights=self.weights[ids], minlength=count)
        mean = total / np.maximum(LEAST_GRAMS, np.bincount(window, minlength=count))
        return float(_sigmoid(mean.max() + self.bias))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def train(texts: list[str | None], labels: list[int]) -> Model:
    """Fit by adaptive gradient steps over documents in a fixed random order; one class alone gives a flat score.

    The first ``KEPT_GRAMS`` n-grams stay in memory over the epochs; those of further documents are built anew
    in each, so that memory is bounded and the model is the same either way.
    """
    random = np.random.default_rng(7)
    rate = (sum(labels) + 1) / (len(labels) + 2)
    vectors = random.normal(0, 0.05, (BUCKETS, DIMENSIONS)).astype(np.float32)
    softmax = random.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.array([0.0, np.log(rate / (1 - rate))], dtype=np.float32)
    seen = np.full(BUCKETS, 1e-6, dtype=np.float32)
    seen_softmax, seen_bias = np.full_like(softmax, 1e-6), np.full_like(bias, 1e-6)
    if len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS, np.float32), float(bias[1]))
    kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    room = KEPT_GRAMS
    for _ in range(EPOCHS):
        for k in random.permutation(len(labels)):
            ids, ends = kept.get(k) or by_window(texts[k])
            if k not in kept and len(ids) <= room:
                kept[k] = ids, ends
                room -= len(ids)
            if not len(ids):
                continue
            toxic_way = vectors.take(ids, axis=0) @ (softmax[:, 1] - softmax[:, 0])
            starts = ends[:-1]
            # a window without n-grams has nothing to sum
            filled = np.flatnonzero(ends[1:] > starts)
            means = np.zeros(len(starts))
            means[filled] = np.add.reduceat(toxic_way, starts[filled])
            worst = int((means / np.maximum(LEAST_GRAMS, np.diff(ends))).argmax())
            own, times = np.unique(ids[ends[worst] : ends[worst + 1]], return_counts=True)
            share = (times / max(LEAST_GRAMS, times.sum())).astype(np.float32)
            mean = share @ vectors.take(own, axis=0)
            logits = mean @ softmax + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[k]] -= 1
            gradient = p.astype(np.float32)
            step = share[:, None] * (softmax @ gradient)[None, :]
            seen[own] += (step * step).mean(axis=1)
            seen_softmax += np.outer(mean, gradient) ** 2
            seen_bias += gradient**2
            vectors[own] -= STEP * step / np.sqrt(seen[own])[:, None]
            softmax -= 0.1 * np.outer(mean, gradient) / np.sqrt(seen_softmax)
            bias -= 0.1 * gradient / np.sqrt(seen_bias)
    return Model(vectors @ (softmax[:, 1] - softmax[:, 0]), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from a bounded sample of ``docs`` (``doc_id``, ``text``) that ``labels`` (``doc_id``, ``toxic``) mark.

    Held-out rows, null ids and labels other than 0 and 1 teach nothing. The sample is ``SAMPLE`` documents of
    each label in the order of a hash; whole texts of these, and nothing else, reach the driver. Of texts that share
    a ``doc_id`` the one with the smallest hash teaches, so the model does not depend on the order of rows.
    """
    known = labels.where((F.col("toxic").isin(0, 1)) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    picked = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id")).limit(n) for k, n in SAMPLE.items()]
    picked = picked[0].union(picked[1])
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(picked), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("toxic").alias("toxic"))
    rows = sorted(texts.collect(), key=lambda r: zlib.crc32(str(r["doc_id"]).encode()))
    return train([r["text"] for r in rows], [r["toxic"] for r in rows])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs``.

    A null text is empty; a text without words scores the bias. Null ids stay null and repeated rows count
    each; more columns are ignored.
    """

    def judged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "score": np.array([model.score(x) for x in frame["text"]], dtype=np.float64)})

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(judged, "doc_id long, score double")
    return rows.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labels and score every row of ``docs``; see :func:`fit` and :func:`scored`."""
    return scored(docs, fit(docs, labels))
