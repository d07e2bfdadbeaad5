"""Toxicity from bags of subwords: averaged embeddings under a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import samples
from .shared import bounded_batches, slices, text_of

SLICE_BYTES = 4 << 20
THRESHOLD = 0.3
BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
WIDTH = 8
GRAMS = (3, 4, 5)
#: Words whose vectors are averaged together; a text counts by its most toxic window.
WINDOW = 3
SAMPLE_ROWS = 6000
SAMPLE_BYTES = 16 << 20
#: Words remembered per Python worker.
REMEMBERED = 500_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _STEP
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of ``<word>`` and of the word itself; counts per word."""
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    length = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    start = np.cumsum(length) - length
    word = np.repeat(np.arange(len(words)), length)
    place = np.arange(len(codes)) - start[word]
    codes = codes.astype(np.uint64) + np.uint64(1)
    found, owner = [], []
    for n in GRAMS:
        at = np.flatnonzero(place + n <= length[word])
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = (h + codes[at + k]) * _STEP
        found.append(_bucket(h))
        owner.append(word[at])
    # the whole word: a polynomial in its characters
    power = np.cumprod(np.full(int(length.max(initial=1)), _STEP, np.uint64))
    if len(words):
        found.append(_bucket(np.add.reduceat(codes * power[place], start)))
        owner.append(np.arange(len(words)))
    found, owner = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return found[order], np.bincount(owner, minlength=len(words))


def _means(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Means of consecutive runs of rows; every count is at least 1."""
    if not len(counts):
        return np.zeros((0, *values.shape[1:]))
    sums = np.add.reduceat(values, np.cumsum(counts) - counts, axis=0)
    return sums / counts.reshape(-1, *[1] * (values.ndim - 1))


def best_windows(logits: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text the highest mean over windows of its words' logits, with the window's ends.

    A text with fewer words than a window is one window; without words the mean is 0.
    """
    stops = np.cumsum(lengths)
    starts = stops - lengths
    sums = np.concatenate(([0.0], np.cumsum(logits)))
    reach = np.minimum(lengths, WINDOW)
    best = np.zeros(len(lengths))
    first = starts.copy()
    if len(logits):
        text = np.repeat(np.arange(len(lengths)), lengths)
        at = np.arange(len(logits))
        stop = np.minimum(at + WINDOW, stops[text])
        mean = (sums[stop] - sums[at]) / np.maximum(stop - at, 1)
        mean[at + reach[text] > stops[text]] = -np.inf  # shorter windows at a text's end
        full = lengths > 0
        best[full] = np.maximum.reduceat(mean, starts[full])
        hit = np.flatnonzero(mean == best[text])
        first[text[hit[::-1]]] = hit[::-1]
    return best, first, first + reach


@dataclass
class Subwords:
    """Embeddings, softmax weights for (clean, toxic) and their bias."""

    embeddings: np.ndarray
    softmax: np.ndarray
    bias: np.ndarray

    def word_logits(self, words: list[str]) -> np.ndarray:
        """Each word's own log-odds: the averaged vector times the difference of the two classes."""
        grams, counts = subwords(words)
        line = self.embeddings @ (self.softmax[:, 1] - self.softmax[:, 0])
        return _means(line[grams], counts)

    def scores(self, texts: list[str], known: dict[str, float]) -> np.ndarray:
        """Toxicity of each whole text; ``known`` remembers words."""
        cut = [t.lower().split() for t in texts]
        if len(known) > REMEMBERED:
            known.clear()
        new = list(set().union(*cut).difference(known))
        for at in range(0, len(new), 1 << 15):
            part = new[at:at + (1 << 15)]
            known.update(zip(part, self.word_logits(part).tolist(), strict=True))
        lengths = np.array([len(c) for c in cut], np.int64)
        logits = np.fromiter((known[w] for c in cut for w in c), float, int(lengths.sum()))
        best = best_windows(logits, lengths)[0] + self.bias[1] - self.bias[0]
        return 1 / (1 + np.exp(-best))


class _Adagrad:
    def __init__(self, value: np.ndarray, rate: float):
        self.value, self.rate, self.seen = value, rate, np.full_like(value, 1e-8)

    def step(self, slope: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        self.seen[rows] += slope**2
        self.value[rows] -= self.rate * slope / np.sqrt(self.seen[rows])


def _learn(model: Subwords, tools: tuple, grams: np.ndarray, counts: np.ndarray, bags: np.ndarray,
           weight: np.ndarray, toxic: np.ndarray) -> None:
    """One joint step on bags of words: ``bags`` gives each word's bag, ``toxic`` the share of 1."""
    word = np.repeat(np.arange(len(counts)), counts)
    vectors = _means(model.embeddings[grams], counts)
    n_words = np.bincount(bags, minlength=len(weight))
    mean = np.column_stack([np.bincount(bags, v, len(weight)) for v in vectors.T]) / n_words[:, None]
    logits = mean @ model.softmax + model.bias
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    wrong = (p - np.column_stack([1 - toxic, toxic])) * (weight / weight.sum())[:, None]
    back = (wrong @ model.softmax.T / n_words[:, None])[bags] / counts[:, None]
    rows, place = np.unique(grams, return_inverse=True)
    slope = np.column_stack([np.bincount(place, b[word], len(rows)) for b in back.T])
    tools[1].step(mean.T @ wrong)
    tools[2].step(wrong.sum(axis=0))
    tools[0].step(slope, rows)


def fit(examples: list[tuple[str, int]], seed: int = 3, passes: int = 1, rounds: int = 40) -> Subwords:
    """Embeddings and softmax trained together on whole texts with labels (1: toxic).

    First every distinct word of a text is a bag with the text's label; then the bag of a text is
    the window that the model so far finds most toxic, which sharpens what tells texts apart. No
    examples give a score of 0.5, examples of one label that label's share.
    """
    rng = np.random.default_rng(seed)
    model = Subwords(
        rng.normal(0, 0.1, (BUCKETS, WIDTH)), rng.normal(0, 0.3, (WIDTH, 2)), np.zeros(2))
    labels = np.array([y for _, y in examples], float)
    if len(examples) == 0 or labels.min() == labels.max():
        share = 0.5 if len(examples) == 0 else 0.01 + 0.98 * labels.mean()
        return Subwords(model.embeddings * 0, model.softmax, np.array([0, np.log(share / (1 - share))]))
    names: dict[str, int] = {}
    numbers = [
        np.array([names.setdefault(w, len(names)) for w in t.lower().split()], np.int32) for t, _ in examples]
    lengths = np.array([len(x) for x in numbers], np.int64)
    flat, words = np.concatenate(numbers).astype(np.int64), list(names)
    del names, numbers
    parts = [subwords(words[i:i + (1 << 14)]) for i in range(0, len(words), 1 << 14)]
    grams = np.concatenate([g.astype(np.int32) for g, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    del parts
    starts = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(lengths)), lengths)
    pairs = np.unique(text * len(words) + flat)
    n = np.bincount(pairs % len(words), minlength=len(words)).astype(float)
    toxic = np.bincount(pairs % len(words), labels[pairs // len(words)], len(words))

    tools = (_Adagrad(model.embeddings, 0.5), _Adagrad(model.softmax, 0.1), _Adagrad(model.bias, 0.1))

    def gather(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        c = counts[chosen]
        at = np.repeat(starts[chosen] - (np.cumsum(c) - c), c) + np.arange(c.sum())
        return grams[at], c

    for _ in range(passes):
        order = rng.permutation(len(words))
        for at in range(0, len(order), 8192):
            chosen = order[at:at + 8192]
            _learn(model, tools, *gather(chosen), np.arange(len(chosen)), n[chosen], toxic[chosen] / n[chosen])
    for _ in range(rounds):
        line = model.embeddings @ (model.softmax[:, 1] - model.softmax[:, 0])
        own = np.concatenate([
            _means(line[grams[starts[at]:starts[at] + counts[at:at + 65536].sum()]], counts[at:at + 65536])
            for at in range(0, len(words), 65536)])
        _, first, stop = best_windows(own[flat], lengths)
        full = stop > first
        size = (stop - first)[full]
        at = np.repeat(first[full] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        bags = np.repeat(np.arange(full.sum()), size)
        _learn(model, tools, *gather(flat[at]), bags, np.ones(full.sum()), labels[full])
    return model


def train(
    docs: DataFrame, labels: DataFrame, use: Column, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES,
) -> Subwords:
    """Fit on a sample of labelled rows for which ``use`` holds, bounded as in ``samples``."""
    return fit(samples.labelled(docs, labels, "toxic", use, rows, most_bytes))


def score(docs: DataFrame, model: Subwords) -> DataFrame:
    """``doc_id`` and ``score`` of every row; whole texts, null as empty, an empty table stays so."""
    bounded_batches(docs.sparkSession)
    rows = docs.select("doc_id", text_of(docs).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                found = model.scores(part.column("text").to_pylist(), known)
                yield pa.record_batch([part.column("doc_id"), pa.array(found)], names=["doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double")


def judge(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """Score every document, learning only from those outside the held-out fold.

    Columns: doc_id, held_out (false for a null doc_id), score, predicted. Repeated rows each give
    a row; further columns of either table are ignored.
    """
    model = train(docs, labels, samples.remainder(folds) != held)
    return score(docs, model).select(
        "doc_id", F.coalesce(samples.remainder(folds) == held, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
