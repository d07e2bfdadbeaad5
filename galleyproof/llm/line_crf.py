"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import samples
from .shared import bounded_batches, slices, text_of

SLICE_BYTES = 1 << 20
THRESHOLD = 0.3
#: A line of a bad document counts as good in training once the field is this sure of it.
SURE = 0.8
ROUNDS = 2
SAMPLE_ROWS = 2000
SAMPLE_BYTES = 8 << 20

_CLASSES = [
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\x0b\x0c",
    b".,;:?'\"-()", b"!", b"|", b"#$%&*+=~^_`@", b"/\\<>[]{}", bytes(range(128, 256)),
]
_KIND = np.full(256, len(_CLASSES), np.int64)
for _k, _chars in enumerate(_CLASSES):
    _KIND[list(_chars)] = _k
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWER = np.random.default_rng(5).integers(1, 1 << 62, 64, dtype=np.uint64) | np.uint64(1)


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line with those of its neighbours, line lengths, lines per document.

    Lines end at line feeds; an empty text has one empty line. A line's own features are shares of
    kinds of characters, its length, words, and how often words repeat next to each other or at
    all within it.
    """
    lines_of = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
    buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    stops = np.flatnonzero(buffer == 10)
    starts = np.concatenate(([0], stops[:-1] + 1))
    n_lines, sizes = len(stops), stops - starts
    line_of_byte = np.repeat(np.arange(n_lines), sizes + 1)
    counts = np.bincount(line_of_byte * (len(_CLASSES) + 1) + _KIND[buffer], minlength=n_lines * (len(_CLASSES) + 1))
    shares = counts.reshape(n_lines, -1)[:, :len(_CLASSES)] / np.maximum(sizes, 1)[:, None]

    inside = ~_SPACE[buffer]
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    words = np.zeros(n_lines)
    repeats, distinct = np.zeros(n_lines), np.ones(n_lines)
    if len(first):
        length = last - first
        place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        value = buffer[inside].astype(np.uint64) * _POWER[place & 63] + place.astype(np.uint64)
        name = np.add.reduceat(value, np.cumsum(length) - length)
        line = line_of_byte[first]
        words = np.bincount(line, minlength=n_lines).astype(float)
        same = np.zeros(len(first), bool)
        same[1:] = (name[1:] == name[:-1]) & (line[1:] == line[:-1])
        repeats = np.bincount(line, same, n_lines) / np.maximum(words, 1)
        order = np.lexsort((name, line))
        fresh = np.ones(len(first), bool)
        fresh[1:] = (name[order][1:] != name[order][:-1]) | (line[order][1:] != line[order][:-1])
        distinct = np.bincount(line[order], fresh, n_lines) / np.maximum(words, 1)
    letters = shares[:, 0] + shares[:, 1] + shares[:, 9]
    own = np.column_stack([
        np.sqrt(shares), shares[:, 0] / np.maximum(letters, 1e-9) * (letters > 0), np.log1p(sizes) / 5,
        np.log1p(words) / 3, sizes / np.maximum(words, 1) / 20 * (words > 0), np.sqrt(repeats), distinct,
        sizes == 0,
    ])
    own[:, -4] = np.minimum(own[:, -4], 3)
    ends = np.cumsum(lines_of)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[ends - lines_of], after[ends - 1] = 0, 0
    at_edge = np.zeros((n_lines, 2))
    at_edge[ends - lines_of, 0], at_edge[ends - 1, 1] = 1, 1
    return np.column_stack([own, before, after, at_edge, np.ones(n_lines)]), sizes, lines_of


def chain(scores: np.ndarray, moves: np.ndarray, lines_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Scaled forward-backward over all documents at once, longest first.

    ``scores`` are the lines' log potentials for bad and good, ``moves`` those of transitions.
    Returns the marginals of each line, the expected transitions, and the log partition sum.
    """
    n = len(lines_of)
    first = np.cumsum(lines_of) - lines_of
    order = np.argsort(-lines_of, kind="stable")
    first, length = first[order], lines_of[order]
    steps = int(length[0]) if n else 0
    active = np.searchsorted(-length, -np.arange(steps), side="left")  # documents with a line t
    top = scores.max(axis=1)
    emit, move = np.exp(scores - top[:, None]), np.exp(moves)
    alpha, scale = np.zeros_like(emit), np.ones(len(emit))
    for t in range(steps):
        at = first[:active[t]] + t
        a = emit[at] if t == 0 else (alpha[at - 1] @ move) * emit[at]
        scale[at] = a.sum(axis=1)
        alpha[at] = a / scale[at][:, None]
    beta, pairs = np.ones_like(emit), np.zeros((2, 2))
    for t in range(steps - 1, 0, -1):
        at = first[:active[t]] + t
        right = emit[at] * beta[at] / scale[at][:, None]
        beta[at - 1] = right @ move.T
        pairs += move * (alpha[at - 1].T @ right)
    marginal = alpha * beta
    return marginal / marginal.sum(axis=1, keepdims=True), pairs, float(np.log(scale).sum() + top.sum())


@dataclass
class LineField:
    """A fitted field: weights for "good", transitions, feature scaling and the final calibration."""

    weights: np.ndarray
    moves: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    slope: float
    level: float

    def marginals(self, features: np.ndarray, lines_of: np.ndarray) -> np.ndarray:
        good = ((features - self.mean) / self.spread) @ self.weights
        scores = np.column_stack([np.zeros(len(good)), good])
        return chain(scores, self.moves, lines_of)[0][:, 1]

    def quality(self, texts: list[bytes]) -> np.ndarray:
        """Mean marginal of "good" over a document's lines, weighted by length (plus one)."""
        features, sizes, lines_of = line_features(texts)
        good, weight = self.marginals(features, lines_of), sizes + 1.0
        starts = np.cumsum(lines_of) - lines_of
        return np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return 1 / (1 + np.exp(-(self.slope * (self.quality(texts) - self.level))))


def _fit_field(x: np.ndarray, lines_of: np.ndarray, good: np.ndarray, start: tuple, steps: int, ridge: float):
    """Adam on the field's penalised likelihood of the line labels ``good``."""
    weights, moves = start[0].copy(), start[1].copy()
    onehot = np.column_stack([~good, good]).astype(float)
    inner = np.ones(len(good), bool)
    inner[np.cumsum(lines_of) - lines_of] = False
    at = np.flatnonzero(inner)
    seen = onehot[at - 1].T @ onehot[at]
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(moves), np.zeros_like(moves)]
    n = len(good)
    for k in range(1, steps + 1):
        scores = np.column_stack([np.zeros(n), x @ weights])
        marginal, pairs, _ = chain(scores, moves, lines_of)
        slopes = (x.T @ (good - marginal[:, 1]) / n - ridge * weights, (seen - pairs) / n - ridge * moves)
        for i, (value, slope) in enumerate(zip((weights, moves), slopes, strict=True)):
            m, v = state[2 * i], state[2 * i + 1]
            m += 0.1 * (slope - m)
            v += 0.01 * (slope**2 - v)
            value += 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return weights, moves


def fit(examples: list[tuple[str, int]], steps: int = 60, ridge: float = 1e-4) -> LineField:
    """Fit on whole texts with document labels (1: good).

    Lines start with their document's label. As bad documents may hold good lines, lines there that
    the field is ``SURE`` of become good, unless that would clear the whole document, and the field
    is fitted again. Without examples of both labels every score is that label's share (0.5: none).
    """
    labels = np.array([y for _, y in examples], int)
    width = line_features([b""])[0].shape[1]
    if len(examples) == 0 or labels.min() == labels.max():
        share = 0.5 if len(examples) == 0 else 0.01 + 0.98 * labels.mean()
        blank = np.zeros(width)  # every line is as likely good as bad, so every mean is 0.5
        return LineField(blank, np.zeros((2, 2)), blank, blank + 1, 1.0, 0.5 - np.log(share / (1 - share)))
    texts = [t.encode() for t, _ in examples]
    features, sizes, lines_of = line_features(texts)
    mean, spread = features.mean(axis=0), features.std(axis=0)
    constant = spread < 1e-9
    mean[constant], spread[constant] = 0, 1
    x = (features - mean) / spread
    doc = np.repeat(np.arange(len(texts)), lines_of)
    good = labels[doc] == 1
    found = (np.zeros(width), np.zeros((2, 2)))
    for _ in range(ROUNDS):
        found = _fit_field(x, lines_of, good, found, steps, ridge)
        scores = np.column_stack([np.zeros(len(x)), x @ found[0]])
        sure = chain(scores, found[1], lines_of)[0][:, 1] > SURE
        cleared = np.bincount(doc, ~sure, len(texts)) == 0
        good = (labels[doc] == 1) | (sure & ~cleared[doc])
    field = LineField(*found, mean, spread, 1.0, 0.0)
    q = field.quality(texts)
    slope, level = 5.0, 0.5
    for _ in range(500):  # a logistic curve from the weighted mean to the document's label
        p = 1 / (1 + np.exp(-slope * (q - level)))
        wrong = labels - p
        slope += 5.0 * ((wrong * (q - level)).mean() - 1e-4 * slope)
        level -= 0.5 * wrong.mean()
        level = min(max(level, -1.0), 2.0)
    return LineField(*found, mean, spread, slope, level)


def train(
    docs: DataFrame, labels: DataFrame, use: Column, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES,
) -> LineField:
    """Fit on a sample of labelled rows for which ``use`` holds, bounded as in ``samples``."""
    return fit(samples.labelled(docs, labels, "quality", use, rows, most_bytes))


def scorer(field: LineField, docs: DataFrame) -> Column:
    """A column of scores, for use where rows must keep their other columns."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found, held, size = [], [], 0
            for t in texts:
                raw = t.encode()
                if held and size + len(raw) > SLICE_BYTES:
                    found.append(field.scores(held))
                    held, size = [], 0
                held.append(raw)
                size += len(raw)
            found.append(field.scores(held))
            yield pd.Series(np.concatenate(found))

    return score(text_of(docs))


def score(docs: DataFrame, field: LineField) -> DataFrame:
    """``doc_id`` and ``score`` of every row; whole texts, null as empty, an empty table stays so."""
    bounded_batches(docs.sparkSession)
    rows = docs.select("doc_id", text_of(docs).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                texts = [t.as_buffer().to_pybytes() for t in part.column("text")]
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(field.scores(texts))], names=["doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double")


def judge(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """Score every document, learning only from those outside the held-out fold.

    Columns: doc_id, held_out (false for a null doc_id), score, predicted. Repeated rows each give
    a row; further columns of either table are ignored.
    """
    field = train(docs, labels, samples.remainder(folds) != 0)
    return score(docs, field).select(
        "doc_id", F.coalesce(samples.remainder(folds) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """``docs`` without the rows whose score is under the threshold; columns stay as they are."""
    bounded_batches(docs.sparkSession)
    field = train(docs, labels, samples.remainder(folds) != 0)
    return docs.filter(scorer(field, docs) >= THRESHOLD)
