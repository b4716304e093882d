"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad.  Its features are its own and those of the lines before and after;
transition weights tie neighbouring labels.  Lines of a labelled document carry its label in
training.  The score of a document is the mean of its lines' forward-backward marginals for
"good", weighted by line length.

The model is small and fitted on a bounded sample; scoring reads every line of every text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strider.llm.common import slices, text_of

#: Bounds of the training sample: documents, and lines of one document.
SAMPLE_DOCS, SAMPLE_LINES = 4000, 400
ROUNDS, RATE, PENALTY = 250, 0.08, 1e-4
_UPPER, _DIGIT = bytes(range(65, 91)), b"0123456789"
_LETTER = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_PLAIN = _LETTER + _DIGIT + b" \t\r.,;:'\"()-"


def line_features(line: bytes) -> list[float]:
    """Features of one line from its UTF-8 bytes, each about 0 to 1."""
    words = line.split()
    n, k = max(1, len(line)), max(1, len(words))
    letters = len(line) - len(line.translate(None, _LETTER))
    upper = len(line) - len(line.translate(None, _UPPER))
    digits = len(line) - len(line.translate(None, _DIGIT))
    odd = len(line.translate(None, _PLAIN))
    distinct = len(set(words))
    return [
        1.0,
        upper / max(1, letters),
        float(upper > 0.5 * letters and letters > 0),
        digits / n,
        min(1.0, 5 * odd / n),
        float(odd > 0.1 * n),
        line.count(b"|") / k,
        line.count(b"!") / k,
        1 - distinct / k,
        float(k >= 8 and distinct < 0.4 * k),
        min(1.0, len(line) / (12 * k)),
        min(1.0, k / 40),
        float(line[-1:] in (b".", b"?", b"!")),
        float(not words),
    ]


FEATURES = len(line_features(b""))


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(lines x 3*FEATURES features: own, line before, line after; weight of each line)."""
    lines = text.encode().split(b"\n")
    own = np.fromiter(chain.from_iterable(map(line_features, lines)), np.float32,
                      len(lines) * FEATURES).reshape(-1, FEATURES)
    none = np.zeros((1, FEATURES), np.float32)
    wide = np.hstack([own, np.vstack([none, own[:-1]]), np.vstack([own[1:], none])])
    return wide, np.array([len(x) + 1 for x in lines], np.float64)


def _forward(score: np.ndarray, length: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Log forward messages; ``score``: documents (longest first) x lines x 2."""
    out = np.zeros_like(score)
    out[:, 0] = score[:, 0]
    for t in range(1, score.shape[1]):
        m = int(np.searchsorted(-length, -t, side="left"))      # documents longer than t
        before = out[:m, t - 1, :, None] + step
        out[:m, t] = np.logaddexp(before[:, 0], before[:, 1]) + score[:m, t]
    return out


def _backward(score: np.ndarray, length: np.ndarray, step: np.ndarray) -> np.ndarray:
    out = np.zeros_like(score)
    for t in range(score.shape[1] - 2, -1, -1):
        m = int(np.searchsorted(-length, -(t + 1), side="left"))
        after = (out[:m, t + 1] + score[:m, t + 1])[:, None, :] + step
        out[:m, t] = np.logaddexp(after[:, :, 0], after[:, :, 1])
    return out


def _padded(parts: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    out = np.zeros((len(parts), max(len(p) for p in parts), 2))
    for row, i in enumerate(order):
        out[row, :len(parts[i]), 1] = parts[i]
    return out


def marginals(emissions: list[np.ndarray], step: np.ndarray) -> list[np.ndarray]:
    """P(good) of every line of every document; ``emissions``: score of good against bad."""
    if not emissions:
        return []
    length = np.array([len(e) for e in emissions])
    order = np.argsort(-length, kind="stable")
    out: list[np.ndarray] = [np.zeros(0)] * len(emissions)
    at = 0
    while at < len(order):                       # documents of like length together
        longest = length[order[at]]
        end = at + max(1, int((length[order[at:]] * 2 >= longest).sum()))
        own = order[at:end]
        score = _padded([emissions[i] for i in own], np.arange(len(own)))
        joint = _forward(score, length[own], step) + _backward(score, length[own], step)
        good = 1 / (1 + np.exp(np.clip(joint[:, :, 0] - joint[:, :, 1], -60, 60)))
        for row, i in enumerate(own):
            out[i] = good[row, :length[i]]
        at = end
    return out


def train(features: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weights, step) of greatest penalised likelihood, by Adam on the whole sample."""
    length = np.array([len(f) for f in features])
    order = np.argsort(-length, kind="stable")
    length, labels = length[order], np.asarray(labels)[order]
    rows = np.concatenate([features[i] for i in order]).astype(np.float64)
    doc = np.repeat(np.arange(len(order)), length)
    line = np.concatenate([np.arange(n) for n in length])
    inside = line < length[doc] - 1
    size = rows.shape[1]
    theta = np.zeros(size + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    # Equal weight for both classes and for every document.
    share = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    for k in range(1, ROUNDS + 1):
        step = theta[size:].reshape(2, 2)
        score = np.zeros((len(order), int(length.max()), 2))
        score[doc, line, 1] = rows @ theta[:size]
        ahead, behind = _forward(score, length, step), _backward(score, length, step)
        total = np.logaddexp(ahead[:, 0, 0] + behind[:, 0, 0], ahead[:, 0, 1] + behind[:, 0, 1])
        good = np.exp(ahead[doc, line, 1] + behind[doc, line, 1] - total[doc])
        grad = np.zeros_like(theta)
        grad[:size] = ((labels[doc] - good) * share[doc]) @ rows
        d, t = doc[inside], line[inside]
        for a in (0, 1):
            for b in (0, 1):
                pair = np.exp(ahead[d, t, a] + step[a, b] + score[d, t + 1, b] + behind[d, t + 1, b] - total[d])
                seen = (labels[d] == a) & (a == b)
                grad[size + 2 * a + b] = ((seen - pair) * share[d]).sum()
        grad -= PENALTY * theta
        mean = 0.9 * mean + 0.1 * grad
        square = 0.999 * square + 0.001 * grad ** 2
        theta = theta + RATE * (mean / (1 - 0.9 ** k)) / (np.sqrt(square / (1 - 0.999 ** k)) + 1e-8)
    return theta[:size], theta[size:].reshape(2, 2)


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo 5."""
    return F.crc32(key.cast("string").cast("binary")) % 5


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Train on at most SAMPLE_DOCS labelled documents outside the held-out fold.

    The sample is the documents with the smallest hash of doc_id that have at most
    SAMPLE_LINES lines.  A document labelled twice counts as good if any label says so;
    null labels are left out.  Without labels every line is a coin toss.
    """
    known = (labels.where("quality is not null and doc_id is not null").where(fold(F.col("doc_id")) != 0)
             .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    rows = docs.select("doc_id", text_of().alias("text")).where(
        F.regexp_count("text", F.lit("\n")) < SAMPLE_LINES).join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column(0)):
                wide = [document_features(x)[0].astype(np.float32).tobytes() for x in texts]
                yield pa.RecordBatch.from_arrays([pa.array(wide, pa.binary()), batch.column(1).slice(at, len(texts))],
                                                 names=["wide", "quality"])
    sample = rows.select("text", "quality").mapInArrow(run, "wide binary, quality int").orderBy(
        F.xxhash64("wide"), "wide", "quality").limit(SAMPLE_DOCS).collect()
    if len({r.quality for r in sample}) < 2:
        return np.zeros(3 * FEATURES), np.zeros((2, 2))
    return train([np.frombuffer(r.wide, np.float32).reshape(-1, 3 * FEATURES) for r in sample],
                 np.array([r.quality for r in sample]))


def scorer(model: tuple[np.ndarray, np.ndarray]) -> Callable[[list[str]], np.ndarray]:
    """Function from texts to scores."""
    weights, step = model

    def run(texts: list[str]) -> np.ndarray:
        made = [document_features(x) for x in texts]
        good = marginals([wide @ weights for wide, _ in made], step)
        return np.array([float(g @ size / size.sum()) for g, (_, size) in zip(good, made)])
    return run


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], threshold: float = 0.3) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null text: empty, scored as one empty line.  A null doc_id is held out from nothing
    (held_out is null); repeated keys are scored row by row.  Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    grade = scorer(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(grade(texts))],
                                                 names=["doc_id", "score"])
    out = rows.mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], threshold: float = 0.3) -> DataFrame:
    """``docs`` without the documents whose score is under the threshold; all columns, no shuffle."""
    grade = scorer(model)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place).fill_null("")
            for at, texts in slices(column):
                yield batch.slice(at, len(texts)).filter(pa.array(grade(texts) >= threshold))
    return docs.mapInArrow(run, docs.schema)
