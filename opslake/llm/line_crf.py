"""Document quality from a linear-chain CRF over lines.

Every line is good or bad. Its features are shares of capitals, marks and
digits, repetition, word lengths and the like, of the line itself and of the
lines before and after it. Training takes a document's label for its lines.
A document's quality is the mean of the forward-backward marginals of "good",
weighted by line length, passed through a logistic curve fitted on the training
documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import keep_rows, slices, text_hash, texts
from opslake.llm.crf import Adam, Chains, forward_backward

# Bounds of the training sample: labelled documents, and lines of one of them.
TRAIN_DOCS = 4_000
TRAIN_LINES = 2_000

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"
_MARKS = b"!\"#$%&()*+/:;<=>?@[\\]^_`{|}~"
OWN = 16
WIDTH = 3 * OWN + 2


def line_features(line: bytes) -> list[float]:
    """OWN features of one line; an empty line has only the constant and its own flag."""
    n = len(line)
    words = line.split()
    if not words:
        return [1.0, 1.0] + [0.0] * (OWN - 2)
    upper = (n - len(line.translate(None, _UPPER))) / n
    marks = (n - len(line.translate(None, _MARKS))) / n
    digits = (n - len(line.translate(None, _DIGITS))) / n
    lower = (n - len(line.translate(None, _LOWER))) / n
    k = len(words)
    repeated = 1 - len(set(words)) / k
    mean = (n - k + 1) / k
    return [
        1.0, 0.0, min(k, 400) ** 0.5 / 20, upper, float(upper > 0.3), min(marks, 0.3) * 3, float(marks > 0.03), digits, lower,
        repeated, float(repeated > 0.6 and k > 5), min(mean, 40) / 20, float(mean > 9), float(line[-1:] in (b".", b"!", b"?")), float(k < 3),
        sum(map(eq, words, words[1:])) / k,
    ]


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(a row per line: own, of the line before, of the line after, first and last flags; bytes per line, at least 1)."""
    lines = text.split(b"\n")
    own = np.array([line_features(line) for line in lines], np.float32)
    out = np.zeros((len(lines), WIDTH), np.float32)
    out[:, :OWN] = own
    out[1:, OWN : 2 * OWN] = own[:-1]
    out[:-1, 2 * OWN : 3 * OWN] = own[1:]
    out[0, -2] = out[-1, -1] = 1
    return out, np.maximum([len(line) for line in lines], 1).astype(np.float64)


@dataclass
class Model:
    """Weights of "good" against "bad", transitions, and the curve from mean marginal to score."""

    weights: np.ndarray
    trans: np.ndarray
    start: np.ndarray
    curve: tuple[float, float]
    constant: float | None = None

    def raw(self, rows: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Length-weighted mean marginal of "good" of each document."""
        good = rows @ self.weights
        marginals, _, _ = forward_backward(Chains(counts), np.stack([0 * good, good], axis=1), self.trans, self.start)
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        return np.add.reduceat(marginals[:, 1] * sizes, starts) / np.add.reduceat(sizes, starts)

    def score(self, docs: list[bytes]) -> np.ndarray:
        if self.constant is not None or not docs:
            return np.full(len(docs), self.constant or 0.0)
        parts = [features(t) for t in docs]
        raw = self.raw(np.concatenate([p for p, _ in parts]), np.concatenate([s for _, s in parts]), np.array([len(s) for _, s in parts]))
        return _curve(raw, self.curve)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _curve(raw: np.ndarray, curve: tuple[float, float]) -> np.ndarray:
    return 1 / (1 + np.exp(-(curve[0] * _logit(raw) + curve[1])))


def train(parts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rounds: int = 120) -> Model:
    """Fit on documents (features, line sizes) with labels 0 or 1.

    Lines count by the share of their document, so long documents do not
    dominate. Without both labels the score is constant: the label, or 0.5
    without any.
    """
    none = np.zeros(WIDTH, np.float64)
    if len(set(labels.tolist())) < 2:
        return Model(none, np.zeros((2, 2)), np.zeros(2), (1.0, 0.0), float(labels[0]) if len(labels) else 0.5)
    rows, sizes = np.concatenate([p for p, _ in parts]).astype(np.float64), np.concatenate([s for _, s in parts])
    counts = np.array([len(s) for _, s in parts])
    chains, y = Chains(counts), np.repeat(labels, counts).astype(np.float64)
    weight = np.repeat(1 / counts, counts)
    weights, trans, start = none, np.zeros((2, 2)), np.zeros(2)
    inside = np.ones(len(y), bool)
    inside[np.cumsum(counts) - 1] = False
    stay = np.bincount(y[inside].astype(int), minlength=2)
    adam, firsts = Adam([weights, trans, start], 0.1), np.concatenate([[0], np.cumsum(counts)[:-1]])
    for _ in range(rounds):
        good = rows @ weights
        marginals, _, expected = forward_backward(chains, np.stack([0 * good, good], axis=1), trans, start, pairs=True)
        adam.ascend([
            rows.T @ (weight * (y - marginals[:, 1])) / len(counts) - 1e-3 * weights,
            (np.diag(stay) - expected) / max(1, inside.sum()) - 1e-2 * trans,
            np.bincount(labels, minlength=2) / len(labels) - marginals[firsts].mean(axis=0),
        ])
    model = Model(weights, trans, start, (1.0, 0.0))
    x, slope, shift = _logit(model.raw(rows, sizes, counts)), 1.0, 0.0
    for _ in range(25):  # Newton steps of a logistic regression with a small prior
        p = 1 / (1 + np.exp(-(slope * x + shift)))
        w, design = p * (1 - p) + 1e-6, np.stack([x, np.ones_like(x)], axis=1)
        g = design.T @ (labels - p) - np.array([slope - 1, shift]) * 1.0
        slope, shift = np.array([slope, shift]) + np.linalg.solve(design.T @ (design * w[:, None]) + np.eye(2), g)
    model.curve = (float(slope), float(shift))
    return model


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_docs: int = TRAIN_DOCS
) -> Model:
    """Fit on at most ``max_docs`` labelled documents, those with the least hash of the id.

    ``labels`` holds ids with 0 or 1; rows with NULL do not count, and of
    contradicting rows the majority does. Documents of more than TRAIN_LINES
    lines are not used for training.
    """
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("__id"))
    chosen = marked.agg((F.avg(label_col) >= 0.5).cast("long").alias("label")).orderBy(F.xxhash64("__id"), "__id").limit(max_docs)
    rows = texts(docs, id_col, text_col).join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select("doc_id", "text", "label")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            parts = [features(t) if t.count(b"\n") < TRAIN_LINES else None for t in batch.column(1).to_pylist()]
            keep = [i for i, p in enumerate(parts) if p]
            yield pa.record_batch(
                [pa.array([parts[i][0].tobytes() for i in keep], pa.binary()), pa.array([parts[i][1].tobytes() for i in keep], pa.binary()),
                 batch.column(2).take(pa.array(keep, pa.int64()))],
                names=["rows", "sizes", "label"],
            )

    found = rows.mapInArrow(run, "rows binary, sizes binary, label long").limit(2 * max_docs).collect()
    found.sort(key=lambda r: (r["label"], bytes(r["rows"])))
    parts = [(np.frombuffer(r["rows"], np.float32).reshape(-1, WIDTH), np.frombuffer(r["sizes"], np.float64)) for r in found]
    return train(parts, np.array([r["label"] for r in found], np.int64))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, score), one row per row of ``docs``; only the text counts.

    A NULL or empty text is one empty line. Repeated rows get equal scores, an
    empty table gives no row, other columns do not matter.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(model.score(batch.column(1).to_pylist()))], names=["doc_id", "text_hash", "score"]
            )

    rows = texts(docs, id_col, text_col, text_hash(text_col).alias("text_hash"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, score double")


def keep_good(docs: DataFrame, model: Model, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The documents that score at least ``least``; all columns stay."""
    return keep_rows(docs, text_col, lambda found: model.score(found) >= least)
