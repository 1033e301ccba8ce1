"""Quality by regularised quadratic discriminant analysis of document statistics.

Each class has a mean and a covariance of the transformed statistics; the covariance is
shrunk towards a multiple of the identity. The Cholesky factors are computed once and sent
to the tasks, which turn each document's statistics into two Mahalanobis distances; the
difference of the log-densities is the log-odds of good quality.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textops
from millrace.llm.samples import training_rows

SAMPLE = 20_000  # labelled documents that are learnt from
SHRINK = 0.1
#: Log-odds are divided by this, since statistics are not quite normal.
SPREAD = 4.0
NAMES = ["words", "word_length", "upper", "symbols", "marks", "digits", "distinct", "repeated", "double_lines", "line_words", "longest", "bang"]

_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_LETTER = np.array([65 <= (b & 0xDF) <= 90 or b >= 128 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_SYMBOL = np.array([b in b"#*$%&|<>@^~=_\\{}[]" for b in range(256)])
_MARK = np.array([b in b".,;:!?'\"()-" for b in range(256)])
_BANG = np.array([b in b"!?" for b in range(256)])


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Transformed statistics, a row for each text: logarithms of sizes, arcsines of square roots of shares."""
    starts, ends, first = textops.words(data, offsets)
    n = np.diff(first)
    some = np.maximum(n, 1)
    letters = np.maximum(_sums(_LETTER[data], offsets), 1)
    lengths = ends - starts
    solid = np.maximum(_sums(lengths, first), 1)
    hashes = textops.Rolling(data).of(starts, ends)
    grams = textops.Rolling(hashes).grams(3)
    lines = np.concatenate(([0], np.cumsum(data == 10)))
    line_of = lines[starts] if len(starts) else starts
    texts = len(n)
    distinct, repeated, twice, longest, count = (np.zeros(texts) for _ in range(5))
    sequence = textops.Rolling(hashes)
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        if b == a:
            continue
        distinct[i] = len(np.unique(hashes[a:b])) / np.sqrt(b - a)
        longest[i] = lengths[a:b].max()
        if b - a >= 3:
            repeated[i] = 1 - len(np.unique(grams[a : b - 2])) / (b - a - 2)
        head = np.flatnonzero(np.concatenate(([True], line_of[a + 1 : b] != line_of[a : b - 1]))) + a
        count[i] = len(head)
        if len(head) > 1:
            twice[i] = 1 - len(np.unique(sequence.of(head, np.append(head[1:], b)))) / len(head)
    share = lambda x: np.arcsin(np.sqrt(np.clip(x, 0, 1)))
    return np.stack(
        [
            np.log1p(n),
            np.log1p(_sums(lengths, first) / some),
            share(_sums(_UPPER[data], offsets) / letters),
            share(_sums(_SYMBOL[data], offsets) / solid),
            share(_sums(_MARK[data], offsets) / solid),
            share(_sums(_DIGIT[data], offsets) / solid),
            np.log1p(distinct),
            share(repeated),
            share(twice),
            np.log1p(n / np.maximum(count, 1)),
            np.log1p(longest),
            share(_sums(_BANG[data], offsets) / solid),
        ],
        1,
    )


@dataclass
class Discriminant:
    middle: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    roots: list[np.ndarray]  # inverses of the Cholesky factors, by class
    constants: list[float]  # log prior less log determinant

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of class 1."""
        z = (x - self.middle) / self.scale
        dense = [c - 0.5 * (((z - m) @ r.T) ** 2).sum(1) for m, r, c in zip(self.means, self.roots, self.constants, strict=True)]
        return (dense[1] - dense[0]) / SPREAD

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.odds(x), -40, 40)))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, shrink: float = SHRINK) -> Discriminant:
    """A discriminant from about ``sample`` labelled documents that are not held out (labels: doc_id, quality).

    The tasks send sums and products of the statistics, by class; nothing else reaches the
    driver. Where one class has no row, every document gets the share of class 1.
    """
    d = len(NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, square = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
        for piece in textops.slices(batches):
            x, y = statistics(*textops.pack(piece.column("text"))), piece.column("y").to_numpy()
            for k in (0, 1):
                own = x[y == k]
                count[k] += len(own)
                total[k] += own.sum(0)
                square[k] += own.T @ own
        rows = [np.concatenate(([count[k]], total[k], square[k].ravel())).tolist() for k in (0, 1)]
        yield pa.record_batch([pa.array([0, 1], pa.int32()), pa.array(rows, pa.list_(pa.float64()))], names=["y", "sums"])

    sums = training_rows(docs, labels, "quality", sample).mapInArrow(run, "y int, sums array<double>")
    width = 1 + d + d * d
    added = sums.select("y", F.posexplode("sums").alias("at", "x")).groupBy("y", "at").agg(F.sum("x").alias("x")).collect()  # 2 * width numbers
    table = np.zeros((2, width))
    for r in added:
        table[r["y"], r["at"]] = r["x"]
    count = table[:, 0]
    share = (count + 0.5) / (count.sum() + 1)
    if (count < 2).any():
        level = float(SPREAD * np.log(share[1] / share[0])) if count.sum() else 0.0
        return Discriminant(np.zeros(d), np.ones(d), [np.zeros(d)] * 2, [np.zeros((d, d))] * 2, [0.0, level])
    middle = table[:, 1 : 1 + d].sum(0) / count.sum()
    scale = np.sqrt(np.maximum(np.diag(table[:, 1 + d :].sum(0).reshape(d, d)) / count.sum() - middle**2, 1e-6))
    means, roots, constants = [], [], []
    for k in (0, 1):
        mean = table[k, 1 : 1 + d] / count[k]
        covariance = (table[k, 1 + d :].reshape(d, d) / count[k] - np.outer(mean, mean)) / np.outer(scale, scale)
        covariance = (1 - shrink) * covariance + shrink * max(np.trace(covariance) / d, 1e-3) * np.eye(d)
        factor = np.linalg.cholesky(covariance)
        means.append((mean - middle) / scale)
        roots.append(np.linalg.inv(factor))
        constants.append(float(np.log(share[k]) - np.log(np.diag(factor)).sum()))
    return Discriminant(middle, scale, means, roots, constants)


def score(docs: DataFrame, model: Discriminant) -> DataFrame:
    """``docs`` with ``quality_score`` (0 to 1), which replaces a column of that name.

    Null and empty texts have the statistics of a text without words. Every row is scored
    by itself; an empty table gives an empty result.
    """
    docs = docs.drop("quality_score")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in textops.slices(batches):
            p = model.probability(statistics(*textops.pack(piece.column("text"))))
            yield pa.record_batch([*piece.columns, pa.array(p)], names=[*names, "quality_score"])

    return docs.mapInArrow(run, docs.select("*", F.lit(None).cast("double").alias("quality_score")).schema)
