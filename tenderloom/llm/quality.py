"""A quality classifier: regularised quadratic discriminant analysis over document statistics.

Statistics of a text are counts over its bytes and words, transformed towards
a normal shape.  Each class has a mean and a covariance that is shrunk towards
the pooled one and a multiple of the identity.  The score is the logistic of
half the difference of Mahalanobis distances and log-determinants, from
Cholesky factors that are computed once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import slices, stored, string_buffers, prepared_tasks, trimmed, word_hashes, words

FEATURES = ("words", "word_length", "letters", "capitals", "digits", "symbols", "marks", "stops", "tails", "repeats", "distinct", "lines", "blanks")
D = len(FEATURES)
POOLED, SPHERE = 0.1, 0.02  # shares of the pooled covariance and of the identity
TEMPER = 0.5  # statistics are not independent of what they can't see: log-densities count half

_of = np.zeros((6, 256), bool)
_of[0, [*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0x80, 0x100)]] = True
_of[1, ord("A") : ord("Z") + 1] = True
_of[2, ord("0") : ord("9") + 1] = True
_of[3, [ord(c) for c in "#$%&*|@^~=+<>{}[]\\/_`"]] = True
_of[4, [ord(c) for c in "!?"]] = True
_of[5, [ord(c) for c in ".,;:"]] = True


def statistics(texts: pa.Array) -> np.ndarray:
    """Rows of D transformed statistics; an empty text has those of no words."""
    data, offsets = string_buffers(texts)
    out = []
    share = lambda a, b: np.log((a + 0.5) / (np.maximum(b - a, 0) + 0.5))  # noqa: E731  a smoothed logit
    for lo, hi in slices(offsets):
        n = hi - lo
        a, b = int(offsets[lo]), int(offsets[hi])
        starts, ends, rows = words(data, offsets, lo, hi)
        rows = rows - lo
        edge = (offsets[lo : hi + 1] - a).astype(np.int64)
        raw = data[a:b]

        def per_row(flags):
            total = np.zeros(len(flags) + 1, np.int64)
            np.cumsum(flags, out=total[1:])
            return (total[edge[1:]] - total[edge[:-1]]).astype(float)

        size = np.diff(edge).astype(float)
        letters, capitals, digits, symbols, marks, stops = (per_row(c[raw]) for c in _of)
        lines = per_row(raw == 0x0A)
        count = np.bincount(rows, minlength=n).astype(float)
        length = np.bincount(rows, ends - starts, n)
        h = word_hashes(data, starts, ends, lower=True)
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (rows[1:] == rows[:-1])
        tails = ~_of[0][data[ends - 1]] & ~_of[2][data[ends - 1]] if len(ends) else np.zeros(0, bool)
        order = np.lexsort((h, rows))
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (rows[order][1:] != rows[order][:-1])
        distinct = np.bincount(rows[order], new, n)
        out.append(
            np.stack(
                [
                    np.log1p(count),
                    np.log1p(length / np.maximum(count, 1)),
                    share(letters, size),
                    share(capitals, letters),
                    share(digits, size),
                    share(symbols, size),
                    share(marks, size),
                    share(stops, size),
                    share(np.bincount(rows, tails, n), count),
                    share(np.bincount(rows, again, n), count),
                    np.log((distinct + 0.5) / (np.sqrt(count) + 0.5)),
                    share(lines, count),
                    share(size - length, size),
                ],
                1,
            )
        )
    return np.concatenate(out) if out else np.zeros((0, D))


@dataclass
class Discriminant:
    """Means and inverse Cholesky factors of both classes, and the log-odds of what doesn't depend on the text."""

    mean: np.ndarray
    factor: np.ndarray
    offset: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        far = [np.square((x - self.mean[k]) @ self.factor[k].T).sum(1) for k in (0, 1)]
        return 1 / (1 + np.exp(-np.clip(TEMPER * 0.5 * (far[0] - far[1]) + self.offset, -700, 700)))


def fit_quality(labelled: DataFrame, label_col: str = "label") -> Discriminant | float:
    """From rows with ``x`` (statistics) and a label 0 or 1; other labels are ignored.

    Sums are formed in Spark; what reaches the driver is 2 * (1 + D + D * D)
    numbers.  With one class only, or none, the constant score 1, 0 or 0.5.
    """
    prepared_tasks(labelled.sparkSession)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + D + D * D))
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy().reshape(-1, D)
            for k in (0, 1):
                own = x[y == k]
                total[k] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).reshape(-1)])
        yield pa.record_batch([pa.array(np.repeat([0, 1], total.shape[1]).astype(np.int32)), pa.array(np.tile(np.arange(total.shape[1]), 2).astype(np.int32)), pa.array(total.reshape(-1))], ["k", "i", "v"])

    rows = labelled.filter(F.col(label_col).isin(0, 1)).select(F.col(label_col).cast("int").alias("y"), "x")
    found = rows.mapInArrow(moments, "k int, i int, v double").groupBy("k", "i").agg(F.sum("v").alias("v")).toPandas()
    total = np.zeros((2, 1 + D + D * D))
    total[found["k"], found["i"]] = found["v"]
    n = total[:, 0]
    if not n.all():
        return 0.5 if not n.any() else float(n[1] > 0)
    mean = total[:, 1 : 1 + D] / n[:, None]
    own = total[:, 1 + D :].reshape(2, D, D) / n[:, None, None] - mean[:, :, None] * mean[:, None, :]
    pooled = np.tensordot(n / n.sum(), own, 1)
    factor, level = [], []
    for k in (0, 1):
        # few rows lean more on what both classes share
        shrink = min(0.9, POOLED + D / n[k])
        cov = (1 - shrink - SPHERE) * own[k] + shrink * pooled + SPHERE * max(np.trace(pooled) / D, 1e-6) * np.eye(D)
        lower = np.linalg.cholesky(cov)
        factor.append(np.linalg.inv(lower))
        level.append(-np.log(np.diag(lower)).sum())
    return Discriminant(mean, np.array(factor), float(TEMPER * (level[1] - level[0]) + np.log(n[1] / n[0])))


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and x, the statistics of the whole text; null counts as empty."""
    prepared_tasks(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column(1))
            edge = pa.array(np.arange(len(x) + 1, dtype=np.int32) * D)
            yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(edge, pa.array(x.reshape(-1)))], [id_col, "x"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(lambda batches: trimmed(measured(batches)), f"`{id_col}` {kind}, x array<double>")


def score_quality(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.7) -> DataFrame:
    """One row per row of ``docs``: id_col, score (0 to 1), predicted (1 if score >= threshold, else 0).

    Learns from the labels that fulfil the condition ``learn``; ids with
    several labels count once for each.  Empty texts have a score like any
    other, very long ones are scored whole.  Null ids and repeated rows are
    scored, too, each row by itself.  Other columns of ``docs`` are ignored.
    An empty table gives an empty result.
    """
    stats = stored(document_statistics(docs, id_col, text_col), "statistics")
    known = labels.filter(learn).select(F.col(id_col).alias("_id"), F.col(label_col).alias("label"))
    model = fit_quality(stats.join(known, F.col(id_col) == F.col("_id")))

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        if not isinstance(model, Discriminant):
            return pd.Series(np.full(len(x), model))
        return pd.Series(model.scores(np.stack(x.to_numpy())) if len(x) else np.zeros(0))

    out = stats.select(id_col, score("x").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
