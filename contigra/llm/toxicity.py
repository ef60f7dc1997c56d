"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

Features are the presence of hashed words and word beginnings.  The labelled sample gives
each feature's log odds; the ``selected`` features of the greatest standardised log odds enter the model.  Labels are
0/1, so grades are derived: 0 is not toxic; toxic documents are graded 1 to 3 by terciles
of the number of distinct marker features that they hold (a marker's log odds are beyond
any doubt).  The model P(grade <= k) = sigmoid(theta_k - x.w) shares the weights w over
the ordered thresholds theta; it gives the probability of each grade and the expected grade.

The model is fitted on at most ``most`` labelled rows; all rows are scored whole.

Defined cases: null and blank text has no features; without labels of both kinds every document
gets grade 0 with certainty; null or repeated doc_id and repeated rows are scored like any
others; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigra.llm.common import column_bytes, slices
from contigra.llm.models import LABELLED, labelled, lexical, map_text

GRADES = 4
SELECTED = 2048
TOXIC_AT = 0.3


def _feature_counts(sample: DataFrame) -> DataFrame:
    """feature, pos, neg: in how many labelled documents of each kind it is present."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            y = batch.column(0).to_numpy() > 0
            sets = [lexical(t) for t in column_bytes(batch, "text")]
            f, at = np.unique(np.concatenate(sets), return_inverse=True)
            pos = np.bincount(at, np.repeat(y, [len(s) for s in sets]), len(f)).astype(np.int64)
            n = np.bincount(at, minlength=len(f))
            yield pa.RecordBatch.from_arrays([pa.array(f.view(np.int64)), pa.array(pos), pa.array(n - pos)], names=["feature", "pos", "neg"])

    return sample.select("y_", "text").mapInArrow(run, "feature long, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def log_odds(pos: np.ndarray, neg: np.ndarray, p: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed log odds ratio of presence, and the same over its standard error."""
    a, b, c, d = pos + 0.5, p - pos + 0.5, neg + 0.5, n - neg + 0.5
    lor = np.log(a / b) - np.log(c / d)
    return lor, lor / np.sqrt(1 / a + 1 / b + 1 / c + 1 / d)


def fit_cumulative(rows: np.ndarray, cols: np.ndarray, y: np.ndarray, width: int, grades: int = GRADES, l2: float = 2e-5, steps: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by Adam on the penalised likelihood; features (rows, cols) are 1."""
    n = len(y)
    w = np.zeros(width)
    share = np.clip(np.cumsum(np.bincount(y, minlength=grades))[:-1] / n, 1e-4, 1 - 1e-4)
    start = np.log(share / (1 - share))
    gaps = np.concatenate((start[:1], np.log(np.maximum(np.diff(start), 1e-2))))  # increasing by construction
    m = [np.zeros(width + grades - 1) for _ in range(2)]
    for t in range(1, steps + 1):
        theta = np.concatenate((gaps[:1], gaps[0] + np.cumsum(np.exp(gaps[1:]))))
        s = np.bincount(rows, w[cols], n)
        edge = 1 / (1 + np.exp(-np.clip(np.concatenate(([-1e9], theta, [1e9]))[None, :] - s[:, None], -40, 40)))
        up, low = edge[np.arange(n), y + 1], edge[np.arange(n), y]
        p = np.maximum(up - low, 1e-12)
        du, dl = up * (1 - up) / p, low * (1 - low) / p
        g_score = (du - dl) / n
        g_theta = np.array([(-du[y == k]).sum() + dl[y == k + 1].sum() for k in range(grades - 1)]) / n
        g_gap = np.concatenate(([g_theta.sum()], [g_theta[k:].sum() * np.exp(gaps[k]) for k in range(1, grades - 1)]))
        g = np.concatenate((np.bincount(cols, g_score[rows], width) + l2 * w, g_gap))
        m[0] = 0.9 * m[0] + 0.1 * g
        m[1] = 0.99 * m[1] + 0.01 * g * g
        step = 0.1 * (m[0] / (1 - 0.9**t)) / (np.sqrt(m[1] / (1 - 0.99**t)) + 1e-8)
        w, gaps = w - step[:width], gaps - step[width:]
    return w, np.concatenate((gaps[:1], gaps[0] + np.cumsum(np.exp(gaps[1:]))))


class Model:
    """Sorted feature hashes, weights and thresholds."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.features, self.weights, self.thresholds = features, weights, thresholds

    def grades(self, text: bytes | None) -> list[float]:
        """The probability of each grade."""
        if not len(self.features):
            return [1.0] + [0.0] * (GRADES - 1)
        at = present(self.features, lexical(text))
        upto = 1 / (1 + np.exp(-np.clip(self.thresholds - self.weights[at].sum(), -40, 40)))
        return np.diff(upto, prepend=0, append=1).tolist()


def present(features: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Indices into sorted ``features`` of those in ``found``."""
    at = np.minimum(np.searchsorted(found, features), max(0, len(found) - 1))
    return np.flatnonzero(found[at] == features) if len(found) else np.empty(0, np.int64)


def fit(docs: DataFrame, labels: DataFrame, most: int = LABELLED, selected: int = SELECTED) -> Model:
    sample = labelled(docs, labels, "toxic", most, "toxic-labelled")
    totals = {r["t"]: r["n"] for r in sample.groupBy((F.col("y_") > 0).alias("t")).agg(F.count(F.lit(1)).alias("n")).collect()}
    p, n = totals.get(True, 0), totals.get(False, 0)
    if not p or not n:
        return Model(np.empty(0, np.uint64), np.empty(0), np.empty(0))
    a, b, c, d = (F.expr(x) for x in ("pos + 0.5", f"{p} - pos + 0.5", "neg + 0.5", f"{n} - neg + 0.5"))
    z = F.abs(F.log(a * d / (b * c))) / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    top = _feature_counts(sample).where("pos + neg > 1").orderBy(z.desc(), "feature").limit(selected).toPandas()  # ``selected`` rows
    features = top["feature"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(features)
    features = features[order]
    lor, z = log_odds(top["pos"].to_numpy(float)[order], top["neg"].to_numpy(float)[order], p, n)
    marker = (lor > 3) & (z > 4)
    held = map_text(sample, "f_", "array<int>", lambda t: present(features, lexical(t)).tolist(), pa.list_(pa.int32())).select("y_", "f_").toPandas()
    lists = [np.asarray(x, np.int64) for x in held["f_"]]
    toxic = held["y_"].to_numpy() > 0
    hits = np.array([marker[x].sum() for x in lists], float)
    cuts = np.quantile(hits[toxic], [1 / 3, 2 / 3])
    y = np.where(toxic, 1 + (hits > cuts[0]) + (hits > cuts[1]), 0)
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    return Model(features, *fit_cumulative(rows, np.concatenate(lists), y, len(features)))


def severity(docs: DataFrame, labels: DataFrame, toxic_at: float = TOXIC_AT, most: int = LABELLED, selected: int = SELECTED) -> DataFrame:
    """doc_id, expected_severity, severity (likeliest grade), p_toxic, toxic: one row a row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, most, selected))  # ``selected`` features
    scored = map_text(docs.select("doc_id", "text"), "p_", "array<double>", lambda t: sent.value.grades(t), pa.list_(pa.float64()))
    expected = sum((F.col("p_")[k] * k for k in range(1, GRADES)), F.lit(0.0))
    return scored.select("doc_id", expected.alias("expected_severity"), (F.array_position("p_", F.array_max("p_")) - 1).cast("int").alias("severity"), (1 - F.col("p_")[0]).alias("p_toxic"), (1 - F.col("p_")[0] >= toxic_at).alias("toxic"))
