"""Text features and the small models that are fitted on a bounded sample of labelled rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contigra.llm.common import column_bytes, mix, slices, word_hashes, write_shared

LABELLED = 20_000

_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_DIGITS = b"0123456789"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))


def lexical(text: bytes | None) -> np.ndarray:
    """Distinct hashes of the lower-cased words without punctuation, and of their first 4 and 5 bytes."""
    t = text.lower().translate(None, _PUNCTUATION).split() if text else []
    t = list(set(t))
    four, five = {w[:4] for w in t if len(w) > 4}, {w[:5] for w in t if len(w) > 5}
    return np.unique(np.concatenate([mix(word_hashes(list(w)) + np.uint64(k)) for k, w in enumerate((t, four, five))])) if t else np.empty(0, np.uint64)


SHAPE = ["log_words", "word_length", "upper", "punctuation", "digits", "symbols", "distinct", "line_distinct", "line_words", "caps_words", "exclaimed", "long_words", "top_word", "alpha", "pair_distinct", "letters"]


def shape(text: bytes | None) -> np.ndarray:
    """SHAPE features of a text: ratios of characters, words and lines, all zero for an empty text."""
    if not text or not (t := text.split()):
        return np.zeros(len(SHAPE))
    n, m = len(t), len(text)
    upper, digits = m - len(text.translate(None, _UPPER)), m - len(text.translate(None, _DIGITS))
    marks, letters = m - len(text.translate(None, _PUNCTUATION)), m - len(text.translate(None, _LETTERS))
    plain = text.lower().translate(None, _PUNCTUATION).split()
    of = np.unique(np.fromiter(map(hash, plain), np.int64, len(plain)), return_inverse=True, return_counts=True) if plain else (np.empty(0), np.empty(0, int), np.zeros(1))
    pairs = len(np.unique(of[1][:-1].astype(np.int64) * (len(of[0]) + 1) + of[1][1:])) if len(plain) > 1 else 1
    lines = [x for x in text.split(b"\n") if x.strip()]
    return np.array([
        np.log1p(n), m / n / 10, upper / m, marks / m, digits / m, sum(text.count(c) for c in b"|#{}<>=_~^\\") / m * 10, len(of[0]) / max(1, len(plain)), len(set(lines)) / len(lines),
        min(3.0, n / len(lines) / 20), sum(w.isupper() for w in t) / n, text.count(b"!") / n, sum(len(w) > 20 for w in t) / n, of[2].max() / max(1, len(plain)), sum(w.isalpha() for w in t) / n, pairs / max(1, len(plain) - 1), letters / m,
    ])


def standardised(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standard scores cut at 6, with squares, so that a linear model can reject both extremes."""
    z = np.clip((x - mean) / scale, -6, 6)
    return np.concatenate((z, z * z / 4), axis=-1)


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 30) -> tuple[np.ndarray, float]:
    """Newton steps for ridge logistic regression; (weights, intercept)."""
    a = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(a.shape[1])
    ridge = np.full(len(w), l2)
    ridge[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + ridge * w
        h = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(ridge)
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def labelled(docs: DataFrame, labels: DataFrame, label: str, most: int = LABELLED, name: str = "labelled") -> DataFrame:
    """text and ``label`` of at most ``most`` labelled documents, those of the smallest hashed ids; written once.

    Labels that contradict each other, null labels and ids are left out.  Of the texts that share an id the least stands for it, so
    ``most`` bounds the rows however often ids are repeated.
    """
    one = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("id_")).agg(F.min(label).alias("y_"), F.max(label).alias("z_")).where("y_ = z_")
    sample = one.select("id_", F.col("y_").cast("double").alias("y_")).orderBy(F.xxhash64("id_"), "id_").limit(most)
    found = docs.select(F.col("doc_id").cast("long").alias("id_"), "text").join(F.broadcast(sample), "id_")  # ``most`` rows of two numbers
    return write_shared(found.groupBy("id_", "y_").agg(F.min("text").alias("text")).select("id_", "text", "y_"), name)


def map_text(df: DataFrame, column: str, schema: str, value: Callable[[bytes | None], object], kind: pa.DataType, of: str = "text", keep: bool = False) -> DataFrame:
    """``df`` with a column computed from the text ``of``, and without that text unless ``keep``; ``value`` sees UTF-8 bytes."""
    rest = [c for c in df.columns if keep or c != of]
    out = T.StructType([f for f in df.schema.fields if f.name in rest] + T._parse_datatype_string(f"`{column}` {schema}").fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, of):
            new = pa.array([value(t) for t in column_bytes(batch, of)], kind)
            at = [batch.schema.get_field_index(c) for c in rest]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in at), new], names=[*rest, column])

    return df.mapInArrow(run, out)
