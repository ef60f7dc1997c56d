"""License detection by ordered rules.

A text is taken as its words: lower case, ASCII punctuation gone, one space apart.  Hundreds of rules (``license_rules``), each with a
level and keywords, are gated by these: the words of a text that are keywords decide which patterns are tried at all, so a text
without any costs one look-up a word.  Every match is a detection; overlapping ones are resolved by level: from the
highest down, a detection whose interval lies within one that is kept is dropped, as is one within a longer one of its own level,
or within an equal one of an earlier rule.  Partly overlapping detections all stay.

Four phrases are found beside the rules wherever their words stand one after the other; rules never take them away.

Rows never leave their partition; a row's memory is a few times its text.

Defined cases: a null or empty text has no words, no detection, null places and score 0; equal texts give equal rows; repeated rows
and rows without an id are rows of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigra.llm.common import column_bytes, slices, terms
from contigra.llm.license_rules import TEXT

#: The phrases that are always found, and their labels.
PHRASES = {b"gnu general public license": "gpl", b"apache license": "apache", b"cc by": "cc-by", b"mit license": "mit"}
#: How sure a license is, by the level of its best detection.
SURE = {4: 0.98, 3: 0.9, 2: 0.7, 1: 0.3}


class Rule(NamedTuple):
    label: str
    level: int
    keywords: frozenset[bytes]
    pattern: re.Pattern[bytes]


class Detection(NamedTuple):
    label: str
    level: int
    start: int  # words, from 0
    stop: int


def parse(text: str) -> list[Rule]:
    rules = []
    for line in text.strip().splitlines():
        label, level, keywords, pattern = line.split(" | ", 3)
        rules.append(Rule(label, int(level), frozenset(keywords.encode().split()), re.compile(rb"(?<!\S)(?:" + pattern.encode() + rb")(?!\S)")))
    return rules


RULES = parse(TEXT)
KEYWORDS = frozenset().union(*(r.keywords for r in RULES), *(p.split() for p in PHRASES))
_PHRASES = [(label, frozenset(p.split()), re.compile(rb"(?<!\S)" + p + rb"(?!\S)")) for p, label in PHRASES.items()]


def suppressed(found: list[Detection]) -> list[Detection]:
    """What is left of detections in the order of their rules, in order of place."""
    kept: list[Detection] = []
    for level in sorted({d.level for d in found}, reverse=True):
        own = sorted((d for d in found if d.level == level), key=lambda d: (d.start, -d.stop))  # equal ones in the order of rules
        above = sorted(kept, key=lambda d: d.start)
        begin = np.array([d.start for d in above], np.int64)
        reach = np.maximum.accumulate(np.array([d.stop for d in above], np.int64))
        last = -1  # how far those of this level reach that begin no later
        for d in own:
            i = int(np.searchsorted(begin, d.start, side="right"))
            if d.stop > last and not (i and reach[i - 1] >= d.stop):
                kept.append(d)
            last = max(last, d.stop)
    return sorted(kept, key=lambda d: (d.start, d.stop, d.label))


def detect(words: list[bytes], rules: list[Rule] = RULES) -> tuple[list[tuple[str, int]], list[Detection]]:
    """Places (label, first word) of the phrases, and the detections of the rules that stay."""
    there = KEYWORDS.intersection(words)
    if not there:
        return [], []
    text = b" ".join(words)
    begin = np.cumsum([0, *(len(w) + 1 for w in words)])  # where each word begins
    word = lambda offset: int(np.searchsorted(begin, offset))
    places = [(label, word(m.start())) for label, needs, p in _PHRASES if needs <= there for m in p.finditer(text)]
    found = [Detection(r.label, r.level, word(m.start()), word(m.end() + 1)) for r in rules if r.keywords <= there for m in r.pattern.finditer(text)]
    return places, suppressed(found)


def score(found: list[Detection]) -> float:
    """How sure it is that a text holds a license: one minus the chance that every label's best detection errs."""
    best: dict[str, int] = {}
    for d in found:
        best[d.label] = max(best.get(d.label, 0), d.level)
    return round(1 - float(np.prod([1 - SURE[x] for _, x in sorted(best.items())])), 6)


def detections(docs: DataFrame) -> DataFrame:
    """doc_id, label, level, first_word, end_word (exclusive), matched: one row a detection that stays."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows, out = [], []
            for row, text in enumerate(column_bytes(batch, "text")):
                words = terms(text)
                for d in detect(words)[1]:
                    rows.append(row)
                    out.append((*d, b" ".join(words[d.start : d.stop]).decode()))
            label, level, start, stop, matched = zip(*out, strict=True) if out else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(label, pa.string()), pa.array(level, pa.int32()), pa.array(start, pa.int64()), pa.array(stop, pa.int64()), pa.array(matched, pa.string())],
                names=["doc_id", "label", "level", "first_word", "end_word", "matched"],
            )

    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return thin.mapInArrow(run, "doc_id long, label string, level int, first_word long, end_word long, matched string")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: one row a document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = []
            for text in column_bytes(batch, "text"):
                words = terms(text)
                places, found = detect(words)
                base, at = {x for x, _ in places}, [i for _, i in places]
                labels = base | {d.label for d in found}
                sure = score([*found, *(Detection(x, 3, i, i) for x, i in places)])
                out.append((len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), sure))
            n, n_base, first, last, base, labels, sure = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, n_base, first, last)), pa.array(base, pa.string()), pa.array(labels, pa.string()), pa.array(sure, pa.float64())],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return thin.mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
