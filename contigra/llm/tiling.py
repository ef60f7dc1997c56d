"""Benchmark decontamination by greedy string tiling.

Tokens are the lower-cased words without ASCII punctuation.  Rolling (Karp-Rabin)
hashes of ``seed`` tokens of the benchmark are looked up in every document; a document
and an item that share a seed are tiled: the longest common run that is not yet marked
on either side is marked, over and over, until none of ``seed`` tokens is left.  An item
whose tokens are covered to ``coverage`` or more is in the document, in whatever order its
passages stand.

The benchmark is the query set: it is read in blocks of ``block_rows`` items and of bounded bytes, and each
block is broadcast and held against all rows in one pass.  Its size sets the number of
passes, never the memory of one.

Defined cases: null and blank texts of documents or items match nothing; an item shorter than ``seed``
tokens is its own seed and must occur whole; repeated items and items of equal text each
give their own row; an empty benchmark or table gives an empty result; rows with a null
item_id are left out; a repeated doc_id gives a row for each document; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigra.llm.common import column_bytes, mix, slices, word_hashes

SEED = 5
COVERAGE = 0.5
BLOCK_ROWS, BLOCK_BYTES = 20_000, 16 << 20
BITS = 22

_DROP = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_KARP = np.uint64(0x5851F42D4C957F2D)


def tokens(text: bytes | None) -> np.ndarray:
    """64-bit hashes of the words, lower-cased, without ASCII punctuation."""
    return word_hashes(text.lower().translate(None, _DROP).split()) if text else np.empty(0, np.uint64)


def rolling(t: np.ndarray, k: int) -> np.ndarray:
    """The Karp-Rabin hash of each run of k tokens."""
    n = len(t) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = t[:n].copy()
    for j in range(1, k):
        acc = acc * _KARP + t[j : n + j]
    return mix(acc)


def tile(doc: np.ndarray, item: np.ndarray, pairs: Iterable[tuple[int, int]], k: int) -> list[tuple[int, int, int]]:
    """Tiles (position in item, position in doc, length), longest first.

    pairs: positions at which k tokens of item and doc agree.  Ties go to the smallest
    position in the item, then in the document.
    """
    by_diagonal: dict[int, list[int]] = defaultdict(list)
    for p, q in pairs:
        if (item[p : p + k] == doc[q : q + k]).all():
            by_diagonal[q - p].append(p)
    heap: list[tuple[int, int, int]] = []
    for shift, starts in by_diagonal.items():
        starts.sort()
        first = last = starts[0]
        for p in [*starts[1:], -1]:
            if p != last + 1:
                heap.append((-(last - first + k), first, first + shift))
                first = p
            last = p
    heapq.heapify(heap)
    in_item, in_doc, out = np.zeros(len(item), bool), set(), []
    while heap:
        size, p, q = heapq.heappop(heap)
        size = -size
        free = [not in_item[p + i] and q + i not in in_doc for i in range(size)]
        if all(free):
            out.append((p, q, size))
            in_item[p : p + size] = True
            in_doc.update(range(q, q + size))
            continue
        a = 0
        for i in range(size + 1):
            if i == size or not free[i]:
                if i - a >= k:
                    heapq.heappush(heap, (-(i - a), p + a, q + a))
                a = i + 1
    return out


class Benchmark:
    """A block of items with the places of their seeds."""

    def __init__(self, ids: list[int], texts: list[bytes | None], k: int):
        self.k = k
        held = [(i, t) for i, t in zip(ids, map(tokens, texts), strict=True) if len(t)]
        self.ids, self.items = [i for i, _ in held], [t for _, t in held]
        self.sizes = sorted({min(k, len(t)) for t in self.items})
        self.tables = {}
        for size in self.sizes:
            keys, of, at = [], [], []
            for n, t in enumerate(self.items):
                if min(k, len(t)) == size:
                    h = rolling(t, size)
                    keys.append(h)
                    of.append(np.full(len(h), n))
                    at.append(np.arange(len(h)))
            key = np.concatenate(keys)
            order = np.argsort(key, kind="stable")
            bits = np.zeros(1 << BITS, bool)
            bits[(key >> np.uint64(64 - BITS)).astype(np.int64)] = True
            self.tables[size] = (key[order], np.concatenate(of)[order], np.concatenate(at)[order], bits)

    def matches(self, text: bytes | None) -> list[tuple[int, float, int, int, int]]:
        """(item id, coverage, tiles, longest tile, tokens) of each item that shares a seed with the text."""
        doc = tokens(text)
        seeds: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for size, (key, of, at, bits) in self.tables.items():
            h = rolling(doc, size)
            may = np.flatnonzero(bits[(h >> np.uint64(64 - BITS)).astype(np.int64)])
            if len(may):
                a, b = np.searchsorted(key, h[may], "left"), np.searchsorted(key, h[may], "right")
                for q, i, j in zip(may.tolist(), a.tolist(), b.tolist(), strict=True):
                    for x in range(i, j):
                        seeds[int(of[x])].append((int(at[x]), q))
        out = []
        for n, pairs in seeds.items():
            item = self.items[n]
            tiles = tile(doc, item, pairs, min(self.k, len(item)))
            if tiles:
                out.append((self.ids[n], sum(t[2] for t in tiles) / len(item), len(tiles), max(t[2] for t in tiles), len(item)))
        return sorted(out)


def _blocks(benchmark: DataFrame, k: int, block_rows: int) -> Iterator[Benchmark]:
    """The items in blocks of at most ``block_rows`` and of BLOCK_BYTES of text (or one item), one at a time on the driver."""
    ids, texts, held = [], [], 0
    for r in benchmark.where("item_id is not null").select("item_id", F.encode("text", "UTF-8").alias("text")).toLocalIterator():
        text = None if r["text"] is None else bytes(r["text"])
        size = len(text or b"")
        if ids and (len(ids) == block_rows or held + size > BLOCK_BYTES):
            yield Benchmark(ids, texts, k)
            ids, texts, held = [], [], 0
        ids.append(r["item_id"])
        texts.append(text)
        held += size
    if ids:
        yield Benchmark(ids, texts, k)


def contamination(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, seed: int = SEED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, item_id, coverage, tiles, longest, item_tokens: one row for each item found in a document."""
    schema = "doc_id long, item_id long, coverage double, tiles int, longest int, item_tokens int"
    thin, out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), None
    for block in _blocks(benchmark, seed, block_rows):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                rows, found = [], []
                for row, text in enumerate(column_bytes(batch, "text")):
                    for m in sent.value.matches(text):
                        if m[1] >= coverage:
                            rows.append(row)
                            found.append(m)
                item, share, tiles, longest, size = zip(*found, strict=True) if found else ([],) * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(item, pa.int64()), pa.array(share, pa.float64()), *(pa.array(x, pa.int32()) for x in (tiles, longest, size))],
                    names=["doc_id", "item_id", "coverage", "tiles", "longest", "item_tokens"],
                )

        part = thin.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, seed: int = SEED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The documents in which no item is covered to ``coverage``, with all columns; rows never leave their partition."""
    for block in _blocks(benchmark, seed, block_rows):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                yield batch.filter(pa.array([all(m[1] < coverage for m in sent.value.matches(t)) for t in column_bytes(batch, "text")], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
