"""D-19: a join on sequence similarity: minimizers as seeds, chains along diagonals, aligned gaps.

An anchor is a stretch of k + w - 1 characters and more that two sequences share and that goes no further on either side.  Every
anchor holds a minimizer (the least hash of ``w`` neighbouring k-mers) in both, so an equi join of minimizers finds all pairs and all places
that matter; keys that many sequences hold are dealt over a grid (``join_grid``).  Of a place only its bin goes on, and bins next to each
other are one window, whatever the number of seeds in it.

In a window anchors are found anew from the characters.  Those whose diagonals lie in one band are chained: both positions rise, the
gap between two is ``gap`` at most on either side, and the chain of most matching characters wins.  Gaps are aligned at
least cost (then in fewest columns).  A pair of sequences has one hit: its best chain, the first of equal ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contigra.functions.scalar import reverse_complement
from contigra.operators.joins import join_grid

K, W, BAND, GAP = 15, 10, 32, 64
BIN = 1024
BLOCK = 1 << 20  # positions of a sequence that are hashed at once

_MULTIPLIER, _A, _B, _S = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(33)


def codes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le"), np.uint32).astype(np.uint64)


def rolling(x: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of ``k`` characters."""
    n = len(x) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        acc = acc * _MULTIPLIER + x[j : n + j]
    acc = (acc ^ (acc >> _S)) * _A
    acc = (acc ^ (acc >> _S)) * _B
    return acc ^ (acc >> _S)


def minimizers(text: str | None, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the least k-mer, the first of equal ones, of each run of ``w``; none below k + w - 1 characters."""
    x, found = codes(text), []
    for a in range(0, max(len(x) - k - w + 2, 0), BLOCK):
        h = rolling(x[a : a + BLOCK + k + w - 2], k)
        least = np.lib.stride_tricks.sliding_window_view(h, w).argmin(axis=1)
        at = np.unique(least + np.arange(len(least)))
        found.append((h[at], at + a))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at, first = np.unique(np.concatenate([f[1] for f in found]), return_index=True)
    return np.concatenate([f[0] for f in found])[first], at


def _seeds(sequences: DataFrame, id_: str, k: int, w: int) -> DataFrame:
    """hash, id, at, size: the minimizers of (id, seq)."""
    kind = dict(sequences.dtypes)[id_]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in enumerate(batch.column(1).to_pylist()):
                h, at = minimizers(text, k, w)
                if len(h):
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column(0).take(pa.array(np.full(len(h), row))), pa.array(at), pa.array(np.full(len(h), len(text)))], names=["hash", id_, "at", "size"])

    return sequences.select(id_, "seq").mapInArrow(run, f"hash long, {id_} {kind}, at long, size long")


def anchors(q: np.ndarray, s: np.ndarray, size: int) -> np.ndarray:
    """Rows (place in q, place in s, length): the longest common stretches of ``size`` characters and more, by diagonal."""
    hq, hs = rolling(q, size), rolling(s, size)
    order = np.argsort(hq, kind="stable")
    a, b = (np.searchsorted(hq[order], hs, side=side) for side in ("left", "right"))
    n = b - a
    j = np.repeat(np.arange(len(hs)), n)
    i = order[np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))] if len(j) else j
    if not len(j):
        return np.empty((0, 3), np.int64)
    sort = np.lexsort((i, j - i))
    i, j = i[sort], j[sort]
    first = np.flatnonzero(np.r_[True, (np.diff(j - i) != 0) | (np.diff(i) != 1)])
    return np.stack([i[first], j[first], size - 1 + np.diff(np.r_[first, len(i)])], axis=1)


def best_chain(found: np.ndarray, band: int, gap: int) -> tuple[int, list[tuple[int, int, int]]]:
    """(score, anchors) of the best chain; each anchor has lost what overlaps with the one before."""
    best: tuple[int, int, int] | None = None
    chosen: list[tuple[int, int, int]] = []
    diagonal = found[:, 1] - found[:, 0]
    for tile in np.unique(np.concatenate([diagonal // band, diagonal // band - 1])).tolist():
        own = found[(diagonal >= tile * band) & (diagonal < (tile + 2) * band)]
        own = own[np.lexsort((own[:, 1], own[:, 0]))]
        i, j, n = own.T
        score, back = n.copy(), np.full(len(own), -1)
        for x in range(1, len(own)):
            overlap = np.maximum(0, np.maximum(i[:x] + n[:x] - i[x], j[:x] + n[:x] - j[x]))
            apart = np.maximum(i[x] - i[:x] - n[:x], j[x] - j[:x] - n[:x])
            ok = (i[:x] < i[x]) & (j[:x] < j[x]) & (overlap < n[x]) & (apart <= gap)
            gain = np.where(ok, score[:x] - overlap, -1)
            y = int(gain.argmax())
            if gain[y] > 0:
                score[x], back[x] = n[x] + gain[y], y
        for x in np.flatnonzero(score == score.max()).tolist():
            path = [x]
            while back[path[-1]] >= 0:
                path.append(int(back[path[-1]]))
            path.reverse()
            rank = (-int(score[x]), int(i[path[0]]), int(j[path[0]]))
            if best is None or rank < best:
                best, chosen = rank, []
                for p in path:
                    cut = max(0, chosen[-1][0] + chosen[-1][2] - int(i[p]), chosen[-1][1] + chosen[-1][2] - int(j[p])) if chosen else 0
                    chosen.append((int(i[p]) + cut, int(j[p]) + cut, int(n[p]) - cut))
    return (-best[0], chosen) if best else (0, [])


def aligned_gap(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(cost, columns) of the alignment of two short stretches with fewest differences, then fewest columns."""
    if not len(a) or not len(b):
        return len(a) + len(b), len(a) + len(b)
    row = [(y, y) for y in range(len(b) + 1)]
    for x, c in enumerate(a.tolist(), 1):
        last, row = row, [(x, x)]
        for y, d in enumerate(b.tolist(), 1):
            (p, m), (u, v), (r, t) = last[y - 1], last[y], row[-1]
            row.append(min((p + (c != d), m + 1), (u + 1, v + 1), (r + 1, t + 1)))
    return row[-1]


def compare(q: np.ndarray, s: np.ndarray, offset: int, size: int, band: int, gap: int) -> tuple[int, int, int, int, int, int, int] | None:
    """(score, differences, aligned, qstart, qend, sstart, send; from 1) of the best chain of two texts, the second from ``offset`` on."""
    found = anchors(q, s, size)
    if not len(found):
        return None
    found[:, 1] += offset
    score, chain = best_chain(found, band, gap)
    cost = columns = 0
    for (i, j, n), (x, y, _) in zip(chain, chain[1:], strict=False):
        c, m = aligned_gap(q[i + n : x], s[j + n - offset : y - offset])
        cost, columns = cost + c, columns + m
    columns += sum(n for _, _, n in chain)
    (i, j, _), (x, y, n) = chain[0], chain[-1]
    return score, cost, columns, i + 1, x + n, j + 1, y + n


def similar(queries: DataFrame, subjects: DataFrame, identity: float = 85, least: int = 50, both: bool = False, k: int = K, w: int = W, band: int = BAND, gap: int = GAP) -> DataFrame:
    """D-19: (query, subject, strand, identity, aligned, score, qstart, qend, sstart, send) of sequences (id, seq) alike over ``least`` columns.

    ``both``: queries are turned over as well, strand ``-``.  Sequences shorter than k + w - 1 and null ones match nothing; equal ids of one
    side are sequences of their own only if their texts are looked at apart, so ids must be unique.
    """
    q = queries.select(F.col("id").alias("query"), F.lit("+").alias("strand"), "seq")
    if both:
        q = q.union(q.select("query", F.lit("-"), reverse_complement("seq")))
    s = subjects.select(F.col("id").alias("subject"), "seq")
    name = F.struct("query", "strand")
    one = _seeds(q.select(name.alias("name"), "seq"), "name", k, w).select("hash", "name", "size")
    two = _seeds(s, "subject", k, w).select("hash", "subject", F.floor(F.col("at") / BIN).alias("bin"))
    two = two.join(one.select("hash").distinct(), "hash", "left_semi")  # few subjects' seeds are any query's: the others stay where they are
    met = join_grid(one.distinct(), two.distinct(), ["hash"]).groupBy("name", "subject", "bin").agg(F.first("size").alias("size"))
    by = Window.partitionBy("name", "subject").orderBy("bin")
    far = F.col("bin") - F.lag("bin").over(by) > 1 + F.ceil(2 * (F.col("size") + band) / BIN)
    met = met.withColumn("window", F.sum(F.coalesce(far, F.lit(False)).cast("int")).over(by))
    reach = F.col("size") + 2 * band
    windows = met.groupBy("name", "subject", "window").agg(F.first("size").alias("size"), F.min("bin").alias("a"), F.max("bin").alias("b"))
    windows = windows.select("name.query", "name.strand", "subject", F.greatest(F.lit(0), F.col("a") * BIN - reach).alias("offset"), ((F.col("b") + 1) * BIN + reach).alias("stop"))
    cut = F.expr("substring(seq, cast(offset + 1 as int), cast(stop - offset as int))")
    texts = windows.join(s, "subject").select("query", "strand", "subject", "offset", cut.alias("text")).join(q, ["query", "strand"]).select("query", "strand", "subject", "offset", "text", "seq")
    kinds = dict(texts.dtypes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            for row, (offset, text, seq) in enumerate(zip(*(batch.column(i).to_pylist() for i in (3, 4, 5)), strict=True)):
                hit = compare(codes(seq), codes(text), offset, k + w - 1, band, gap)
                if hit:
                    rows.append(row)
                    out.append(hit)
            columns = zip(*out, strict=True) if out else ([],) * 7
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(pa.array(rows, pa.int64())) for i in (0, 1, 2)), *(pa.array(c, pa.int64()) for c in columns)], names=["query", "strand", "subject", "score", "cost", "aligned", "qstart", "qend", "sstart", "send"])

    hits = texts.mapInArrow(run, f"query {kinds['query']}, strand string, subject {kinds['subject']}, score long, cost long, aligned long, qstart long, qend long, sstart long, send long")
    rank = F.struct(-F.col("score"), F.col("strand"), F.col("qstart"), F.col("sstart"))
    best = hits.groupBy("query", "subject").agg(F.min_by(F.struct("strand", "score", "cost", "aligned", "qstart", "qend", "sstart", "send"), rank).alias("h")).select("query", "subject", "h.*")
    best = best.withColumn("identity", F.round(100 * (F.col("aligned") - F.col("cost")) / F.col("aligned"), 3))
    return best.where((F.col("identity") >= identity) & (F.col("aligned") >= least)).select("query", "subject", "strand", "identity", "aligned", "score", "qstart", "qend", "sstart", "send")
