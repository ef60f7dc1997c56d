"""Packing token sequences by a configuration linear program.

A configuration is a multiset of lengths that fits one sequence.  The covering program
(every length as often as it occurs, fewest configurations) is solved over the histogram of
lengths by multiplicative weights: a length's weight falls as the share of it that is
covered grows, and near-best configurations are found by a knapsack dynamic programme that
takes no length more often than it occurs.  Rounds of pricing spend the histogram on fractions of
configurations; where their number is still further from the bound that prices prove, multiplicative steps on prices and
amounts and more pricing close the gap.  Amounts are rounded down and up as far as the histogram allows, what
is left is solved and rounded again, and the last few per cent go best-fit into the room left.
The histogram has one entry a length, so its size does not
grow with the table; rows learn their place by their rank among pieces of their length.

Defined cases: null text is empty; every document ends with the end id, so an empty one is
one piece of length 1; documents longer than the capacity give full pieces and a last
one; null or repeated doc_id and repeated rows are packed like any others; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import logging
import math
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contigra.llm.common import column_bytes, slices, write_shared

CAPACITY = 4096
END_ID = 1
GAP, PATIENCE = 0.005, 5
REST = 0.02
SPARED = (0.0, 0.01, 0.02, 0.03, 0.04)
CACHED, KEPT = 300_000, 100_000
TOKENIZER = "word_bpe_49k.json"

log = logging.getLogger(__name__)

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part_ long, local_ long"


# ---------------------------------------------------------------- token ids


class CachedTokenizer:
    """Ids of a text by way of its chunks between ASCII white space.

    The tokenizer's patterns never cross white space, so the ids of a text are those of
    its chunks in order.  Chunks met before are looked up; beyond ``CACHED`` chunks the cache goes
    back to the ``KEPT`` that came first, among which are the frequent ones.
    """

    #: The tokenizer's own pre-token pattern (a fixed value).
    PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for k, i in vocab.items() if k.endswith("</w>")]] = True
        self.index: defaultdict[bytes, int] = defaultdict(count().__next__)  # numbers chunks as they come
        self.known = 0  # those whose ids are stored
        self.ids, self.used = np.empty(1 << 16, np.uint32), 0
        self.start, self.length = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)

    def _shrink(self) -> None:
        self.index = defaultdict(count(KEPT).__next__, islice(self.index.items(), KEPT))
        self.known, self.used = KEPT, int(self.start[KEPT])
        self.ids, self.start, self.length = self.ids[: max(self.used, 1 << 16)].copy(), self.start[:KEPT].copy(), self.length[:KEPT].copy()

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: list[bytes]) -> None:
        """Append the ids of ``chunks``, which the index has numbered in this order."""
        for a in range(0, len(chunks), 1000):
            group = b" ".join(chunks[a : a + 1000]).decode("utf-8", "surrogatepass")
            parts = group.split(" ")
            # below U+0130 normal forms and letter case map one to one, so pre-tokens can be counted beforehand
            if max(group) < "\u0130" and "<|" not in group:
                ids = np.array(self._encode([group])[0], np.uint32)
                each = np.array([1 if s.isalpha() else len(self.PRETOKEN.findall(s)) for s in parts])
                at = np.flatnonzero(self.ends[ids]) + 1
                if len(at) == each.sum():
                    self._add(ids, np.diff(np.concatenate(([0], at))[np.cumsum(each)], prepend=0))
                    continue
            each = self._encode(parts)
            self._add(np.array([i for x in each for i in x], np.uint32), np.array([len(x) for x in each], np.int64))

    def _add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        n, k = self.known, len(lengths)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty_like(self.ids)))
        while n + k > len(self.start):
            self.start, self.length = (np.concatenate((x, np.empty_like(x))) for x in (self.start, self.length))
        self.ids[self.used : self.used + len(ids)] = ids
        self.start[n : n + k] = self.used + np.cumsum(lengths) - lengths
        self.length[n : n + k] = lengths
        self.used += len(ids)
        self.known += k

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The ids of each text, as unsigned 32-bit numbers."""
        if len(self.index) > CACHED:
            self._shrink()
        get = self.index.__getitem__
        split = [np.fromiter(map(get, chunks), np.int64, len(chunks)) for chunks in map(bytes.split, texts)]
        if new := len(self.index) - self.known:
            self._learn(list(islice(reversed(self.index), new))[::-1])
        for at in split:
            length = self.length[at]
            stop = np.cumsum(length)
            total = int(stop[-1]) if len(stop) else 0
            place = np.repeat(self.start[at] - stop + length, length) + np.arange(total)
            yield self.ids[place]


_tokenizers: dict[str, CachedTokenizer] = {}


def tokenizer(path: str) -> CachedTokenizer:
    """One tokenizer for each worker and path; reused workers keep what it has cached."""
    if path not in _tokenizers:
        _tokenizers[path] = CachedTokenizer(path)
    return _tokenizers[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of each document, with the partition they come from and their rank of their length there."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen, part = tokenizer(path), np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        end = np.array([END_ID], np.uint32)
        for batch in slices(batches, "text", 2 << 20):
            texts = [t or b"" for t in column_bytes(batch, "text")]
            doc, piece, start, length, crc, local = [], [], [], [], [], []
            for row, ids in enumerate(encoder.encode(texts)):
                ids = np.concatenate((ids, end)).astype("<u4")
                for k, a in enumerate(range(0, len(ids), capacity)):
                    own = ids[a : a + capacity]
                    doc.append(row)
                    piece.append(k)
                    start.append(a)
                    length.append(len(own))
                    crc.append(zlib.crc32(own.data))
                    local.append(int(seen[len(own)]))
                    seen[len(own)] += 1
            ids = batch.column(0).take(pa.array(doc, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc, [part] * len(doc), local))],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part_", "local_"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


# ---------------------------------------------------------------- the linear program


def price(lengths: np.ndarray, gains: np.ndarray, bound: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Knapsack dynamic programme: for each of the ascending ``lengths`` the best configuration in which it is the longest.

    No configuration holds a length more than ``bound`` times.  Copies are items of 1, 2, 4, ... of them; of equal
    gains the one with longer pieces is taken.  (gain of each, start of each in the next two, indices of lengths, counts).
    """
    size, times, of, first = [], [], [], []
    for i, (x, b) in enumerate(zip(lengths.tolist(), np.minimum(bound, capacity // lengths).tolist(), strict=True)):
        rest, k = int(b) - 1, 1
        while rest > 0:
            t = min(k, rest)
            size.append(x * t)
            times.append(t)
            of.append(i)
            rest, k = rest - t, 2 * k
        first.append(len(size))  # the copy that makes this length the longest comes last
        size.append(x)
        times.append(1)
        of.append(i)
    size, times, of, first = (np.array(x, np.int64) for x in (size, times, of, first))
    gain = (gains[of] * times).tolist()
    value, last = np.zeros(capacity + 1), np.zeros((len(size) + 1, capacity + 1), np.int16 if len(size) < 1 << 15 else np.int32)
    best = np.empty(len(size))
    for k, s in enumerate(size.tolist()):
        best[k] = value[capacity - s] + gain[k]
        row, new, old = last[k + 1], value[: capacity + 1 - s] + gain[k], value[s:]
        row[:] = last[k]
        better = new >= old
        np.copyto(old, new, where=better)
        np.copyto(row[s:], k + 1, where=better)
    p, at, room = np.arange(len(lengths)), first, capacity - lengths
    found = [(p, p, np.ones(len(p), np.int64))]
    while len(p):  # all configurations are read back together, an item a step
        j = last[at, room].astype(np.int64)
        on = j > 0
        p, at, room = p[on], j[on] - 1, room[on]
        found.append((p, of[at], times[at]))
        room = room - size[at]
    own, item, n = (np.concatenate(x) for x in zip(*found, strict=True))
    key, inverse = np.unique(own * len(lengths) + item, return_inverse=True)
    return best[first], np.searchsorted(key, np.arange(len(lengths) + 1) * len(lengths)), key % len(lengths), np.bincount(inverse, n, len(key)).astype(np.int64)


class Program:
    """The covering program over a histogram, its configurations so far and how many of each are taken (a fraction)."""

    def __init__(self, need: np.ndarray, capacity: int):
        self.capacity, self.lengths = capacity, np.flatnonzero(need)
        self.need = need[self.lengths].astype(np.int64)
        self.number: dict[bytes, int] = {}
        self.items: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.taken: list[float] = []
        self.lower, self.value = 0.0, 0.0

    def add(self, items: np.ndarray, counts: np.ndarray, taken: float) -> bool:
        """Whether the configuration is a new one."""
        key = items.tobytes() + counts.tobytes()
        new = key not in self.number
        if new:
            self.number[key] = len(self.taken)
            self.items.append(items)
            self.counts.append(counts)
            self.taken.append(0.0)
        self.taken[self.number[key]] += taken
        return new

    def bound(self, prices: np.ndarray) -> tuple[float, tuple]:
        """What the prices prove of the program's value, and what the knapsack found at them."""
        priced = price(self.lengths, prices, self.need, self.capacity)
        return float(self.need @ prices / priced[0].max()), priced

    def spend(self, share: float = 0.9, eta: float = 0.5, slack: float = 0.01, rest: float = 0.001) -> None:
        """Cover the histogram by rounds of pricing: a length's weight falls with the share of it that is covered.

        Each round takes near-best configurations as far as none uses more than ``share`` of what is left of a shorter length.
        """
        left, total = self.need.astype(float), float(self.lengths @ self.need)
        for _ in range(len(left) + 64):
            if self.lengths @ left <= rest * total:
                break
            on = np.flatnonzero(left > 1e-9)
            own = left[on]
            best, start, item, count_ = price(self.lengths[on], self.lengths[on] * np.exp(-eta * (1 - own / self.need[on])), np.ceil(own), self.capacity)
            used, most = np.zeros(len(on)), share * own
            for x in np.flatnonzero(best >= (1 - slack) * best.max())[::-1].tolist():
                i, k = item[start[x] : start[x + 1]], count_[start[x] : start[x + 1]]
                room = (most[i] - used[i]) / k
                room[-1] = (own[x] - used[x]) / k[-1]
                if (n := float(room.min())) > 1e-9:
                    used[i] += k * n
                    self.add(on[i], k, n)
            left[on] = np.maximum(own - used, 0)
        for x in np.flatnonzero(left > 1e-9).tolist():  # what is left over has configurations of its own
            k = int(min(self.need[x], self.capacity // self.lengths[x]))
            self.add(np.array([x]), np.array([k]), left[x] / k)
        self.value = sum(self.taken)

    def solve(self, gap: float, patience: int, step: float = 0.3, sweep: int = 100) -> np.ndarray:
        """How much of each configuration is taken, within ``gap`` or one sequence of the optimum.

        Prices of lengths grow with what is uncovered of them and amounts of configurations with their worth at these
        prices, both multiplicatively and with a step looked ahead; pricing adds configurations and proves the bound.
        Ends as well when neither bound nor value has moved for ``patience`` rounds of pricing.
        """
        self.spend()
        best = x = np.array(self.taken)
        self.lower, priced = self.bound(self.lengths.astype(float))
        prices = centre = self.lengths / priced[0].max()
        idle = 0
        while self.value > max(self.lower * (1 + gap), self.lower + 1) and idle < patience:
            sizes = np.array([len(i) for i in self.items])
            row, col, k = np.repeat(np.arange(len(sizes)), sizes), np.concatenate(self.items), np.concatenate(self.counts).astype(float)
            start = np.cumsum(sizes) - sizes
            x = np.maximum(np.pad(x, (0, len(sizes) - len(x))), 1e-4 * self.lower / len(sizes))

            def moves(x, prices, row=row, col=col, k=k, start=start):
                worth, cover = np.add.reduceat(k * prices[col], start), np.bincount(col, k * x[row], len(prices)) / self.need
                return np.exp(step * np.clip(worth - 1, -2, 2)), np.exp(step * np.clip(1 - cover, -2, 2))

            mean = np.zeros(len(x))
            for _ in range(sweep):
                up, dear = moves(x, prices)
                ahead = x * up
                up, dear = moves(ahead, prices * dear)
                x, prices = x * up, prices * dear
                mean += ahead / sweep
            before = self.lower, self.value
            for taken in (x, mean):
                short = np.maximum(self.need - np.bincount(col, k * taken[row], len(prices)), 0)
                value = float(taken.sum() + (short / np.minimum(self.need, self.capacity // self.lengths)).sum())
                if value < self.value:
                    self.value, best = value, taken
            for mixed in (prices, (prices + centre) / 2):
                lower, (worth, first, item, count_) = self.bound(mixed)
                if lower > self.lower:
                    self.lower, centre = lower, mixed / worth.max()
                for i in np.flatnonzero(worth >= 0.999 * min(1.0, worth.max())).tolist():
                    self.add(item[first[i] : first[i + 1]], count_[first[i] : first[i + 1]], 0.0)
            idle = idle + 1 if self.value > before[1] * 0.9999 and self.lower < before[0] * 1.0001 else 0
        return best


Held = list[tuple[list[tuple[int, int]], int]]


def rounded(need: np.ndarray, program: Program, taken: np.ndarray, least: float = 0.25) -> Held:
    """Whole copies: each amount rounded down, then one more, greatest fractions first, as far as ``need`` allows; need is lowered."""
    out: dict[int, int] = {}
    amounts = [(math.floor(x + 1e-9), x - math.floor(x + 1e-9), p) for p, x in enumerate(taken.tolist())]
    for step in ([(n, p) for n, _, p in amounts if n], [(1, p) for _, f, p in sorted(amounts, key=lambda a: (-a[1], a[2])) if f >= least]):
        for n, p in step:
            at, k = program.lengths[program.items[p]], program.counts[p]
            n = min(n, int((need[at] // k).min()))
            if n > 0:
                need[at] -= k * n
                out[p] = out.get(p, 0) + n
    return [(list(zip(program.lengths[program.items[p]][::-1].tolist(), program.counts[p][::-1].tolist(), strict=True)), n) for p, n in out.items()]


def plan(histogram: np.ndarray, capacity: int = CAPACITY, patience: int = PATIENCE, gap: float = GAP) -> Held:
    """[(lengths with their counts, copies of this configuration)], covering the histogram exactly.

    histogram[l]: pieces of length l.  The program is solved and rounded, then solved and rounded again on what
    is left, until rounding stalls; the remainder goes best-fit into the room that is left.  Plans that keep the shortest pieces, by
    the shares ``SPARED`` of the tokens, out of the program and for that room are tried until one needs no more sequences than
    the bound.  The plan of fewest sequences is taken, best-fit decreasing alone among them, so none needs more than that.
    """
    need, size = histogram.astype(np.int64).copy(), np.arange(capacity + 1)
    whole: Held = [([(capacity, 1)], int(need[capacity]))] if need[capacity] else []
    need[capacity] = 0
    total = int(need @ size)
    if not total:
        return whole
    best, lower, value = None, 0.0, 0.0
    for spared in SPARED:
        kept = np.minimum(need, np.diff(np.minimum(np.cumsum(need * size), int(spared * total)), prepend=0) // np.maximum(size, 1))
        left, held = need - kept, []
        while left.any():
            program = Program(left, capacity)
            taken = program.solve(gap, patience if best is None and not held else 0)
            if best is None and not held:
                lower, value = program.lower, program.value
            before = int(left @ size)
            held += rounded(left, program, taken)
            if int(left @ size) <= REST * total or int(left @ size) > 0.8 * before:
                break
        share = 1 - int((left + kept) @ size) / total
        own = best_fit(left + kept, capacity, held)
        n = sum(copies for _, copies in own)
        if best is None or n < best[0]:
            best = n, share, own
        if n <= math.ceil(lower - 1e-6):
            break
    plain = best_fit(need, capacity)
    if (n := sum(copies for _, copies in plain)) < best[0]:
        best = n, 0.0, plain
    log.info("packing: program %.2f, proven bound %.2f; %d sequences (best-fit decreasing alone: %d), %.4f of the tokens placed by the program", value, lower, best[0], n, best[1])
    return whole + best[2]


def best_fit(left: np.ndarray, capacity: int, held: Held = ()) -> Held:
    """Best-fit decreasing on counts, into the room that ``held`` leaves or new sequences; those that hold the same lengths are one group."""
    groups: dict[int, list[tuple[list[tuple[int, int]], int]]] = defaultdict(list)  # by room
    for config, copies in held:
        groups[capacity - sum(x * k for x, k in config)].append((config, copies))
    rooms = sum(1 << r for r in groups)  # bit r: there is a group with room r
    for x in np.flatnonzero(left)[::-1].tolist():
        n = int(left[x])
        while n:
            fits = rooms >> x
            if not fits:
                each = min(capacity // x, n)
                made, room, copies, config = n // each, capacity, n // each, []
            else:
                room = x + (fits & -fits).bit_length() - 1
                config, copies = groups[room].pop()
                if not groups[room]:
                    rooms ^= 1 << room
                each = min(room // x, n)
                made = min(copies, n // each)
            if copies > made:
                groups[room].append((config, copies - made))
                rooms |= 1 << room
            groups[room - x * each].append(([*config, (x, each)], made))
            rooms |= 1 << room - x * each
            n -= each * made
    return [g for room in sorted(groups) for g in groups[room]]


def runs(configurations: list[tuple[list[tuple[int, int]], int]], histogram: np.ndarray) -> dict[str, np.ndarray]:
    """Where the pieces go, by rank among all pieces ordered by length: parallel arrays, one entry a run."""
    base = np.cumsum(histogram) - histogram
    used = np.zeros(len(histogram), np.int64)
    rows, sequence = [], 0
    for held, copies in configurations:
        offset = 0
        for x, k in held:
            rows.append((base[x] + used[x], sequence, k, offset, x))
            used[x] += k * copies
            offset += x * k
        sequence += copies
    table = np.array(rows, np.int64).reshape(-1, 5)
    table = table[np.argsort(table[:, 0], kind="stable")]
    return dict(zip(("first", "sequence", "each", "offset", "length"), table.T, strict=True))


# ---------------------------------------------------------------- the operator


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row a piece."""
    held = write_shared(cut(docs, path or default_tokenizer(), capacity), "pack-pieces")
    counts = write_shared(held.groupBy("part_", "length").agg(F.count(F.lit(1)).alias("n_")), "pack-counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n_").alias("n_")).collect():  # ``capacity`` rows at most
        histogram[r["length"]] = r["n_"]
    table = runs(plan(histogram, capacity), histogram)
    base = np.cumsum(histogram) - histogram
    sent = docs.sparkSession.sparkContext.broadcast((table, base))  # by lengths and configurations, not by rows
    before = F.sum("n_").over(Window.partitionBy("length").orderBy("part_").rowsBetween(Window.unboundedPreceding, -1))
    ranks = counts.select("part_", "length", F.coalesce(before, F.lit(0)).cast("long").alias("before_"))

    def place(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        table, base = sent.value
        for pdf in batches:
            x = pdf["length"].to_numpy()
            rank = base[x] + pdf["before_"].to_numpy() + pdf["local_"].to_numpy()
            i = np.searchsorted(table["first"], rank, side="right") - 1
            k = rank - table["first"][i]
            pdf["sequence_id"] = table["sequence"][i] + k // table["each"][i]
            pdf["offset"] = table["offset"][i] + k % table["each"][i] * x
            yield pdf[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    joined = held.join(ranks.hint("merge"), ["part_", "length"])  # it grows with the partitions, so it is never broadcast
    return joined.mapInPandas(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
