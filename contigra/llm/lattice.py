"""Subword lattice likelihood.

An existing subword vocabulary (pieces with scores, read from a tokenizer file and never trained
here) gives unigram probabilities; the training words re-estimate them by one
expectation step over the lattice of all segmentations, with the vocabulary's own scores as
prior.  A word's probability is the sum over all its segmentations, by forward
recursion in log space over its bytes; single bytes are always pieces, so no word is impossible.
Pieces never cross words, so a document's marginal log probability is the sum over its
words and one end symbol.

Each distinct word is scored once.  At most ``hot`` of the most frequent words go to all tasks (a
parameter); the other words of a document meet their scores in a join by word.

Defined cases: A-Z are lower-cased and words are ``[^\\x20\\x09-\\x0D]+``; null, empty and blank texts
have the end as their only token; a null doc_id counts as held out (crc32 of no text is 0); repeated
rows are counted and scored each; an empty table gives an empty result; with nothing to train on all
counts are 0; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import repeat
from math import exp, log, log1p

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigra.llm.common import column_bytes, forget, mix, slices, words, write_shared

VOCABULARY = "piece_bpe_32k.model"
HOT = 150_000
PRIOR = 1000.0
FLUSH = 300_000
GATHERED, GATHERED_BYTES = 20_000, 8 << 20
CELLS = 200_000
#: Words of more bytes are read by ``LongLattice``, in blocks of BLOCK bytes.
LONG, BLOCK = 1024, 1 << 16
START = 0xFF  # stands for the word-start mark; never a byte of UTF-8
_P = np.uint64(0x9E3779B97F4A7C15 | 1)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class Vocabulary:
    """Pieces as byte strings, found by rolling hash."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        score: dict[bytes, float] = {}
        mark = "▁"
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
                continue
            piece = model.id_to_piece(i)
            if mark in piece[1:]:
                continue
            own = piece[1:].encode() if piece[0] == mark else piece.encode()
            own = bytes([START]) + own if piece[0] == mark else own
            # scores of this file are negated ranks: a Zipf law turns them to log probabilities
            score[own] = -np.log(2.7 - model.get_score(i))
        for c in range(256):
            score.setdefault(bytes([c]), -np.log(2.7 + 2 * model.get_piece_size()))
        self.pieces = sorted(score)
        self.longest = max(map(len, self.pieces))
        prior = np.exp(np.array([score[p] for p in self.pieces]))
        self.prior = prior / prior.sum()
        key = np.array([self._hash(p) for p in self.pieces], np.uint64)
        self.bits = 20
        self.slot = np.full((4, 1 << self.bits), -1, np.int32)
        self.key = key
        for n, k in enumerate(mix(key) >> np.uint64(64 - self.bits)):
            row = int(np.argmax(self.slot[:, k] < 0))
            if self.slot[row, k] >= 0:
                raise ValueError("too many pieces share a slot")
            self.slot[row, k] = n
        self.depth = int((self.slot >= 0).any(1).sum())
        #: whether a hash may be that of the beginning of a piece; never False for one that is
        self.begins = np.zeros(1 << 22, bool)
        heads = np.array([self._hash(h) for h in {p[:k] for p in self.pieces for k in range(1, len(p) + 1)}], np.uint64)
        self.begins[(mix(heads) >> np.uint64(42)).astype(np.int64)] = True

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = 0
        for c in piece:
            h = (h * int(_P) + c + 1) % (1 << 64)
        return h

    def find(self, h: np.ndarray, mixed: np.ndarray) -> np.ndarray:
        """The number of the piece of each hash, -1 if there is none."""
        at = (mixed >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.full(len(h), -1, np.int32)
        for row in self.slot[: self.depth]:
            n = row[at]
            hit = (n >= 0) & (self.key[n] == h)
            out[hit] = n[hit]
        return out

    def arcs(self, letters: np.ndarray, at: np.ndarray, stride: int = 1) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, starts, pieces) of the pieces that stand at the places ``at`` (ascending), for all places at once.

        ``letters`` are bytes plus one, 0 where a word has ended; a word's next letter stands ``stride`` places on.
        Places where no piece can begin that way any more are left out as the length grows.
        """
        h = np.zeros(len(at), np.uint64)
        for size in range(1, self.longest + 1):
            stop = int(np.searchsorted(at, len(letters) - stride * (size - 1)))
            at = at[:stop]
            letter = letters[at + stride * (size - 1)]
            h = h[:stop] * _P + letter
            mixed = mix(h)
            open_ = self.begins[(mixed >> np.uint64(42)).astype(np.int64)] & (letter > 0)
            at, h = at[open_], h[open_]
            if not len(at):
                return
            found = self.find(h, mixed[open_])
            hit = found >= 0
            yield size, at[hit], found[hit]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lattice:
    """All segmentations of words of similar length: one column a word."""

    def __init__(self, vocab: Vocabulary, rows: list[bytes]):
        self.vocab, self.n = vocab, len(rows)
        self.sizes = np.array([len(w) + 1 for w in rows])
        self.size = int(self.sizes.max())
        letters = np.frombuffer(b"".join(bytes([START]) + w.ljust(self.size - 1, b"\0") for w in rows), np.uint8).reshape(self.n, self.size).T.astype(np.uint64) + np.uint64(1)
        letters[np.arange(self.size)[:, None] >= self.sizes] = 0
        #: (from, to, columns, pieces) of the arcs
        self.arcs: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        for k, at, piece in vocab.arcs(letters.ravel(), np.arange(letters.size), self.n):
            edges = np.searchsorted(at, np.arange(self.size + 1) * self.n).tolist()
            self.arcs += [(i, i + k, at[a:b] - i * self.n, piece[a:b]) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if b > a]
        self.arcs.sort(key=lambda arc: (arc[1], arc[0]))

    def forward(self, logp: np.ndarray) -> np.ndarray:
        a = np.full((self.size + 1, self.n), -np.inf)
        a[0] = 0
        for i, j, at, piece in self.arcs:
            a[j, at] = np.logaddexp(a[j, at], a[i, at] + logp[piece])
        return a

    def total(self, logp: np.ndarray) -> np.ndarray:
        """The log probability of each word."""
        return self.forward(logp)[self.sizes, np.arange(self.n)]

    def expected(self, logp: np.ndarray, counts: np.ndarray, out: np.ndarray) -> None:
        """Add to ``out`` how often each piece is expected in the words, ``counts`` times each."""
        a = self.forward(logp)
        total = a[self.sizes, np.arange(self.n)]
        b = np.full_like(a, -np.inf)
        b[self.sizes, np.arange(self.n)] = 0
        pieces, shares = [], []
        for i, j, at, piece in reversed(self.arcs):
            step = logp[piece] + b[j, at]
            pieces.append(piece)
            shares.append(counts[at] * np.exp(a[i, at] + step - total[at]))
            b[i, at] = np.logaddexp(b[i, at], step)
        out += np.bincount(np.concatenate(pieces), np.concatenate(shares), len(out))


class LongLattice:
    """All segmentations of one long word, read in blocks; between blocks only the last ``longest`` sums are kept."""

    def __init__(self, vocab: Vocabulary, word: bytes):
        self.vocab, self.letters = vocab, np.frombuffer(bytes([START]) + word, np.uint8)
        self.stops = [*range(BLOCK, len(self.letters), BLOCK), len(self.letters)]

    def _arcs(self, low: int, high: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        """The first place of a block's arcs; starts and ends from there, and pieces, of the arcs that end in (low, high], by end."""
        base = max(0, low + 1 - self.vocab.longest)
        letters = self.letters[base:high].astype(np.uint64) + np.uint64(1)
        found = [(at, at + k, piece) for k, at, piece in self.vocab.arcs(letters, np.arange(len(letters)))]
        start, end, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((start, end))
        order = order[np.searchsorted(end[order], low - base, side="right") :]
        return base, start[order], end[order], piece[order]

    @staticmethod
    def _forward(held: list[float], start: np.ndarray, end: np.ndarray, step: np.ndarray, stop: int) -> list[float]:
        """``held`` (sums of the places up to the block) with the sums of the block's places up to ``stop``."""
        a = list(held)
        edges = np.searchsorted(end, np.arange(len(a), stop + 2)).tolist()
        starts, steps = start.tolist(), step.tolist()
        for p, q in zip(edges, edges[1:], strict=False):
            if q - p == 1:
                a.append(a[starts[p]] + steps[p])
                continue
            ways = [a[i] + s for i, s in zip(starts[p:q], steps[p:q], strict=True)]
            most = max(ways)
            a.append(most + log(sum([exp(x - most) for x in ways])))
        return a

    def _blocks(self, logp: np.ndarray) -> Iterator[tuple[int, int, list[float], list[float]]]:
        """(low, high, sums held before the block, sums up to its end) for all blocks in order."""
        held, low = [0.0], 0
        for high in self.stops:
            base, start, end, piece = self._arcs(low, high)
            a = self._forward(held, start, end, logp[piece], high - base)
            yield low, high, held, a
            held, low = a[max(0, high + 1 - self.vocab.longest) - base :], high

    def total(self, logp: np.ndarray) -> float:
        for *_, a in self._blocks(logp):
            pass
        return a[-1]

    def expected(self, logp: np.ndarray, count: float, out: np.ndarray) -> None:
        """Like ``Lattice.expected``; the sums of a block are made again when the way back comes to it."""
        blocks = []
        for low, high, held, a in self._blocks(logp):
            blocks.append((low, high, held))
        total, back = a[-1], [0.0]
        for low, high, held in reversed(blocks):
            base, start, end, piece = self._arcs(low, high)
            step = logp[piece]
            a = self._forward(held, start, end, step, high - base)
            # ``back`` has the places [high + 1 - len(back), high]; those below get their first arcs here
            b = [-np.inf] * (high - base + 1 - len(back)) + back
            for i, j, s in zip(reversed(start.tolist()), reversed(end.tolist()), reversed(step.tolist()), strict=True):
                x, y = b[i], s + b[j]
                if x < y:
                    x, y = y, x
                b[i] = x + log1p(exp(y - x))
            out += np.bincount(piece, count * np.exp(np.array(a)[start] + step + np.array(b)[end] - total), len(out))
            back = b[: low - base + 1]


def lattices(vocab: Vocabulary, rows: list[bytes]) -> Iterator[tuple[np.ndarray, Lattice]]:
    """(indices, lattice) for words of LONG bytes at most, in groups of similar length and bounded size; empty words are left out."""
    at = sorted((n for n, w in enumerate(rows) if 0 < len(w) <= LONG), key=lambda n: len(rows[n]))
    k = 0
    while k < len(at):
        least, stop = len(rows[at[k]]), k + 1
        while stop < len(at) and (size := len(rows[at[stop]])) <= least + least // 8 and size * (stop - k + 1) <= CELLS:
            stop += 1
        yield np.array(at[k:stop]), Lattice(vocab, [rows[n] for n in at[k:stop]])
        k = stop


def long_words(vocab: Vocabulary, rows: list[bytes]) -> Iterator[tuple[int, LongLattice]]:
    """(index, lattice) for the other words."""
    return ((n, LongLattice(vocab, w)) for n, w in enumerate(rows) if len(w) > LONG)


def gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches put together to GATHERED rows or GATHERED_BYTES: lattices need many words of one length."""
    held, rows, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= GATHERED or size >= GATHERED_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows, size = [], 0, 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def word_counts(docs: DataFrame) -> DataFrame:
    """word, c: how often training documents hold each word of any document; the end symbol is the empty word."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train, rest, ends = Counter(), set(), 0

        def flush() -> pa.RecordBatch:
            own = list(train) + [w for w in rest if w not in train]
            return pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), pa.array([train[w] for w in own], pa.int64())], names=["word", "c"])

        for batch in slices(batches, "text", 2 << 20):
            for i, t in zip(batch.column(0).to_pylist(), column_bytes(batch, "text"), strict=True):
                if held_out(i):
                    rest.update(words(t))
                else:
                    train.update(words(t))
                    ends += 1
            if len(train) + len(rest) > FLUSH:
                yield flush()
                train, rest = Counter(), set()
        train[b""] += ends
        yield flush()

    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "word binary, c long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


def piece_probabilities(counts: DataFrame, path: str) -> np.ndarray:
    """Log probabilities of the pieces and, last, of the end symbol."""
    size = len(vocabulary(path).pieces)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, out = vocabulary(path), np.zeros(size)
        logp = np.log(vocab.prior)
        for batch in gathered(batches):
            rows, c = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for at, lattice in lattices(vocab, rows):
                lattice.expected(logp, c[at].astype(float), out)
            for n, lattice in long_words(vocab, rows):
                lattice.expected(logp, float(c[n]), out)
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(out[at])], names=["piece", "n"])

    got = np.zeros(size)
    for r in counts.where("c > 0 and length(word) > 0").mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect():  # one a piece
        got[r["piece"]] = r["n"]
    ends = counts.where("length(word) = 0").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    return np.log(np.concatenate((got + PRIOR * vocabulary(path).prior, [ends + 1.0])) / (got.sum() + PRIOR + ends + 1.0))


def frequent(known: DataFrame, hot: int) -> DataFrame:
    """The rows of the most frequent words, ``hot`` at most, and of the end symbol.

    Words are taken by bands of counts (eight to a doubling) as long as whole bands fit.  The bands' sizes are a few
    hundred numbers, so nothing is sorted, and no task sends more than its share of the chosen words.
    """
    band = F.floor(8 * F.log2(F.greatest("c", F.lit(1))))
    sizes = known.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n")).collect()  # 8 x 63 rows at most
    least, held = 8 * 64, 0
    for r in sorted(sizes, key=lambda r: -r["band"]):
        held += r["n"]
        if held > hot:
            break
        least = r["band"]
    return known.where((band >= least) | (F.length("word") == 0))


def score(docs: DataFrame, path: str | None = None, hot: int = HOT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row a row of ``docs``."""
    path = path or default_vocabulary()
    spark = docs.sparkSession
    counts = write_shared(word_counts(docs), "lattice-counts")
    logp = piece_probabilities(counts, path)
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, True))).first()
    n, v = int(total[0]), int(total[1])
    pieces = spark.sparkContext.broadcast(logp)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, own = vocabulary(path), pieces.value
        for batch in gathered(batches):
            rows, out = batch.column(0).to_pylist(), np.full(batch.num_rows, own[-1])
            for at, lattice in lattices(vocab, rows):
                out[at] = lattice.total(own)
            for n, lattice in long_words(vocab, rows):
                out[n] = lattice.total(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)], names=["word", "c", "lp"])

    known = write_shared(counts.mapInArrow(run, "word binary, c long, lp double"), "lattice-words")
    forget(counts)
    top = frequent(known, hot).toPandas()  # ``hot`` rows and the end at most
    index = {bytes(w): k for k, w in enumerate(top["word"])}
    index.setdefault(b"", len(top))
    c = np.append(top["c"].to_numpy(np.int64), 0)
    lp = np.append(top["lp"].to_numpy(float), logp[-1])
    sent = spark.sparkContext.broadcast((index, np.log10(c + 0.1), lp, c > 0))

    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, base, lp, known = sent.value
        at, place = TaskContext.get().partitionId() << 40, 0
        get, end = index.get, index[b""]
        for batch in slices(batches, "text", 2 << 20):
            rows: list[tuple] = []
            for i, t in zip(batch.column(0).to_pylist(), column_bytes(batch, "text"), strict=True):
                own = words(t)
                k = np.fromiter(map(get, own, repeat(-1)), np.int64, len(own))
                hit = k[k >= 0]
                rows.append((at + place, i, True, len(own) + 1, int(known[hit].sum() + known[end]), float(base[hit].sum() + base[end]), float(lp[hit].sum() + lp[end]), None, 0))
                if len(hit) < len(own):
                    rows += [(at + place, None, False, 0, 0, 0.0, 0.0, w, m) for w, m in Counter([own[x] for x in np.flatnonzero(k < 0)]).items()]
                place += 1
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["row_", "doc_id", "head", "n_tokens", "n_known", "base", "lp", "word", "m"])

    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held = write_shared(thin.mapInArrow(parts, "row_ long, doc_id long, head boolean, n_tokens long, n_known long, base double, lp double, word binary, m long"), "lattice-parts")
    rare = held.where("not head").select("row_", "word", "m").join(known, "word").select("row_", F.when(F.col("c") > 0, F.col("m")).otherwise(0).alias("n_known"), (F.col("m") * F.log10(F.col("c") + 0.1)).alias("base"), (F.col("m") * F.col("lp")).alias("lp"))
    rare = rare.groupBy("row_").agg(F.sum("n_known").alias("rk"), F.sum("base").alias("rb"), F.sum("lp").alias("rl"))
    heads = held.where("head").drop("word", "m", "head")
    out = heads.join(rare, "row_", "left")
    size = float(np.log10(n + 0.1 * (v + 1)))
    return out.select(
        "doc_id", (F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(10)) == 0).alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("rk", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("rb", F.lit(0.0)) - F.col("n_tokens") * F.lit(size)).alias("base_score"), ((F.col("lp") + F.coalesce("rl", F.lit(0.0))) / F.lit(float(np.log(10)))).alias("score"),
    )
