"""Token counts that follow edits.

A document's pre-tokens are the leaves of a segment tree that sums characters and tokens.
Leaves stand in buckets; the bucket sums carry a binary tree of partial sums.  An edit
finds its leaf by descending the character sums, re-reads pre-tokens from a few leaves
before the edit until they fall in with old boundaries again behind it, encodes only those, puts them in place
of the old ones, and renews the sums on the way to the root.

Defined cases: null text counts as empty; positions beyond the text mean its end and deletions stop there; edits of
a document apply in order; an edit for an unknown or null doc_id changes nothing; repeated rows
are counted each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contigra.llm.common import slices, write_shared

VOCABULARY = "byte_bpe_50k.tiktoken"
CONTEXT = 2
BUCKET = 64
CACHED = 300_000
#: Production edits of the query: (numerator, denominator) of the place, characters deleted, text inserted.
EDITS = (((1, 3), 0, " an inserted phrase,"), ((1, 2), 7, ""), ((2, 3), 5, "Xy z"))

_STATE = "n_pretokens long, n_tokens long"
_TREE = f"doc_id long, text string, {_STATE}, leaf_chars binary, leaf_tokens binary"
_EDIT = "array<struct<ordinal:int,at:bigint,delete:bigint,insert:string>>"


def pack_leaves(x: np.ndarray) -> bytes:
    """Leaf numbers for keeping: one byte each below 255; a 255 stands for one of the long numbers at the end, in order."""
    small = np.minimum(x, 255).astype(np.uint8)
    return len(x).to_bytes(8, "little") + small.tobytes() + x[small == 255].astype("<i8").tobytes()


def unpack_leaves(kept: bytes) -> np.ndarray:
    n = int.from_bytes(kept[:8], "little")
    x = np.frombuffer(kept, np.uint8, n, 8).astype(np.int64)
    x[x == 255] = np.frombuffer(kept, "<i8", -1, 8 + n)
    return x


class PreTokenCounts(dict):
    """Tokens of a pre-token, encoded once; starts anew when it holds CACHED of them."""

    def __init__(self, ranks: str):
        super().__init__()
        import public_tokenizers
        import tiktoken

        pairs = (line.split() for line in open(ranks, "rb"))
        table = {base64.b64decode(a): int(b) for a, b in pairs}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.split = regex.compile(public_tokenizers.PATTERN)

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self.encoding.encode_ordinary(piece))
        return n


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


@lru_cache(maxsize=2)
def counter(ranks: str) -> PreTokenCounts:
    return PreTokenCounts(ranks)


class CountTree:
    """The segment tree of one text."""

    def __init__(self, text: str, counts: PreTokenCounts, leaves: tuple[np.ndarray, np.ndarray] | None = None):
        self.text, self.counts = text, counts
        if len(counts) > CACHED:
            counts.clear()
        if leaves is None:
            pieces = counts.split.findall(text)
            leaves = np.fromiter(map(len, pieces), np.int64, len(pieces)), np.fromiter(map(counts.__getitem__, pieces), np.int64, len(pieces))
        n = len(leaves[0])
        stops = range(0, n, BUCKET)
        self.chars = [leaves[0][a : a + BUCKET] for a in stops] or [np.empty(0, np.int64)]
        self.tokens = [leaves[1][a : a + BUCKET] for a in stops] or [np.empty(0, np.int64)]
        starts = np.arange(0, n, BUCKET)
        sums = np.array([np.add.reduceat(x, starts) for x in leaves]) if n else np.zeros((2, 1), np.int64)
        self.reencoded = 0
        self._grow(sums)

    def _grow(self, sums: np.ndarray) -> None:
        self.levels = [sums]
        while sums.shape[1] > 1:
            if sums.shape[1] % 2:
                sums = np.concatenate((sums, np.zeros((2, 1), np.int64)), axis=1)
                self.levels[-1] = sums
            sums = sums[:, ::2] + sums[:, 1::2]
            self.levels.append(sums)

    @property
    def n_tokens(self) -> int:
        return int(self.levels[-1][1, 0])

    @property
    def n_pretokens(self) -> int:
        return sum(map(len, self.chars))

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(self.chars), np.concatenate(self.tokens)

    def find(self, char: int) -> tuple[int, int, int]:
        """(bucket, leaf in it, start of the leaf) for a character; the last leaf for the end of the text."""
        node, before = 0, 0
        for level in reversed(self.levels[:-1]):
            node *= 2
            if char >= before + level[0, node] and node + 1 < level.shape[1] and level[0, node + 1]:
                before += int(level[0, node])
                node += 1
        ends = np.cumsum(self.chars[node])
        leaf = min(int(np.searchsorted(ends, char - before, side="right")), max(0, len(ends) - 1))
        return node, leaf, before + (int(ends[leaf - 1]) if leaf else 0)

    def _back(self, bucket: int, leaf: int, start: int, steps: int) -> tuple[int, int, int]:
        for _ in range(steps):
            while leaf == 0 and bucket > 0:
                bucket -= 1
                leaf = len(self.chars[bucket])
            if leaf == 0:
                break
            leaf -= 1
            start -= int(self.chars[bucket][leaf])
        return bucket, leaf, start

    def edit(self, at: int, delete: int, insert: str) -> None:
        """Delete ``delete`` characters at ``at`` and put ``insert`` there."""
        at = min(max(at, 0), len(self.text))
        delete = min(max(delete, 0), len(self.text) - at)
        old = len(self.text)
        self.text = self.text[:at] + insert + self.text[at + delete :]
        shift, edge = len(insert) - delete, at + len(insert)
        bucket, leaf, start = self._back(*self.find(max(at - 1, 0)), CONTEXT) if old else (0, 0, 0)
        last, last_leaf, old_start = bucket, leaf, start  # the first old leaf that stays
        chars: list[int] = []
        tokens: list[int] = []
        for m in self.counts.split.finditer(self.text, start):
            while old_start + shift < m.start() or old_start < at + delete:
                if last_leaf >= len(self.chars[last]):
                    if last + 1 >= len(self.chars):
                        break
                    last, last_leaf = last + 1, 0
                    continue
                old_start += int(self.chars[last][last_leaf])
                last_leaf += 1
            if m.start() >= edge and old_start + shift == m.start() and old_start < old:
                break
            chars.append(m.end() - m.start())
            tokens.append(self.counts[m.group()])
        else:
            last, last_leaf = len(self.chars) - 1, len(self.chars[-1])
        self.reencoded += len(chars)
        self._replace(bucket, leaf, last, last_leaf, np.array(chars, np.int64), np.array(tokens, np.int64))

    def _replace(self, first: int, leaf: int, last: int, last_leaf: int, chars: np.ndarray, tokens: np.ndarray) -> None:
        new = [np.concatenate((own[first][:leaf], x, own[last][last_leaf:])) for own, x in ((self.chars, chars), (self.tokens, tokens))]
        if first == last and len(new[0]) <= 2 * BUCKET:
            self.chars[first], self.tokens[first] = new
            change = np.array([x.sum() for x in new]) - self.levels[0][:, first]
            for level in self.levels:
                level[:, first] += change
                first //= 2
            return
        stops = range(0, len(new[0]), BUCKET)
        self.chars[first : last + 1] = [new[0][a : a + BUCKET] for a in stops] or [np.empty(0, np.int64)]
        self.tokens[first : last + 1] = [new[1][a : a + BUCKET] for a in stops] or [np.empty(0, np.int64)]
        self._grow(np.array([[x.sum() for x in own] for own in (self.chars, self.tokens)]))


def _rows(df: DataFrame, schema: str, row: Callable[..., tuple], kinds: list[pa.DataType]) -> DataFrame:
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = [row(*r) for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * len(kinds), kinds, strict=True)], names=names)

    return df.mapInArrow(run, schema)


def count_tokens(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """doc_id, text, n_pretokens, n_tokens, leaf_chars, leaf_tokens: the trees of all texts, to be kept."""
    ranks = ranks or default_vocabulary()

    def row(doc_id: int | None, text: str | None) -> tuple:
        tree = CountTree(text or "", counter(ranks))
        chars, tokens = tree.leaves()
        return doc_id, text, len(chars), tree.n_tokens, pack_leaves(chars), pack_leaves(tokens)

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return _rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _TREE, row, kinds)


def _edited(tree: CountTree, edits: list[dict] | None) -> CountTree:
    for e in edits or []:
        tree.edit(e["at"], e["delete"], e["insert"] or "")
    return tree


def apply_edits(state: DataFrame, edits: DataFrame, ranks: str | None = None) -> DataFrame:
    """The state after ``edits`` (doc_id, ordinal, at, delete, insert), with ``reencoded``: pre-tokens encoded again.

    The edits of one document meet in one row; their number, not that of all edits, must fit in memory.
    """
    ranks = ranks or default_vocabulary()
    lists = edits.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.sort_array(F.collect_list(F.struct("ordinal", "at", "delete", "insert"))).alias("edits"))

    def row(doc_id, text, chars, tokens, own) -> tuple:
        tree = _edited(CountTree(text or "", counter(ranks), (unpack_leaves(chars), unpack_leaves(tokens))), own)
        chars, tokens = tree.leaves()
        return doc_id, tree.text if own else text, len(chars), tree.n_tokens, pack_leaves(chars), pack_leaves(tokens), tree.reencoded

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
    joined = state.join(lists, "doc_id", "left").select("doc_id", "text", "leaf_chars", "leaf_tokens", "edits")
    return _rows(joined, f"{_TREE}, reencoded long", row, kinds)


def relative_edits(length: Column, edits: Iterable[tuple[tuple[int, int], int, str]] = EDITS) -> Column:
    """The list of edits (ordinal, at, delete, insert) that ``edits`` are for a text of ``length`` characters, each placed in what those before it leave."""
    out = []
    for n, ((a, b), delete, insert) in enumerate(edits):
        at = F.floor(length * F.lit(a) / F.lit(b)).cast("long")
        out.append(F.struct(F.lit(n).cast("int").alias("ordinal"), at.alias("at"), F.lit(delete).cast("long").alias("delete"), F.lit(insert).alias("insert")))
        length = length - F.least(F.lit(delete).cast("long"), length - at) + F.lit(len(insert))
    return F.array(*out).cast(_EDIT)


def edited_counts(docs: DataFrame, edits: Iterable[tuple[tuple[int, int], int, str]] = EDITS, ranks: str | None = None) -> DataFrame:
    """Count every text and keep its tree in the shared folder; read the trees back, apply the same relative edits to each, and take the counts from the tree.

    The edits of a row are placed by its own length, so they stand beside it and nothing is shuffled; ``apply_edits`` joins edits from a table.

    doc_id, n_pretokens, n_tokens, edited_chars, edited_pretokens, edited_tokens, reencoded: one row a row of ``docs``.
    """
    ranks = ranks or default_vocabulary()
    kept = write_shared(count_tokens(docs, ranks), "count-trees")

    def row(doc_id, text, n_pretokens, n_tokens, chars, tokens, own) -> tuple:
        tree = _edited(CountTree(text or "", counter(ranks), (unpack_leaves(chars), unpack_leaves(tokens))), own)
        return doc_id, n_pretokens, n_tokens, len(tree.text), tree.n_pretokens, tree.n_tokens, tree.reencoded

    schema = f"doc_id long, {_STATE}, edited_chars long, edited_pretokens long, edited_tokens long, reencoded long"
    length = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    return _rows(kept.withColumn("edits", relative_edits(length, tuple(edits))), schema, row, [pa.int64()] * 7)
