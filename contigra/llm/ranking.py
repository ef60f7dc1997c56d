"""Ranked lexical search, score at a time over impact-ordered postings.

The items are the query set: they are read in blocks of bounded bytes, and each block's vocabulary is broadcast.  One pass
over the texts writes, for each document, its length and the block's terms in it; counts over these rows give the number of
documents and terms and the documents that hold each term, hence the exact whole-number impact of every posting.  A second
pass reads the rows in segments of bounded size.  A segment's postings stand by term, those of equal impact together and the
greatest impacts first.  For an item the groups of all its terms are added up in falling order of impact, level by level.
What is left of each list bounds what any document can still gain; once that is below the k-th best score so far, of this
segment or of those before it in the task, no document that has not been seen can be among the k best.  Only documents whose
sum and bound together reach the k-th best are left then; their scores are completed from their rows, and the k best of these
are exact.  Each task sends k rows an item at most; their best k are the result.

The size of the items sets the number of passes, never the memory of one.

Defined cases: a null or empty text has no term and counts nowhere; an item without terms, or whose terms no document holds,
has no row; an empty table or benchmark gives an empty result; every row of the benchmark is an item, so repeated rows repeat
their results, and a null item_id stays null; every row of the table is a document, so equal documents tie and repeated rows
each hold a rank; documents without an id come after those with one among equal scores; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contigra.llm.common import column_bytes, forget, slices, terms, write_shared

K = 10
BLOCK_BYTES = 4 << 20
SEGMENT = 1 << 21  # postings that a task holds at once
STEP = 0.6  # each level ends at this share of the greatest impact that is left
NO_ID = np.iinfo(np.int64).max


class Items:
    """A block of items: its vocabulary and each item's terms with their number."""

    def __init__(self, first: int):
        self.first, self.ids, self.terms, self.vocabulary = first, [], [], {}

    def add(self, item_id: int | None, words: list[bytes]) -> None:
        count = Counter(self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words)
        self.ids.append(item_id)
        self.terms.append((np.fromiter(count, np.int64, len(count)), np.fromiter(count.values(), np.int64, len(count))))


def blocks(benchmark: DataFrame, most: int) -> Iterator[Items]:
    """The items in blocks of ``most`` bytes of text (or one item), one at a time on the driver."""
    block, held, seen = Items(0), 0, 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.encode("text", "UTF-8").alias("text")).toLocalIterator():
        text = bytes(r["text"] or b"")
        if block.ids and held + len(text) > most:
            yield block
            block, held = Items(seen), 0
        block.add(r["item_id"], terms(text))
        held, seen = held + len(text), seen + 1
    if block.ids:
        yield block


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n, terms, counts: every document with a term; its length and how often it holds each word of ``vocabulary``."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        width = max(len(known), 1)
        for batch in slices(batches, "text"):
            own = [terms(t) for t in column_bytes(batch, "text")]
            found = [np.fromiter((i for i in map(known.get, w) if i is not None), np.int64) for w in own]
            keys, counts = np.unique(np.concatenate([f + row * width for row, f in enumerate(found)]), return_counts=True)
            n = np.fromiter(map(len, own), np.int64, len(own))
            ends = np.searchsorted(keys, np.arange(len(own) + 1) * width).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x, pa.int32())) for x in (keys % width, counts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), *lists], names=["doc_id", "n", "terms", "counts"]).filter(pa.array(n > 0))

    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return thin.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


class Segment:
    """Postings of some documents by term in falling order of impact (``down`` holds them negated), and by document."""

    def __init__(self, batches: list[pa.RecordBatch], weight: np.ndarray, documents: int, length: int):
        ids = [b.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False) for b in batches]
        self.ids = np.concatenate(ids)
        flat = lambda i: np.concatenate([b.column(i).flatten().to_numpy(zero_copy_only=False) for b in batches]).astype(np.int64)
        term, tf = flat(2), flat(3)
        size = np.concatenate([b.column(2).value_lengths().to_numpy(zero_copy_only=False) for b in batches])
        n = np.concatenate([b.column(1).to_numpy() for b in batches])
        m = 100 - 75 + (75 * n * documents) // length
        doc = np.repeat(np.arange(len(n)), size)
        self.impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        self.term, self.ends = term, np.concatenate([[0], np.cumsum(size)])
        order = np.lexsort((-self.impact, term))
        self.docs, self.down = doc[order], -self.impact[order]
        self.start = np.searchsorted(term[order], np.arange(len(weight) + 1))
        self.sum = np.zeros(len(n), np.int64)

    def search(self, item: np.ndarray, times: np.ndarray, bar: int, k: int, worth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the documents that can be among the k best; ``bar``: the k-th best score so far; worth: zeros, by term."""
        lists = [(q, self.down[a:b], self.docs[a:b]) for q, a, b in zip(times.tolist(), self.start[item], self.start[item + 1], strict=True) if a < b and self.down[a]]
        at, total, bar = [0] * len(lists), self.sum, max(bar, 1)
        total[:] = 0
        while True:
            heads = [-q * int(down[i]) if i < len(down) else 0 for i, (q, down, _) in zip(at, lists, strict=True)]
            rest = sum(heads)
            if len(total) > k:
                bar = max(bar, int(np.partition(total, -k)[-k]))
            if rest < bar:  # whoever has not been seen stays below
                open_ = np.flatnonzero(total + rest >= bar)
                if not rest:
                    return open_, total[open_]
                left = sum(len(down) - i for i, (_, down, _) in zip(at, lists, strict=True))
                if int((self.ends[open_ + 1] - self.ends[open_]).sum()) <= left:
                    return open_, self.complete(open_, item, times, worth)
            level = max(heads) * STEP
            for j, (q, down, docs) in enumerate(lists):
                if heads[j] >= level and heads[j]:
                    to = int(np.searchsorted(down, -level / q, side="right"))
                    total[docs[at[j] : to]] -= q * down[at[j] : to]  # a document stands once in a list
                    at[j] = to

    def complete(self, rows: np.ndarray, item: np.ndarray, times: np.ndarray, worth: np.ndarray) -> np.ndarray:
        """The whole scores of some documents, from their rows."""
        size = self.ends[rows + 1] - self.ends[rows]
        first = np.cumsum(size) - size
        at = np.arange(int(size.sum())) + np.repeat(self.ends[rows] - first, size)
        worth[item] = times
        gain = np.concatenate([[0], np.cumsum(worth[self.term[at]] * self.impact[at])])
        worth[item] = 0
        return gain[first + size] - gain[first]


def segments(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += len(batch.column(2).flatten()) + batch.num_rows
            if size >= SEGMENT:
                yield held
                held, size = [], 0
    if held:
        yield held


def rank(docs: DataFrame, benchmark: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item."""
    spark, out = docs.sparkSession, None
    for block in blocks(benchmark, block_bytes):
        found = _ranked(docs, block, k)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out


def _ranked(docs: DataFrame, block: Items, k: int) -> DataFrame:
    spark = docs.sparkSession
    rows = write_shared(postings(docs, block.vocabulary), "ranked-postings")
    documents, length = rows.agg(F.count("n"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = np.zeros(len(block.vocabulary), np.int64)
    for term, df in rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row a word of the block
        weight[term] = floor(1000 * log((2 * documents + 2) / (2 * df + 1)))
    sent = spark.sparkContext.broadcast((block.terms, block.ids, block.first, weight))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, ids, first, weight = sent.value
        best: list[list[tuple[int, int]]] = [[] for _ in items]  # (-score, doc_id), the best first
        worth = np.zeros(len(weight), np.int64)
        for held in segments(batches):
            s = Segment(held, weight, documents, length)
            for i, (item, times) in enumerate(items):
                if len(item):
                    bar = -best[i][-1][0] if len(best[i]) == k else 0
                    at, score = s.search(item, times, bar, k, worth)
                    own = np.lexsort((s.ids[at], -score))[:k]
                    own = own[score[own] > 0]
                    best[i] = sorted(best[i] + list(zip((-score[own]).tolist(), s.ids[at[own]].tolist(), strict=True)))[:k]
        flat = [(i, doc, -score) for i, own in enumerate(best) for score, doc in own]
        row, doc, score = zip(*flat, strict=True) if flat else ([],) * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array([first + i for i in row], pa.int64()), pa.array([ids[i] for i in row], pa.int64()), pa.array([None if d == NO_ID else d for d in doc], pa.int64()), pa.array(score, pa.int64())],
            names=["row_", "item_id", "doc_id", "score"],
        )

    top = rows.mapInArrow(run, "row_ long, item_id long, doc_id long, score long")
    order = Window.partitionBy("row_").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    kept = write_shared(top.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"), "ranked-block")
    forget(rows)
    return kept


def oracle_sql(k: int = K) -> str:
    """The same ranks by SQL, over all terms of all documents."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    split = f"unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '{word}'))"
    return f"""WITH words AS (SELECT r, doc_id, {split} AS t FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
tf AS (SELECT r, doc_id, t, count(*) AS tf FROM words GROUP BY ALL), n AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY 1), total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS l FROM n),
weight AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY 1), total),
items AS (SELECT q, item_id, t, count(*) AS times FROM (SELECT q, item_id, {split} AS t FROM (SELECT row_number() OVER () AS q, item_id, text FROM benchmark)) GROUP BY ALL),
scored AS (SELECT q, item_id, doc_id, r, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // l)))) AS BIGINT) AS score FROM items JOIN weight USING (t) JOIN tf USING (t) JOIN n USING (r), total GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= {k}"""
