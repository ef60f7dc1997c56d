"""Exact uniform sharding through a hypergeometric communication matrix.

Rows sit in source cells (the partitions of the written input).  Target blocks have
sizes fixed beforehand: shards differ by one row at most, and a shard of many rows is
several blocks of at most ``block_rows`` rows.  A uniform random permutation of all rows sends a
random number of rows from each cell to each block; these counts follow the
multivariate hypergeometric law and are drawn exactly, row by row of the matrix.
Each cell permutes its rows locally and deals them out by its row of the matrix, the
rows are exchanged once, and each block permutes what it got.  The result is a uniform
permutation with exact shard sizes, whatever the sizes of the cells.

Defined cases: null text counts as empty (16 bytes, crc32 0); null or repeated doc_id
and repeated rows are dealt out like any others; an empty table gives an empty result;
``carry`` names further columns that travel with their row.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contigra.llm.common import write_shared

SHARDS = 40
BLOCK_ROWS = 1 << 20
MAX_CELLS = 2048
MAX_BLOCKS = 2048


def block_sizes(n: int, shards: int, block_rows: int = BLOCK_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """(shard of each block, rows of each block); shards differ by one row at most.

    There are at most MAX_BLOCKS blocks, or one a shard; beyond that blocks grow.
    """
    rows = np.full(shards, n // shards, np.int64)
    rows[: n % shards] += 1
    parts = int(max(1, min(-(-int(rows.max(initial=0)) // block_rows), MAX_BLOCKS // shards)))
    shard = np.repeat(np.arange(shards), parts)
    j = np.tile(np.arange(parts), shards)
    return shard, rows[shard] // parts + (j < rows[shard] % parts)


def communication_matrix(cells: np.ndarray, blocks: np.ndarray, seed: int) -> np.ndarray:
    """counts[i, j] of rows that cell i sends to block j: row sums ``cells``, column sums ``blocks``."""
    rng = np.random.default_rng(seed)
    left, out = blocks.astype(np.int64).copy(), np.zeros((len(cells), len(blocks)), np.int64)
    for i, n in enumerate(cells):
        rest = int(n)
        total = int(left.sum())
        for j in np.flatnonzero(left):
            if not rest:
                break
            others = total - int(left[j])
            got = rest if not others else int(_hypergeometric(rng, int(left[j]), others, rest))
            out[i, j] = got
            rest -= got
            total = others
        left -= out[i]
    return out


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` rows drawn from ``good`` and ``bad`` ones are good; numpy has no draw from 10**9 rows and more."""
    return int(rng.hypergeometric(good, bad, n)) if good + bad < 1_000_000_000 else inverted(rng, good, bad, n)


def inverted(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """A hypergeometric draw by inverting its distribution function, for populations of any size.

    Weights follow from the ratios of neighbouring terms, so nothing is approximated but by rounding of doubles; terms
    beyond twelve standard deviations of the mode, which hold less than 1e-30 of the law, are left out.
    """
    total = good + bad
    mode = (n + 1) * (good + 1) // (total + 2)
    p = good / total
    far = int(12 * (n * p * (1 - p) * (total - n) / max(1, total - 1)) ** 0.5) + 64
    first, last = max(0, n - bad, mode - far), min(n, good, mode + far)
    k = np.arange(first, last, dtype=np.float64)
    logs = np.concatenate(([0.0], np.cumsum(np.log((good - k) * (n - k) / ((k + 1) * (bad - n + k + 1))))))
    upto = np.cumsum(np.exp(logs - logs.max()))
    return first + min(int(np.searchsorted(upto, rng.random() * upto[-1], side="right")), last - first)


def _cells(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
    part, at = TaskContext.get().partitionId(), 0
    for pdf in batches:
        yield pdf.assign(cell_=np.int64(part % MAX_CELLS), part_=np.int64(part), place_=np.arange(at, at + len(pdf), dtype=np.int64))
        at += len(pdf)


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = 7, carry: Iterable[str] = (), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, and the columns ``carry``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    thin = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size_"), F.crc32(text.cast("binary")).cast("long").alias("crc_"), *[F.col(c).alias(f"carry_{c}") for c in carry])
    schema = T.StructType([*thin.schema.fields, *(T.StructField(c, T.LongType()) for c in ("cell_", "part_", "place_"))])
    held = write_shared(thin.mapInPandas(_cells, schema), "shard-cells")
    counts = {int(r["cell_"]): int(r["n_"]) for r in held.groupBy("cell_").agg(F.count(F.lit(1)).alias("n_")).collect()}  # MAX_CELLS rows at most
    ids = np.array(sorted(counts), np.int64)
    sizes = np.array([counts[i] for i in ids.tolist()], np.int64)
    of, rows = block_sizes(int(sizes.sum()), shards, block_rows)
    ends = np.cumsum(communication_matrix(sizes, rows, seed), axis=1)
    first = np.cumsum(rows) - rows
    first = first - first[np.searchsorted(of, of)]  # the slot at which a block starts in its shard
    plan = held.sparkSession.sparkContext.broadcast((ids, ends, of, first))  # MAX_CELLS x MAX_BLOCKS numbers at most

    def deal(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        ids, ends, of, first = plan.value
        for pdf in batches:
            row = np.searchsorted(ids, pdf["cell_"].to_numpy())
            rank, block = pdf["rank_"].to_numpy() - 1, np.empty(len(pdf), np.int64)
            for i in np.unique(row):
                here = row == i
                block[here] = np.searchsorted(ends[i], rank[here], side="right")
            yield pdf.assign(block_=block, shard_=of[block].astype(np.int32), first_=first[block])

    local = F.xxhash64(F.lit(seed), "part_", "place_")
    ranked = held.withColumn("rank_", F.row_number().over(Window.partitionBy("cell_").orderBy(local, "part_", "place_")))
    dealt = ranked.mapInPandas(deal, T.StructType([*schema.fields, T.StructField("rank_", T.IntegerType()), T.StructField("block_", T.LongType()), T.StructField("shard_", T.IntegerType()), T.StructField("first_", T.LongType())]))
    again = F.xxhash64(F.lit(seed + 1), "part_", "place_")
    slot = F.col("first_") + F.row_number().over(Window.partitionBy("block_").orderBy(again, "part_", "place_")) - 1
    return dealt.select(
        "doc_id", F.col("size_").alias("size"), F.col("crc_").alias("text_crc32"), F.lit("rows").alias("law"),
        F.col("shard_").alias("shard"), slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), *[F.col(f"carry_{c}").alias(c) for c in carry],
    )
