"""Near duplicates by SetSketch registers.

A text's set is its distinct word shingles (64-bit hashes).  Register i holds
``floor(1 - log_b(x_i))`` where ``x_i`` is the smallest of exponential variates of rate
``a`` that its elements draw, truncated to [0, q + 1]: registers of a union are the
maxima, and equal registers are as likely as the sets are similar.  Bands of registers
give candidates; the joint likelihood of larger, equal and smaller registers given both set
sizes estimates the Jaccard similarity and drops pairs far below the threshold; the rest
are confirmed on full sets.  Texts with equal sets are one class; links join classes and
connected components follow by star contraction.

A bucket never emits all its pairs: it links its members to its smallest member, so a group
of n near copies costs about n pairs a band.  Where a bucket still holds several components after
that, its members are compared whole: buckets that share members form a cluster, a cluster is cut
into blocks of about ``TILE`` members, and each pair of blocks is one small task that compares
across components by registers and confirms on full sets.  Only confirmed links leave it.

Defined cases: A-Z are lower-cased and words are ``[^\\x20\\x09-\\x0D]+``; null, empty and blank
texts have the empty set and link with nothing; fewer words than the shingle length make one
shingle; repeated rows and equal texts share a class; rows that share a doc_id are one
node; a null doc_id gets a null component and is kept; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from contigra.llm.common import column_bytes, forget, fresh, join_heavy, mix, shingle_blocks, shingles, slices, words, write_shared

REGISTERS, ROWS, DEALS = 360, 9, 3  # DEALS * REGISTERS / ROWS bands
BASE, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 2
MARGIN = 0.1  # 4.7 standard errors of the estimate at 0.8
TILE, TILE_BYTES = 512, 16 << 20
THRESHOLD = (80, 100)
BITS = 1 << 24


# ---------------------------------------------------------------- registers


def _parameters(m: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix(np.arange(1, 2 * m + 1, dtype=np.uint64))
    return (x[:m].astype(np.uint32) | np.uint32(1)), x[m:].astype(np.uint32)


def registers(elements: np.ndarray, offsets: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """(rows, m) registers of the non-empty sets elements[offsets[r]:offsets[r + 1]]."""
    n = len(offsets) - 1
    least = np.empty((m, n), np.uint32)
    multiply, add = _parameters(m)
    x = (elements >> np.uint64(32)).astype(np.uint32)
    for a, b in shingle_blocks(offsets, 1 << 15):
        part, starts = x[offsets[a] : offsets[b]], (offsets[a:b] - offsets[a]).astype(np.intp)
        drawn = np.empty_like(part)
        for i in range(m):
            np.multiply(part, multiply[i], out=drawn)
            np.add(drawn, add[i], out=drawn)
            np.minimum.reduceat(drawn, starts, out=least[i, a:b])
    draws = np.log(-np.log1p(-(least.T.astype(np.float64) + 0.5) / 2.0**32) / RATE)
    return np.clip(np.floor(1 - draws / math.log(BASE)), 0, LIMIT + 1).astype(np.uint16)


def bands(m: int = REGISTERS, rows: int = ROWS, deals: int = DEALS) -> np.ndarray:
    """(bands, rows) registers of each band: ``deals`` times all registers are shuffled and cut into bands.

    With nine registers a band and 120 bands, sets of similarity 0.8 share one but for a chance of 3e-8,
    and sets of similarity 0.3 do so with a chance of 0.0024.
    """
    rng = np.random.default_rng(5)
    return np.concatenate([rng.permutation(m)[: m // rows * rows].reshape(-1, rows) for _ in range(deals)])


def band_keys(regs: np.ndarray, of: np.ndarray) -> np.ndarray:
    """(rows, bands) 64-bit keys of the bands of registers."""
    key = np.broadcast_to(mix(np.arange(1, len(of) + 1, dtype=np.uint64)), (len(regs), len(of))).copy()
    for j in range(of.shape[1]):
        key = mix(key + regs[:, of[:, j]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    return key


def estimate(reg_a: np.ndarray, reg_b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """The Jaccard similarity of greatest joint likelihood, row by row, on a grid."""
    more, less = (reg_a > reg_b).sum(1), (reg_a < reg_b).sum(1)
    same = reg_a.shape[1] - more - less
    u = size_a / (size_a + size_b)
    v = 1 - u
    top = np.minimum(u / v, v / u)
    grid = np.linspace(0, 1, 201)[None, :] * top[:, None]

    def over(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    p, q = over(u[:, None] - v[:, None] * grid), over(v[:, None] - u[:, None] * grid)
    tiny = 1e-12
    score = more[:, None] * np.log(p + tiny) + less[:, None] * np.log(q + tiny) + same[:, None] * np.log(np.maximum(1 - p - q, 0) + tiny)
    return grid[np.arange(len(u)), score.argmax(1)]


# ---------------------------------------------------------------- sketches of documents


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n (set size), hi and lo (of the set's 128-bit digest), regs (null for the empty set)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [shingles(words(t), k) for t in column_bytes(batch, "text")]
            n = np.array([len(s) for s in sets], np.int64)
            digest = np.frombuffer(b"".join(xxh3_128_digest(s.tobytes()) for s in sets), "<i8").reshape(-1, 2)
            full = np.flatnonzero(n)
            regs: list[bytes | None] = [None] * len(sets)
            if len(full):
                r = registers(np.concatenate([sets[i] for i in full]), np.concatenate(([0], np.cumsum(n[full]))))
                for i, row in zip(full.tolist(), r, strict=True):
                    regs[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array(regs, pa.binary())], names=["doc_id", "n", "hi", "lo", "regs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, hi long, lo long, regs binary")


def _banded(reps: DataFrame, of: np.ndarray) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "regs", 4 << 20):
            regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
            keys = band_keys(regs, of).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), len(of)))], names=["key", "node"])

    return reps.select("node", "regs").mapInArrow(run, "key long, node long")


# ---------------------------------------------------------------- exact links


def _bitmap(nodes: DataFrame) -> np.ndarray:
    """BITS bits, set at the hash of each node; a filter of fixed size before a join."""
    h = nodes.select(F.pmod(F.xxhash64("node"), F.lit(BITS)).alias("h"))
    found = h.selectExpr("h div 64 as at", "shiftleft(1L, cast(h % 64 as int)) as bit").groupBy("at").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros(BITS // 64, np.int64)
    for r in found.toLocalIterator(prefetchPartitions=True):  # BITS / 64 rows at most
        out[r["at"]] = r["bits"]
    return out


def _full_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """node, full: the sorted set of each wanted node, made anew from its text."""
    spark = docs.sparkSession
    bitmap = spark.sparkContext.broadcast(_bitmap(wanted))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value.view(np.uint64)
        for batch in slices(batches, "text"):
            h = batch.column(2).to_numpy()
            may = np.flatnonzero((bits[h // 64] >> (h % 64).astype(np.uint64)) & np.uint64(1))
            if len(may):
                kept = batch.take(pa.array(may))
                sets = [shingles(words(t), k).tobytes() for t in column_bytes(kept, "text")]
                yield pa.RecordBatch.from_arrays([kept.column(0), pa.array(sets, pa.binary())], names=["node", "full"])

    seen = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("node"), "text").withColumn("h", F.pmod(F.xxhash64("node"), F.lit(BITS)))
    return seen.mapInArrow(run, "node long, full binary").join(wanted, "node", "left_semi").where(F.length("full") > 0)


def _verified(docs: DataFrame, pairs: DataFrame, reps: DataFrame, k: int, threshold: tuple[int, int]) -> DataFrame:
    """Of pairs (a, b), written, those whose full sets reach the threshold; the likelihood estimate goes first."""
    least, of = threshold
    floor = least / of - MARGIN

    def likely(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                ra, rb = (np.frombuffer(b"".join(pdf[c]), np.uint16).reshape(len(pdf), -1) for c in ("ra", "rb"))
                yield pdf.loc[estimate(ra, rb, pdf["na"].to_numpy(float), pdf["nb"].to_numpy(float)) >= floor, ["a", "b"]]

    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "fa"):
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(of * both >= least * (len(x) + len(y) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    small = F.least("na", "nb") * of >= F.greatest("na", "nb") * least
    regs = reps.select("node", "regs", "n")
    rough = pairs.join(regs.select(F.col("node").alias("a"), F.col("regs").alias("ra"), F.col("n").alias("na")), "a").join(regs.select(F.col("node").alias("b"), F.col("regs").alias("rb"), F.col("n").alias("nb")), "b").where(small)
    rough = write_shared(rough.select("a", "b", "ra", "rb", "na", "nb").mapInPandas(likely, "a long, b long"), "near-likely")
    wanted = write_shared(rough.select(F.col("a").alias("node")).union(rough.select("b")).distinct(), "near-wanted")
    full = write_shared(_full_sets(docs, wanted, k), "near-sets")
    forget(wanted)
    both = rough.join(full.select(F.col("node").alias("a"), F.col("full").alias("fa")), "a").join(full.select(F.col("node").alias("b"), F.col("full").alias("fb")), "b")
    out = write_shared(both.select("a", "b", "fa", "fb").mapInArrow(confirm, "a long, b long").distinct(), "near-links")
    forget(rough, full)
    return out


def _tiled(docs: DataFrame, open_: DataFrame, reps: DataFrame, k: int, threshold: tuple[int, int]) -> DataFrame:
    """Confirmed links (a, b), written, between components among members (node, c) of clusters joined by ``low``."""
    least, of = threshold
    floor = least / of - MARGIN
    cluster = components(open_.select(F.col("node").alias("a"), F.col("low").alias("b")), "near-clusters")
    wanted = write_shared(open_.select("node", "c").distinct().join(cluster.withColumnRenamed("component", "cluster"), "node"), "near-wanted")
    full = _full_sets(docs, wanted.select("node").distinct(), k)
    whole = write_shared(wanted.join(reps.select("node", "n", "regs"), "node").join(full, "node").where(F.col("n") * 8 == F.length("full")), "near-whole")
    sizes = whole.groupBy("cluster").agg(F.count(F.lit(1)).alias("g"), F.sum("n").alias("t"))
    sizes = sizes.select("cluster", "g", F.ceil(F.greatest(F.col("g") / TILE, F.col("t") * 8 / TILE_BYTES)).alias("blocks"))
    cut = join_heavy(whole, sizes, ["cluster"], "g", whole.count()).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    tiles = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select("cluster", "node", "c", "n", "regs", "full", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        first, second = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        regs = np.frombuffer(b"".join(pdf["regs"]), np.uint16).reshape(len(pdf), -1)
        node, c, n, block = (pdf[x].to_numpy() for x in ("node", "c", "n", "block"))
        sets = [np.frombuffer(x, np.uint64) for x in pdf["full"]]
        rows, cols = np.flatnonzero(block == first), np.flatnonzero(block == second)
        root = {x: x for x in c.tolist()}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        found = []
        for p, x in enumerate(rows):
            y = cols if first != second else cols[p + 1 :]
            y = y[(c[y] != c[x]) & (np.minimum(n[y], n[x]) * of >= np.maximum(n[y], n[x]) * least)]
            y = y[(regs[y] == regs[x]).mean(1) >= floor - 0.02]
            if len(y):
                y = y[estimate(np.broadcast_to(regs[x], (len(y), regs.shape[1])), regs[y], np.full(len(y), n[x], float), n[y].astype(float)) >= floor]
            for z in y.tolist():
                a, b = find(int(c[x])), find(int(c[z]))
                if a != b:  # a link within what is joined already changes nothing
                    both = len(np.intersect1d(sets[x], sets[z], assume_unique=True))
                    if of * both >= least * (len(sets[x]) + len(sets[z]) - both):
                        root[max(a, b)] = min(a, b)
                        found.append((min(node[x], node[z]), max(node[x], node[z])))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    out = write_shared(tiles.groupBy("cluster", "i", "j").applyInPandas(compare, "a long, b long").distinct(), "near-links")
    forget(wanted, whole)
    return out


# ---------------------------------------------------------------- components


def components(links: DataFrame, name: str = "near-components") -> DataFrame:
    """node, component (smallest node reachable), for the nodes of links (a, b); large and small stars by turns.

    The centre of a star has as many rows as the star: centres of many rows meet them by broadcast, in bounded number.
    """
    edges = write_shared(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    size, seen = edges.count(), None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("w"))
        large = join_heavy(both, low, ["u"], "w", 2 * size).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = write_shared(large.where("u <> v").distinct(), name)
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("w"))
        small = join_heavy(large, low, ["u"], "w", 2 * size).select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        new = write_shared(small.where("u <> v").distinct(), name)
        forget(edges, large)
        edges = new
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen, size = now, now[0]
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


# ---------------------------------------------------------------- the operator


def near_duplicates(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row a row of ``docs``."""
    sketch = write_shared(sketches(docs, k), "near-sketches")
    known = sketch.where("doc_id is not null and n > 0")
    classes = write_shared(known.groupBy("hi", "lo").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("rows_"), F.min("n").alias("n")), "near-classes")
    # regs of a class come from the row of its smallest doc_id: equal sets have equal registers
    rep = known.join(classes.select("hi", "lo", F.col("node").alias("doc_id")), ["doc_id", "hi", "lo"], "left_semi")
    reps = write_shared(rep.select(F.col("doc_id").alias("node"), "n", "regs", "hi", "lo").dropDuplicates(["node", "hi", "lo"]), "near-reps")
    banded = _banded(reps, bands())
    shared = banded.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    buckets = write_shared(banded.join(shared.select("key", "low"), "key").distinct(), "near-buckets")
    tried = write_shared(buckets.where("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct(), "near-pairs")
    links = _verified(docs, tried, reps, k, threshold)
    forget(tried)
    several = known.groupBy("doc_id").agg(F.min(F.struct("hi", "lo")).alias("a"), F.max(F.struct("hi", "lo")).alias("b")).where("a <> b").select("doc_id")
    if not several.isEmpty():  # a doc_id of several sets is one node, so it links their classes
        nodes = known.join(several, "doc_id").join(classes.select("hi", "lo", "node"), ["hi", "lo"]).select("doc_id", "node")
        own = nodes.groupBy("doc_id").agg(F.min("node").alias("a"))
        links = links.union(write_shared(nodes.join(own, "doc_id").where("a < node").select("a", F.col("node").alias("b")).distinct(), "near-links"))
    member = write_shared(components(links), "near-members")
    named = buckets.join(member, "node", "left").select("key", "node", "low", F.coalesce("component", "node").alias("c"))
    mixed = named.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 < c1").select("key")
    open_ = write_shared(named.join(mixed, "key", "left_semi").select("node", "low", "c").distinct(), "near-open")
    forget(buckets)
    if not open_.isEmpty():
        links = links.union(_tiled(docs, open_, reps, k, threshold))
        member = write_shared(components(links), "near-members")
    forget(open_, reps)
    total = classes.agg(F.coalesce(F.sum("rows_"), F.lit(0))).first()[0]
    classes = classes.join(member, "node", "left").select("hi", "lo", "rows_", F.coalesce("component", "node").alias("component_id"))
    found = join_heavy(known.select("doc_id", "n", "hi", "lo"), classes, ["hi", "lo"], "rows_", total).select("doc_id", "n", "component_id")
    alone = sketch.where("doc_id is null or n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The documents of which one row in each group stays, that of the smallest doc_id, with all columns.

    Where a doc_id is repeated, rows are compared as rows: those of one doc_id with unlike texts fall into unlike groups, and of
    repeated rows one stays.  Rows without words or doc_id all stay.
    """
    long_id = F.col("doc_id").cast("long")
    if docs.where(long_id.isNotNull()).groupBy(long_id.alias("id_")).count().where("count > 1").isEmpty():
        name = fresh("gone_", docs.columns)
        gone = near_duplicates(docs, k, threshold).where("not kept").select(F.col("doc_id").alias(name)).distinct()
        return docs.join(gone, long_id == F.col(name), "left_anti")
    key = fresh("row_key_", docs.columns)
    rows = write_shared(docs.withColumn(key, F.when(long_id.isNotNull(), F.monotonically_increasing_id())), "near-rows")
    found = near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"), k, threshold).where("n_shingles > 0 and doc_id is not null")
    ids = rows.select(F.col(key).alias("row_"), long_id.alias("id_"))
    member = write_shared(found.select(F.col("doc_id").alias("row_"), "component_id").join(ids, "row_"), "near-groups")
    stays = member.groupBy("component_id").agg(F.min(F.struct("id_", "row_")).alias("s")).select("s.row_")
    gone = member.join(stays, "row_", "left_anti").select(F.col("row_").alias(key))
    return rows.join(gone, key, "left_anti").select(*docs.columns)
