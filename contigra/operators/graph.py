"""J-1 to J-12: iterative operators.  Each round is a join; rounds are cut by files in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contigra.operators.joins import join_heavy, over


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only in local mode, where that is unset, a folder of this machine."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        shared = sc.getConf().get("spark.checkpoint.dir")
        if not shared and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="contigra-"))
    return sc.getCheckpointDir()


_files: dict[int, tuple[weakref.ref, str]] = {}


def cut(df: DataFrame) -> DataFrame:
    """``df``, written to the shared folder and read again: its lineage ends, and estimates of its size are those of its files.

    (A checkpoint would keep the estimates of the plan before it, which every round of joins multiplies.)
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _files[id(out)] = (weakref.ref(out), path)
    return out


def drop(*frames: DataFrame) -> None:
    """Delete what ``cut`` wrote, once all that reads it has been written itself."""
    for df in frames:
        held, path = _files.pop(id(df), (None, None))
        if held is not None and held() is df:
            where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def reach(members: DataFrame, edges: DataFrame, hops: int = 1, n: int | None = None) -> DataFrame:
    """J-1, J-2 and J-3: (bin_id, contig_id, level) within ``hops`` steps of a bin's contigs; level 0 are its own; ``n``: see ``tasks``.

    Bins are numbered, and a contig has one row for 64 of them: a bit each.  An edge so carries all bins of a contig at once, and a step costs
    the edges, not the edges times the bins.  Contigs that all bins have reached take no more part.
    """
    from contigra.operators.windows import numbered

    n = n and 2 * n  # every edge is there in both directions
    at = F.col("n_") - 1
    bins = cut(numbered(members.select("bin_id").distinct(), [F.asc("bin_id")], "n_").select("bin_id", F.floor(at / 64).alias("block"), (at % 64).cast("int").alias("bit")))
    names = cut(bins.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bit", "bin_id"))).alias("names")))
    total = bins.count()
    same = members["bin_id"].eqNullSafe(bins["bin_id"])
    own = members.join(bins, same).groupBy("contig_id", "block").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
    fronts = [cut(own.withColumn("level", F.lit(0)))]
    drop(bins)
    pairs = cut(edges.select("node1", "node2"))
    seen, front = fronts[0].drop("level"), fronts[0]
    for level in range(1, hops + 1):
        both = pairs.select(F.col("node1").alias("x"), F.col("node2").alias("y")).union(pairs.select("node2", "node1"))
        if level > 1:
            full = seen.groupBy(F.col("contig_id").alias("y")).agg(F.sum(F.bit_count("mask")).alias("k")).where(F.col("k") == total)
            both = over(both, n, "y").join(full.select("y"), "y", "left_anti").select("x", "y")
        told = over(both, n, "x").join(front, both["x"] == front["contig_id"]).select(F.col("y").alias("contig_id"), "block", "mask", F.lit(0).cast("long").alias("old"))
        all_ = told.union(seen.select("contig_id", "block", F.lit(0).cast("long"), "mask"))
        new = over(all_, n, "contig_id", "block").groupBy("contig_id", "block").agg(F.bit_or("mask").alias("mask"), F.bit_or("old").alias("old"))
        new = new.select("contig_id", "block", F.col("mask").bitwiseAND(F.bitwise_not("old")).alias("mask"), F.lit(level).alias("level"))
        fronts.append(cut(new.where("mask <> 0")))
        front = fronts[-1]
        seen = seen.union(front.drop("level"))
        if level < hops and front.isEmpty():
            break
    drop(pairs)
    held = over(reduce(DataFrame.union, fronts), n, "contig_id").join(names, "block")
    return held.select("contig_id", "level", F.explode(F.filter("names", lambda b: F.getbit(F.col("mask"), b["bit"]) == 1)).alias("b")).select("b.bin_id", "contig_id", "level")


def connected_components(edges: DataFrame) -> DataFrame:
    """J-4, J-5 and J-6: (node, component: smallest node) of edges (a, b).

    In each round a node takes the smallest label among its neighbours, and so does, for all its nodes at once, the label that
    they had; then each node takes the label of its label.  Trees merge whole, so the number of rounds is about the logarithm of
    the longest path, in whatever order its nodes are numbered.  Labels are pre-aggregated before each shuffle, and labels of
    nodes with many edges, or of many nodes, meet these by broadcast, so no hub is one task's work.
    """
    e = edges.select(edges.columns[0], edges.columns[1]).toDF("x", "y")
    both = cut(e.union(e.select("y", "x")).distinct())
    total = both.count()
    held = label = cut(both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.first("x")).alias("c"), F.count(F.lit(1)).alias("w")))
    while True:
        near = join_heavy(both, label.withColumnRenamed("node", "y"), ["y"], "w", total).groupBy("x").agg(F.min("c").alias("m"))
        step = cut(label.join(near, label["node"] == near["x"]).select("node", "w", "c", F.least("c", "m").alias("m")))
        tree = step.groupBy("c").agg(F.min("m").alias("h"), F.count(F.lit(1)).alias("k"))
        up = tree.join(step.select(F.col("node").alias("c"), F.col("m").alias("u")), "c").select("c", "k", F.least("h", "u").alias("u"))
        new = cut(join_heavy(step, up, ["c"], "k", total).select("node", "w", F.least("m", "u").alias("c"), (F.least("m", "u") != F.col("c")).alias("changed")))
        drop(held, step)
        held, label = new, new.select("node", "c", "w")
        if new.where("changed").isEmpty():
            drop(both)
            return label.select("node", F.col("c").alias("component"))


def fold_sets(sets: list[DataFrame], merge: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """J-7: bin sets merged one after the other; each result is cut so that plans don't grow."""

    def next_(a: DataFrame, b: DataFrame) -> DataFrame:
        out = cut(merge(a, b))
        drop(a)
        return out

    return reduce(next_, sets)


def elongate(targets: DataFrame, overlaps: DataFrame) -> DataFrame:
    """J-8: (target, contig_id, step): chains from each target over overlaps (query, subject, length), the longest at each step.

    Ends when nothing new is reached; a contig enters a chain once.  Every round doubles the steps of all chains by the contigs that
    lie so many steps after each contig, so the number of rounds is the logarithm of the longest chain.
    """
    far = cut(overlaps.groupBy("query").agg(F.max_by("subject", F.struct("length", "subject")).alias("subject")))
    seen = cut(targets.select(F.col("contig_id").alias("target"), "contig_id", F.lit(0).alias("step")).distinct())
    steps = 1
    while True:
        new = seen.join(far, seen["contig_id"] == far["query"]).select("target", F.col("subject").alias("contig_id"), (F.col("step") + steps).alias("step"))
        new = new.groupBy("target", "contig_id").agg(F.min("step").alias("step"))
        new = cut(new.join(seen.select("target", "contig_id"), ["target", "contig_id"], "left_anti"))
        if new.isEmpty():
            return seen
        seen = seen.union(new)
        last, far = far, cut(far.join(far.select(F.col("query").alias("subject"), F.col("subject").alias("next_")), "subject").select("query", F.col("next_").alias("subject")))
        drop(last)
        steps *= 2


def elongated(targets: DataFrame, overlaps: DataFrame, contigs: DataFrame) -> DataFrame:
    """J-8: (target, contigs, length, seq): each target run on over its chain of longest overlaps (query, subject, length).

    Each contig of a chain adds what lies behind its overlap with the one before.  What it adds, and so where it begins, doubles along
    with the steps; only then do sequences (contig_id, seq) meet their places, once, and each target is put together in order.  A chain
    that runs into a ring ends where it would meet a contig again; overlaps of contigs without a sequence don't count; an overlap is as long as the shorter of both at most.
    """
    size = contigs.select("contig_id", F.length("seq").alias("n_"))
    known = overlaps.join(size.select(F.col("contig_id").alias("subject"), "n_"), "subject")
    far = known.groupBy("query").agg(F.max_by(F.struct("subject", "length", "n_"), F.struct("length", "subject")).alias("b")).select("query", "b.*")
    far = far.join(size.select(F.col("contig_id").alias("query"), F.col("n_").alias("m_")), "query")
    own = F.least(F.greatest("length", F.lit(0)), "n_", "m_").cast("long")
    far = cut(far.select("query", "subject", own.alias("lap"), (F.col("n_") - own).alias("gain")))
    begin = size.select(F.col("contig_id").alias("target"), F.col("n_").cast("long").alias("end")).join(targets.select(F.col("contig_id").alias("target")).distinct(), "target")
    seen, steps, made = cut(begin.select("target", F.col("target").alias("contig_id"), F.lit(0).alias("step"), F.lit(0).cast("long").alias("lap"), "end")), 1, [far]
    while True:
        new = seen.drop("lap").join(far, F.col("contig_id") == F.col("query")).select("target", F.col("subject").alias("contig_id"), (F.col("step") + steps).alias("step"), "lap", (F.col("end") + F.col("gain")).alias("end"))
        new = new.groupBy("target", "contig_id").agg(F.min(F.struct("step", "lap", "end")).alias("b")).select("target", "contig_id", "b.*")
        new = cut(new.join(seen.select("target", "contig_id"), ["target", "contig_id"], "left_anti"))
        if new.isEmpty():
            break
        seen = seen.union(new)
        two = far.select(F.col("query").alias("subject"), F.col("subject").alias("next_"), F.col("lap").alias("lap_"), F.col("gain").alias("gain_"))
        far = cut(far.join(two, "subject").select("query", F.col("next_").alias("subject"), F.col("lap_").alias("lap"), (F.col("gain") + F.col("gain_")).alias("gain")))
        made.append(far)
        steps *= 2
    drop(*made)
    piece = F.expr("substring(seq, cast(lap + 1 as int), length(seq))")
    parts = seen.join(contigs.select("contig_id", "seq"), "contig_id").select("target", F.struct("step", "end", piece.alias("piece")).alias("p"))
    whole = parts.groupBy("target").agg(F.sort_array(F.collect_list("p")).alias("p"), F.max("p.end").alias("length"))
    return whole.select("target", F.size("p").alias("contigs"), "length", F.array_join(F.col("p.piece"), "").alias("seq"))


def fixpoint(df: DataFrame, step: Callable[[DataFrame], DataFrame], measure: Callable[[DataFrame], object], rounds: int = 100) -> DataFrame:
    """J-9: repeat ``step`` until ``measure`` stays the same; not to end within ``rounds`` is an error, never a half-done result."""
    last = measure(df)
    for _ in range(rounds):
        before, df = df, cut(step(df))
        drop(before)
        now = measure(df)
        if now == last:
            return df
        last = now
    raise RuntimeError(f"no fixed point within {rounds} rounds; the measure is {last}")


def scheduled(hits: DataFrame) -> DataFrame:
    """J-11: of hits (read_id, contig_id, start, end, score) those of the greatest total score among which no two of a read overlap.

    Runs of overlapping hits are independent of each other, so a read is cut into these first (``islands``, whatever the number of its hits), and runs
    of one hit stay as they are.  The others stream by in order, and each is scheduled by a search for the last hit that ends before
    the next begins.  Hits without a start, end or score, or of none above 0, are never taken; of equal totals the earlier hits win.
    """
    from contigra.operators.windows import islands

    order = ["end", "contig_id", "score"]
    near = islands(hits.where((F.col("start") <= F.col("end")) & (F.col("score") > 0)), ["read_id"], "start", "end", order)
    sizes = near.groupBy("read_id", "island").agg(F.count(F.lit(1)).alias("n_"))
    near = near.join(sizes, ["read_id", "island"])

    def choose(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            new = (held["read_id"] != held["read_id"].shift()) | (held["island"] != held["island"].shift())
            cuts = np.flatnonzero(new.to_numpy())
            takes = [a + i for a, b in zip(cuts[:-1], cuts[1:], strict=True) for i in best_schedule(*(held[c].to_numpy()[a:b] for c in ("start", "end", "score")))]
            yield held.iloc[takes]
            held = held.iloc[cuts[-1] :].reset_index(drop=True)
        if held is not None:
            yield held.iloc[best_schedule(*(held[c].to_numpy() for c in ("start", "end", "score")))]

    crowd = near.where("n_ > 1").repartition("read_id", "island").sortWithinPartitions("read_id", "island", "end", "start", "contig_id", "score")
    return near.where("n_ = 1").unionByName(crowd.mapInPandas(choose, near.schema)).select(*hits.columns)


def best_schedule(start: np.ndarray, end: np.ndarray, score: np.ndarray) -> list[int]:
    """Positions of intervals, given in order of their ends, that don't overlap and have the greatest total score."""
    best = [0.0]
    before = np.searchsorted(end, start, side="left").tolist()
    for i, (p, s) in enumerate(zip(before, score.tolist(), strict=True)):
        best.append(max(best[i], best[p] + s))
    out, i = [], len(before)
    while i:
        if best[i] > best[i - 1]:
            out.append(i - 1)
            i = before[i - 1]
        else:
            i -= 1
    return out[::-1]


def roadmap(hits: DataFrame) -> DataFrame:
    """J-11: (read_id, contigs) along each read that reaches two contigs; a contig stands where its best hit (by score) starts.

    Hits that have an ``end`` are scheduled: no two contigs of the road overlap on the read, and its total score is the greatest.
    """
    fields = ["start", "strand", *(["end", "score"] if "end" in hits.columns else [])]
    best = hits.groupBy("read_id", "contig_id").agg(F.max_by(F.struct(*fields), F.struct("score", -F.col("start"))).alias("h")).select("read_id", "contig_id", "h.*")
    if "end" in hits.columns:
        best = scheduled(best)
    road = best.groupBy("read_id").agg(F.array_sort(F.collect_list(F.struct("start", "contig_id", "strand"))).alias("contigs"))
    return road.where(F.size("contigs") >= 2)


def single_paths(hits: DataFrame) -> DataFrame:
    """J-12: hits (read_id, contig_id, end) after ends with two partners and more have gone, until none is left."""
    left = hits.count()
    while True:
        wide = hits.groupBy("contig_id", "end").agg(F.countDistinct("read_id").alias("n")).where("n >= 2").select("contig_id", "end")
        last, hits = hits, cut(hits.join(wide, ["contig_id", "end"], "left_anti"))
        drop(last)
        before, left = left, hits.count()
        if left == before:
            return hits


def retrieval(members: DataFrame, edges: DataFrame, depths: DataFrame, levels: int = 3, cutoffs: tuple[float, ...] = (1.0, 1.2, 1.5), n: int | None = None) -> DataFrame:
    """J-10: (bin_id, contig_id, level, cutoff): contigs first reached at each level whose depth is in the bin's fence in every sample.

    depths: contig_id, sample_idx, depth.  The fence of a bin and sample is that of its own contigs, ``cutoff`` quartile ranges wide.  What is
    reached lies by contig (``n``: see ``tasks``), where its depths and then all cutoffs are met without another shuffle.
    """
    from contigra.operators.aggregates import quartiles

    near = reach(members, edges, levels, n).where("level > 0")
    q = cut(quartiles(members.select("bin_id", "contig_id").join(depths, "contig_id"), ["bin_id", "sample_idx"], "depth"))
    tried = near.join(depths, "contig_id").join(q, ["bin_id", "sample_idx"])

    def inside(cutoff: float) -> Column:
        wide = cutoff * (F.col("q3") - F.col("q1"))
        return F.bool_and((F.col("depth") >= F.col("q1") - wide) & (F.col("depth") <= F.col("q3") + wide))

    held = tried.groupBy("bin_id", "contig_id", "level").agg(F.array(*[F.when(inside(c), F.lit(c)) for c in cutoffs]).alias("c"))
    return held.select("bin_id", "contig_id", "level", F.explode(F.array_compact("c")).alias("cutoff"))
