"""De-replication of two bin sets: best hits, acceptance, pair selection, union with what has no partner."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigra.operators import aggregates, joins, selection, windows


def sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("bin_id").agg(F.sum("length").alias("size"))


def scored(a: DataFrame, b: DataFrame) -> DataFrame:
    """D-4, E-11, E-12: (bin1, bin2, pct1, pct2)."""
    return aggregates.shared_percent(joins.shared(a, b), sizes(a), sizes(b))


def dereplicate(a: DataFrame, b: DataFrame, quality_a: DataFrame, quality_b: DataFrame) -> DataFrame:
    """(side, bin_id): the survivors of two sets of members (bin_id, contig_id, length)."""
    pairs = windows.accepted(windows.best_hits(scored(a, b)))
    q = ["bin_id", "completeness", "contamination", "genome_size"]
    j = pairs.join(quality_a.select(q).toDF("bin1", "cpn1", "ctn1", "size1"), "bin1").join(quality_b.select(q).toDF("bin2", "cpn2", "ctn2", "size2"), "bin2")
    judged = j.withColumn("winner", selection.within_assembly())
    lost_a = judged.where("winner = 2").select(F.col("bin1").alias("bin_id")).distinct()
    lost_b = judged.where("winner = 1").select(F.col("bin2").alias("bin_id")).distinct()
    one = a.select("bin_id").distinct().join(lost_a, "bin_id", "left_anti").select(F.lit("a").alias("side"), "bin_id")
    two = b.select("bin_id").distinct().join(lost_b, "bin_id", "left_anti").select(F.lit("b").alias("side"), "bin_id")
    return one.union(two)


def dereplicate_all(sets: list[tuple[DataFrame, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """J-7: (members, quality) of what is left of several such sets, folded from the left: each result meets the next set.

    The members and qualities of a step are those of its survivors; names of bins must differ between sets.
    """
    from contigra.operators.graph import cut

    def merge(a: tuple[DataFrame, DataFrame], b: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
        left = cut(dereplicate(a[0], b[0], a[1], b[1]))
        kept = lambda df, side: df.join(left.where(F.col("side") == side).select("bin_id"), "bin_id", "left_semi")
        return tuple(cut(kept(x, "a").unionByName(kept(y, "b"))) for x, y in zip(a, b, strict=True))

    return reduce(merge, sets)


def refine(depths: DataFrame, votes: DataFrame, models: int) -> DataFrame:
    """(bin_id, contig_id, outlier): flagged by the ensemble (E-32) and not confirmed clean by depth (E-27)."""
    flagged = aggregates.majority(votes, ["bin_id", "contig_id"], models)
    clean = aggregates.confirmed_clean(depths)
    return flagged.join(clean, ["bin_id", "contig_id"]).select("bin_id", "contig_id", (F.col("positive") & ~F.col("clean")).alias("outlier"))


def recruit(members: DataFrame, edges: DataFrame, black: DataFrame, most: int = 20, n: int | None = None) -> DataFrame:
    """(bin_id, contig_id, connections): neighbours less the black list, the best ``most`` of each bin (D-11, D-10, F-w4)."""
    return windows.top_neighbours(joins.without(joins.neighbours(members, edges, n), black, ["bin_id", "contig_id"]), most)
