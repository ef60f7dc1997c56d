"""G-1 to G-19: one of two candidates.  Order-dependent folds get an explicit ordinal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contigra.functions.scalar import delta, lineage_weight
from contigra.operators.joins import join_heavy


def within_assembly() -> Column:
    """G-1: 1 or 2 for a pair (cpn1, ctn1, size1, ...): larger completeness - contamination, then strictly larger genome, else 2."""
    d1, d2 = delta("cpn1", "ctn1"), delta("cpn2", "ctn2")
    return F.when(d1 > d2, 1).when(d1 < d2, 2).when(F.col("size1") > F.col("size2"), 1).otherwise(2)


def across_assemblies() -> Column:
    """G-2: by completeness - 5 contamination; a tie of equal size and N50 goes to 1, any other is undecided (0)."""
    d1, d2 = delta("cpn1", "ctn1", 5), delta("cpn2", "ctn2", 5)
    same = (F.col("size1") == F.col("size2")) & (F.col("n50_1") == F.col("n50_2"))
    return F.when(d1 > d2, 1).when(d1 < d2, 2).when(same, 1).otherwise(0)


def fold(pairs: DataFrame) -> DataFrame:
    """G-3: (bin_id, selected) by the last say of each bin: pairs (ordinal, bin1, bin2, winner) in order, winning un-eliminates."""
    say = pairs.where("winner > 0").select("ordinal", F.explode(F.array(F.struct(F.col("bin1").alias("bin_id"), (F.col("winner") == 1).alias("won")), F.struct(F.col("bin2").alias("bin_id"), (F.col("winner") == 2).alias("won")))).alias("s"))
    return say.groupBy("s.bin_id").agg(F.max_by("s.won", F.struct("ordinal", "s.won")).alias("selected"))


def survivors(bins: DataFrame, pairs: DataFrame) -> DataFrame:
    """G-4 and H-2: bins that lost no pair."""
    lost = pairs.where("winner > 0").select(F.when(F.col("winner") == 1, F.col("bin2")).otherwise(F.col("bin1")).alias("bin_id")).distinct()
    return bins.join(lost, "bin_id", "left_anti")


def refined(pairs: DataFrame, twin: bool = False) -> DataFrame:
    """G-5: (…, verdict): accept, deep or keep of a refined bin (cpn, ctn) against the original (cpn0, ctn0).

    ``twin``: bins that lost score or completeness are queued too if the original is good enough.
    """
    d, d0, w, w0 = delta("cpn", "ctn"), delta("cpn0", "ctn0"), delta("cpn", "ctn", 5), delta("cpn0", "ctn0", 5)
    queue = (F.col("cpn") > F.col("cpn0")) & (F.col("cpn0") >= 40) & (F.col("ctn0") <= 10) & (F.col("ctn") <= 50)
    if twin:
        queue = queue | (((w < w0) | (F.col("cpn") < F.col("cpn0"))) & (F.col("cpn0") >= 40) & (F.col("ctn0") <= 15) & (F.col("ctn") <= 50))
    return pairs.withColumn("verdict", F.when((d > d0) & (w >= w0), "accept").when(d > d0, "deep").when(queue, "deep").otherwise("keep"))


def contig_status(trials: DataFrame) -> DataFrame:
    """G-6: Positive or Neutral for each contig tried alone; worse ones have no row."""
    w, w0 = delta("cpn", "ctn", 5), delta("cpn0", "ctn0", 5)
    return trials.withColumn("status", F.when(w > w0, "Positive").when(w == w0, "Neutral")).where("status is not null")


def deep_choice(variants: DataFrame) -> DataFrame:
    """G-7: the best of the numbered variants of a bin by completeness - 5 contamination; a tie below 85 goes to the lower number."""
    tie = F.when(F.col("completeness") < 85, -F.col("number")).otherwise(F.col("number"))
    return _best(variants, F.struct(delta("completeness", "contamination", 5), tie))


def rolled_back(pairs: DataFrame) -> DataFrame:
    """G-8: (…, keep_original) where the original scores strictly more."""
    return pairs.withColumn("keep_original", delta("cpn0", "ctn0", 5) > delta("cpn", "ctn", 5))


def _best(df: DataFrame, order: Column, key: str = "bin_id") -> DataFrame:
    """By key, the row that is last in ``order``, then in its columns from the left."""
    row = F.struct(*[c for c in df.columns if c != key])
    return df.withColumn("o_", order).groupBy(key).agg(F.max_by(row, F.struct("o_", row)).alias("r_")).select(key, "r_.*")


def best_variant(variants: DataFrame, key: str = "bin_id") -> DataFrame:
    """G-9 and G-10: by completeness - 5 contamination, then dots in the name, then threshold ``1``, then the last name."""
    dots = F.length("variant") - F.length(F.replace("variant", F.lit("."), F.lit("")))
    return _best(variants, F.struct(delta("completeness", "contamination", 5), dots, (F.col("threshold") == "1").cast("int"), F.col("variant")), key)


def reassembly_choice(candidates: DataFrame, margin: float = 3.0) -> DataFrame:
    """G-11: by completeness - 5 contamination, then N50; an IDBA assembly must win by ``margin``."""
    handicap = F.when(F.col("assembler") == "IDBA", margin).otherwise(0.0)
    return _best(candidates, F.struct(delta("completeness", "contamination", 5) - handicap, F.when(F.col("assembler") != "IDBA", 1).otherwise(0), "n50", "assembler"))


def hybrid_choice(candidates: DataFrame, gate: float = 40.0) -> DataFrame:
    """G-12: as G-11 from ``gate`` points on, else by completeness - contamination; IDBA leads of 3 to 6 need half the best N50."""
    five = delta("completeness", "contamination", 5)
    best = candidates.where("assembler <> 'IDBA'").groupBy("bin_id").agg(F.max("n50").alias("top_n50"), F.max(five).alias("top_five"))
    j = candidates.join(best, "bin_id", "left")
    lead = five - F.coalesce("top_five", F.lit(-1e9))
    fair = (F.col("assembler") != "IDBA") | F.col("top_five").isNull() | (lead >= 6) | ((lead >= 3) & (F.try_divide("n50", "top_n50") >= 0.5))
    score = F.when(five >= gate, 1000 + five).otherwise(delta("completeness", "contamination"))
    return _best(j.where(fair).drop("top_n50", "top_five"), F.struct(score, F.col("n50"), F.col("assembler")))


def polished(pairs: DataFrame) -> DataFrame:
    """G-13: (…, accepted) where contamination did not grow."""
    return pairs.withColumn("accepted", F.col("ctn") <= F.col("ctn0"))


def merge_candidates(pairs: DataFrame, most: float = 105) -> DataFrame:
    """G-14: pairs alike in coverage (``alike``), of one lineage, whose completeness sums to ``most`` at most."""
    return pairs.where(F.col("alike") & (F.col("lineage1") == F.col("lineage2")) & (F.col("cpn1") + F.col("cpn2") <= most))


def similar_bins(log: DataFrame, quality: DataFrame, most: float = 5) -> DataFrame:
    """G-15: (bin_id, component, partners): the cluster of each bin of the log (a, b), and how many other bins of contamination
    ``most`` and less it has there.  Those are the cluster's rows; they are never expanded into pairs.
    """
    from contigra.operators.graph import connected_components

    c = connected_components(log).withColumnRenamed("node", "bin_id")
    good = quality.select("bin_id", (F.col("contamination") <= most).cast("long").alias("good"))
    c = c.join(good, "bin_id", "left").select("bin_id", "component", F.coalesce("good", F.lit(0)).alias("good"))
    size = c.groupBy("component").agg(F.sum("good").alias("all_"), F.count(F.lit(1)).alias("w"))
    joined = join_heavy(c, size, ["component"], "w", c.count())
    return joined.select("bin_id", "component", (F.col("all_") - F.col("good")).alias("partners"))


def settled_ties(ties: DataFrame, quality: DataFrame) -> DataFrame:
    """G-16: ties (bin1, bin2) judged anew with later quality; winner 0 stays for the remap test (E-26)."""
    from contigra.operators.joins import pair_quality

    return pair_quality(ties, quality).withColumn("winner", across_assemblies())


def merged_ties(ties: DataFrame, quality: DataFrame, depths: DataFrame, most: float = 20) -> DataFrame:
    """G-16 with E-26: (bin1, bin2, winner): ties judged anew, and of those still undecided the first bin where depths do not object.

    depths: bin1, bin2, sample_idx, depth1, depth2 of the ties.
    """
    from contigra.operators.aggregates import veto

    judged = settled_ties(ties, quality).select("bin1", "bin2", "winner")
    alike = veto(depths, most).withColumn("alike", F.lit(True))
    return judged.join(alike, ["bin1", "bin2"], "left").select("bin1", "bin2", F.when((F.col("winner") == 0) & F.col("alike"), 1).otherwise(F.col("winner")).alias("winner"))


def by_lineage(multiply: bool = False) -> Column:
    """G-17: 1, 2: higher lineage weight, then difference, then size over connections, then size; ``multiply``: weight times difference."""
    w1, w2 = lineage_weight("lineage1"), lineage_weight("lineage2")
    d1, d2 = delta("cpn1", "ctn1"), delta("cpn2", "ctn2")
    if multiply:
        return F.when(w1 * d1 >= w2 * d2, 1).otherwise(2)
    r1, r2 = F.try_divide(F.col("size1"), F.col("connections1")), F.try_divide(F.col("size2"), F.col("connections2"))
    return F.when(w1 > w2, 1).when(w1 < w2, 2).when(d1 > d2, 1).when(d1 < d2, 2).when(r1 > r2, 1).when(r1 < r2, 2).when(F.col("size1") > F.col("size2"), 1).otherwise(2)


def across_by_lineage(final: bool = False) -> Column:
    """The twin of G-2: bins of equal lineage weight by completeness - 5 contamination (0: undecided), others by weight times that.

    ``final``: of unequal weights the higher one wins outright.
    """
    w1, w2 = lineage_weight("lineage1"), lineage_weight("lineage2")
    d1, d2 = delta("cpn1", "ctn1", 5), delta("cpn2", "ctn2", 5)
    apart = F.when(w1 > w2, 1).otherwise(2) if final else F.when(w1 * d1 >= w2 * d2, 1).otherwise(2)
    return F.when(w1 == w2, across_assemblies()).otherwise(apart)


def longest_merge(merges: DataFrame) -> DataFrame:
    """G-18: by contig, the merge of the longest id."""
    return merges.groupBy("contig_id").agg(F.max_by("merged", F.struct(F.length("merged"), "merged")).alias("merged"))


def final_ties(pairs: DataFrame, final: bool) -> DataFrame:
    """G-19: exact ties (winner 0): in the final step the first bin goes, before it they are only listed."""
    return pairs.withColumn("winner", F.when((F.col("winner") == 0) & F.lit(final), 2).otherwise(F.col("winner")))
