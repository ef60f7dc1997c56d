"""C-1 to C-24: projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contigra.functions.scalar import any_of
from contigra.operators.windows import numbered, numbered_within


def min_length(contigs: DataFrame, least: int = 1000, group: str = "assembly", order: str = "ordinal") -> DataFrame:
    """C-1: contigs of ``least`` and more with ids ``<group>-<n>``, numbered among those kept."""
    kept = numbered_within(contigs.where(F.col("length") >= least), [group], [order], "n_n")
    return kept.select(*contigs.columns, F.concat(group, F.lit("-"), F.col("n_n").cast("string")).alias("new_id"))


def single_contig_bins(contigs: DataFrame, least: int = 500_000, group: str = "assembly", order: str = "ordinal") -> DataFrame:
    """C-2: long contigs as bins, numbered by their place among all contigs."""
    return numbered_within(contigs, [group], [order], "number").where(F.col("length") >= least)


def oversize(members: DataFrame, most: int = 30_000_000) -> DataFrame:
    """C-3: bins (with size) below ``most`` in total."""
    return members.groupBy("bin_id").agg(F.sum("length").alias("size")).where(F.col("size") < most)


def weak_bins(bins: DataFrame, quality: DataFrame, cpn: float = 5, size: int = 200_000) -> DataFrame:
    """C-4: bins that have quality, completeness over ``cpn`` and more than ``size`` bases."""
    q = quality.select("bin_id", F.coalesce("completeness", F.lit(0.0)).alias("completeness"), F.coalesce("contamination", F.lit(0.0)).alias("contamination"), F.coalesce("genome_size", F.lit(0)).alias("genome_size"))
    return bins.select("bin_id").distinct().join(q, "bin_id", "left").where((F.coalesce("completeness", F.lit(0.0)) > cpn) & (F.coalesce("genome_size", F.lit(0)) > size))


def cutoff(quality: DataFrame, least: float, most: float) -> DataFrame:
    """C-5."""
    return quality.where((F.col("completeness") >= least) & (F.col("contamination") < most))


def gate(most: float = 12, least: float = 80) -> Column:
    """C-6: the condition under which a bin is eliminated for contamination."""
    return (F.col("contamination") >= most) & (F.col("completeness") - F.col("contamination") <= least)


def gated_pairs(pairs: DataFrame, quality: DataFrame) -> DataFrame:
    """C-6: pairs (a, b) of which neither bin is eliminated."""
    bad = quality.where(gate()).select("bin_id")
    return pairs.join(bad.withColumnRenamed("bin_id", "a"), "a", "left_anti").join(bad.withColumnRenamed("bin_id", "b"), "b", "left_anti")


def self_alignments(hits: DataFrame, identity: float = 99, length: int = 500) -> DataFrame:
    """C-7: strong hits between contigs, and hits on themselves of contigs named with ``||``, once each."""
    other = (F.col("query") != F.col("subject")) & (F.col("length") >= length)
    own = (F.col("query") == F.col("subject")) & F.col("query").contains("||")
    return hits.where((F.col("identity") >= identity) & (other | own)).dropDuplicates()


def cross_alignments(hits: DataFrame, lengths: DataFrame, identity: float = 99, length: int = 1000, failed: bool = False) -> DataFrame:
    """C-8: hits that cover both contigs to one whole contig together; ``failed``: the strong hits that do not (the twin keeps them aside)."""
    one = lengths.select(F.col("contig_id").alias("query"), F.col("length").alias("len1"))
    two = lengths.select(F.col("contig_id").alias("subject"), F.col("length").alias("len2"))
    strong = hits.where((F.col("identity") >= identity) & (F.col("length") >= length))
    covers = F.col("length") / F.col("len1") + F.col("length") / F.col("len2") >= 1
    return strong.join(one, "query").join(two, "subject").where(~covers if failed else covers)


def overlap_hits(hits: DataFrame, length: int = 500, identity: float = 99) -> DataFrame:
    """C-9: hits (with qlen, slen) that touch an end of both sequences."""
    q = any_of([F.col(x).isin(1) | (F.col(x) == F.col("qlen")) for x in ("qstart", "qend")])
    s = any_of([F.col(x).isin(1) | (F.col(x) == F.col("slen")) for x in ("sstart", "send")])
    return hits.where((F.col("identity") >= identity) & (F.col("length") >= length) & q & s & (F.col("query") != F.col("subject")))


def self_connections(hits: DataFrame, identity: float = 99, length: int = 30) -> DataFrame:
    """C-10: joins of two contig ends, one row a pair, with the ends that meet."""
    end = lambda a, n: F.when(F.col(a) == 1, "s").when(F.col(a) == F.col(n), "e")
    q, s = F.coalesce(end("qstart", "qlen"), end("qend", "qlen")), F.coalesce(end("sstart", "slen"), end("send", "slen"))
    kept = hits.where((F.col("identity") >= identity) & (F.col("length") >= length) & (F.col("query") != F.col("subject")))
    return kept.withColumns({"q_end": q, "s_end": s}).where("q_end is not null and s_end is not null").withColumns({"a": F.least("query", "subject"), "b": F.greatest("query", "subject")}).dropDuplicates(["a", "b", "q_end", "s_end"])


def gap_hits(hits: DataFrame, identity: float = 85, length: int = 200, near: int = 50, contigs: int = 2) -> DataFrame:
    """C-11: hits (query a read) near an end of read and contig, of reads that reach ``contigs`` contigs."""
    lo_q, hi_q = F.least("qstart", "qend"), F.greatest("qstart", "qend")
    lo_s, hi_s = F.least("sstart", "send"), F.greatest("sstart", "send")
    kept = hits.where((F.col("identity") >= identity) & (F.col("length") >= length) & ((lo_q <= near) | (hi_q >= F.col("qlen") - near)) & ((lo_s <= near) | (hi_s >= F.col("slen") - near)))
    wide = kept.groupBy("query").agg(F.countDistinct("subject").alias("n")).where(F.col("n") >= contigs).select("query")
    return kept.join(wide, "query", "left_semi")


def covered_hits(hits: DataFrame, identity: float = 85, length: int = 200, share: float = 0.8) -> DataFrame:
    """C-12 (share 0.8) and C-13 (length 0, share 0.9): hits that cover the subject."""
    return hits.where((F.col("identity") >= identity) & (F.col("length") >= length) & (F.col("length") / F.col("slen") >= share))


def end_reads(alignments: DataFrame, lengths: DataFrame, near: int = 500) -> DataFrame:
    """C-14: alignments, not in proper pairs, whose middle is near an end of the contig."""
    middle = F.col("pos") + F.length("seq") / 2
    joined = alignments.join(lengths.select(F.col("contig_id").alias("rname"), F.col("length").alias("rlen")), "rname")
    return joined.where(~F.col("flag").isin(19, 35) & ((middle <= near) | (middle >= F.col("rlen") - near)))


#: Parts of the names of pseudo-bins.
PSEUDO = ("noclass", "unbined", "_genomes.0", "tooShort", "lowDepth")


def real_bins(df: DataFrame, name: str = "bin_id") -> DataFrame:
    """C-15."""
    return df.where(~any_of([F.col(name).contains(x) for x in PSEUDO]))


def binner_depth(wide: DataFrame, prefix: str = "X") -> DataFrame:
    """C-16: depth columns without variances, ids prefixed."""
    keep = [c for c in wide.columns[3:] if not c.endswith("-var")]
    return wide.select(F.concat(F.lit(prefix), F.col(f"`{wide.columns[0]}`")).alias("contig_id"), *[F.col(f"`{c}`") for c in keep])


def hybrid_depth(wide: DataFrame) -> tuple[DataFrame, DataFrame]:
    """C-17: columns 0-4, and 0-2 with 5-6."""
    c = wide.columns
    return wide.select(*[f"`{x}`" for x in c[:5]]), wide.select(*[f"`{x}`" for x in [*c[:3], *c[5:7]]])


def reassembled(members: DataFrame, least: int = 1000, contigs: int = 2) -> DataFrame:
    """C-18: contigs of ``least`` in bins that keep ``contigs`` of them."""
    kept = members.where(F.col("length") >= least)
    return kept.join(kept.groupBy("bin_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= contigs).select("bin_id"), "bin_id", "left_semi")


def tier(cpn: str = "completeness", ctn: str = "contamination") -> Column:
    """C-19: high from 70, medium from 50, else low, by completeness - 5 contamination."""
    score = F.col(cpn) - 5 * F.col(ctn)
    return F.when(score >= 70, "high").when(score >= 50, "medium").otherwise("low")


def read_ids(reads: DataFrame, order: str = "ordinal") -> DataFrame:
    """C-20: ids ``Seq<n>_modifiedID_<mate>/<mate>``, numbered by file and mate."""
    mate = F.col("mate").cast("string")
    name = F.concat(F.lit("Seq"), F.col("n_n").cast("string"), F.lit("_modifiedID_"), mate, F.lit("/"), mate)
    return numbered_within(reads, ["file", "mate"], [order], "n_n").select(*reads.columns, name.alias("read_id"))


def fragments(reads: DataFrame, size: int = 100) -> DataFrame:
    """C-21: whole pieces of ``size`` in pairs: odd pieces are mate 1, even mate 2; an odd last one goes."""
    pairs = F.floor(F.length("seq") / (2 * size)).cast("int")
    at = F.when(pairs > 0, F.sequence(F.lit(0), pairs * 2 - 1)).otherwise(F.array().cast("array<int>"))
    return reads.select("read_id", "seq", F.explode(at).alias("i")).select(F.concat("read_id", F.lit("_"), F.floor(F.col("i") / 2) + 1).alias("read_id"), (F.col("i") % 2 + 1).alias("mate"), F.substring("seq", F.col("i") * size + 1, F.lit(size)).alias("seq"))


def renumbered(members: DataFrame) -> DataFrame:
    """C-22: the map bin_id, contig_id -> ``bin<n>``, ``bin<n>_<m>``, in order of names."""
    bins = numbered(members.select("bin_id").distinct(), [F.asc("bin_id")])
    own = numbered_within(members.select("bin_id", "contig_id"), ["bin_id"], ["contig_id"], "m")
    return own.join(bins, "bin_id").select("bin_id", "contig_id", F.concat(F.lit("bin"), "n").alias("new_bin"), F.concat(F.lit("bin"), "n", F.lit("_"), "m").alias("new_contig"))


def shorter_variants(variants: DataFrame, targets: DataFrame) -> DataFrame:
    """C-23: variants (bin_id, variant, lines) of fewer lines than their target (bin_id, lines)."""
    return variants.join(targets.withColumnRenamed("lines", "target_lines"), "bin_id").where(F.col("lines") < F.col("target_lines"))


def unbranched(hits: DataFrame) -> DataFrame:
    """C-24: hits (contig, end, other) without those at an end of exactly two."""
    two = hits.groupBy("contig", "end").agg(F.count(F.lit(1)).alias("n")).where("n = 2").select("contig", "end")
    return hits.join(two, ["contig", "end"], "left_anti")
