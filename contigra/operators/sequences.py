"""I-6, I-7: merging overlapping sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigra.functions.scalar import reverse_complement


def merge_overlaps(hits: DataFrame, contigs: DataFrame) -> DataFrame:
    """I-6: (id ``q--s``, seq) of hits (query, subject, qstart, qend, sstart, send) that touch both ends.

    The subject is turned over if the hit is reversed; then one contains the other, or the end of one runs into the start of the other.
    Positions don't tell which way a hit of one base lies: hits may have a ``strand``, ``-`` where reversed; where that is null or missing, positions tell.
    """
    c = contigs.select("contig_id", "seq")
    j = hits.join(c.toDF("query", "q"), "query").join(c.toDF("subject", "s0"), "subject")
    n, m = F.length("q"), F.length("s0")
    back = F.col("sstart") > F.col("send")
    back = F.coalesce(F.col("strand") == "-", back) if "strand" in hits.columns else back
    j = j.withColumns({"s": F.when(back, reverse_complement("s0")).otherwise(F.col("s0")), "a": F.when(back, m - F.col("sstart") + 1).otherwise(F.col("sstart")), "b": F.when(back, m - F.col("send") + 1).otherwise(F.col("send"))})
    merged = (
        F.when((F.col("a") == 1) & (F.col("b") == m), F.col("q"))
        .when((F.col("qstart") == 1) & (F.col("qend") == n), F.col("s"))
        .when((F.col("qend") == n) & (F.col("a") == 1), F.concat("q", F.substring("s", F.col("b") + 1, m)))
        .when((F.col("qstart") == 1) & (F.col("b") == m), F.concat("s", F.substring("q", F.col("qend") + 1, n)))
    )
    return j.withColumn("merged", merged).where("merged is not null").select(F.concat("query", F.lit("--"), "subject").alias("contig_id"), F.col("merged").alias("seq"), "query", "subject")


def bridge(pairs: DataFrame) -> DataFrame:
    """I-7: (id, seq) of two contigs (seq1, seq2, strand1, strand2) over a read: read bases between read_end1 and read_start2 fill the gap.

    Contigs that overlap on the read are joined at read_end1: the second loses the overlapping bases.
    """
    one = F.when(F.col("strand1") == "-", reverse_complement("seq1")).otherwise(F.col("seq1"))
    two = F.when(F.col("strand2") == "-", reverse_complement("seq2")).otherwise(F.col("seq2"))
    gap = F.col("read_start2") - F.col("read_end1") - 1
    seq = F.when(gap >= 0, F.concat(one, F.substring("read", F.col("read_end1") + 1, gap), two)).otherwise(F.concat(one, F.substring(two, 1 - gap, F.length(two))))
    return pairs.select(F.concat("contig1", F.lit("--"), "contig2").alias("contig_id"), seq.alias("seq"))
