"""Similarity, roads without overlaps, elongated sequences and interval joins on the driver's tables.

Importing this module adds to ``QUERIES`` and ``SQL`` of ``contigra.queries``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigra import hit_queries as H
from contigra.functions import scalar as S
from contigra.operators import filters as C
from contigra.operators import graph as J
from contigra.operators import joins as D
from contigra.operators import ml as K
from contigra.operators import selection as G
from contigra.operators import similarity
from contigra.queries import SQL, WITH, Tables, query, stats_sql
from contigra.streaming import edges as L


@query("d19_similar")
def d19_similar(t: Tables) -> DataFrame:
    """Benchmark items against all documents; no SQL: tests hold it against plain loops."""
    return similarity.similar(t.benchmark.select(F.col("item_id").alias("id"), F.col("text").alias("seq")), t.documents.select(F.col("doc_id").alias("id"), F.col("text").alias("seq")))


@query(
    "d21_overlapping",
    """, one AS (SELECT l_orderkey AS a, l_partkey % 100 AS k, CAST(l_suppkey * 10 AS BIGINT) AS lo, CAST(l_suppkey * 10 + l_quantity AS BIGINT) AS hi FROM lineitem),
two AS (SELECT p_partkey AS b, p_partkey % 100 AS k, CAST(10 * (p_partkey % 97) AS BIGINT) AS lo, CAST(10 * (p_partkey % 97) + p_size * p_size AS BIGINT) AS hi FROM part)
SELECT a, k, count(*) AS pairs, CAST(sum(least(one.hi, two.hi) - greatest(one.lo, two.lo) + 1) AS BIGINT) AS bases FROM one JOIN two USING (k) WHERE one.lo <= two.hi AND two.lo <= one.hi GROUP BY 1, 2""",
)
def d21(t: Tables) -> DataFrame:
    """Ranges of all line items against ranges of parts, most of which begin or end where others do: parts of one range are met once, by their number."""
    one = t.lineitem.select(F.col("l_orderkey").alias("a"), (F.col("l_partkey") % 100).alias("k"), (F.col("l_suppkey") * 10).alias("lo1"), (F.col("l_suppkey") * 10 + F.col("l_quantity")).cast("long").alias("hi1"))
    low = 10 * (F.col("p_partkey") % 97)
    two = t.part.select((F.col("p_partkey") % 100).alias("k"), low.alias("lo2"), (low + F.col("p_size") * F.col("p_size")).cast("long").alias("hi2"))
    two = two.groupBy("k", "lo2", "hi2").agg(F.count(F.lit(1)).alias("w"))
    pairs = D.overlapping(one, two, ["k"], ("lo1", "hi1"), ("lo2", "hi2"))
    bases = F.least("hi1", "hi2") - F.greatest("lo1", "lo2") + 1
    return pairs.groupBy("a", "k").agg(F.sum("w").alias("pairs"), F.sum(F.col("w") * bases).alias("bases"))


@query("j11_scheduled")
def j11_scheduled(t: Tables) -> DataFrame:
    """The total score of each order's schedule, and how many neighbours in it overlap (none); SQL tries every chain."""
    hits = t.lineitem.select(F.col("l_orderkey").alias("read_id"), F.col("l_linenumber").alias("contig_id"), F.col("l_suppkey").cast("long").alias("start"), (F.col("l_suppkey") + F.col("l_quantity")).cast("long").alias("end"), F.round("l_extendedprice").cast("long").alias("score"))
    road = J.scheduled(hits).groupBy("read_id").agg(F.sum("score").alias("total"), F.sort_array(F.collect_list(F.struct("start", "end"))).alias("h"))
    lapped = F.size(F.filter(F.zip_with(F.slice("h", 2, F.size("h")), "h", lambda after, before: after["start"] <= before["end"]), lambda x: x)).cast("long")
    return road.select("read_id", "total", lapped.alias("overlaps"))

SQL["j11_scheduled"] = (
    WITH.replace("WITH mem_a", "WITH RECURSIVE mem_a", 1)
    + """, road AS (SELECT l_orderkey AS read_id, l_linenumber AS n, CAST(l_suppkey AS BIGINT) AS lo, CAST(l_suppkey + l_quantity AS BIGINT) AS hi, CAST(round(l_extendedprice) AS BIGINT) AS score FROM lineitem),
chain AS (SELECT read_id, hi, score AS total FROM road UNION ALL SELECT c.read_id, h.hi, c.total + h.score FROM chain c JOIN road h ON c.read_id = h.read_id AND h.lo > c.hi)
SELECT read_id, CAST(max(total) AS BIGINT) AS total, 0::BIGINT AS overlaps FROM chain GROUP BY 1"""
)


@query("j08_elongated", "SELECT 's' || doc_id || '-0' AS target, CAST(ceil(length(text) / 500) AS BIGINT) AS contigs, CAST(length(text) AS BIGINT) AS length, md5(text) AS digest FROM documents WHERE length(text) > 0")
def j08_elongated(t: Tables) -> DataFrame:
    """Each text cut into pieces of 500 characters that run 20 on into the next; a shorter overlap leads astray.  The first piece grows back to the text."""
    d = t.documents.where(F.length("text") > 0).select("doc_id", "text", F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / 500).cast("int"))).alias("i"))
    name = lambda i: F.concat(F.lit("s"), F.col("doc_id").cast("string"), F.lit("-"), i.cast("string"))
    contigs = d.select("doc_id", "i", name(F.col("i")).alias("contig_id"), F.expr("substring(text, i * 500 + 1, 520)").alias("seq"), F.length("text").alias("n"))
    lap = F.least(F.lit(20), F.col("n") - 500 * (F.col("i") + 1))
    next_ = contigs.where(500 * (F.col("i") + 1) < F.col("n")).select(F.col("contig_id").alias("query"), name(F.col("i") + 1).alias("subject"), lap.alias("length"), "doc_id", "n", "i")
    astray = next_.select("query", name(F.col("i") * 0).alias("subject"), F.lit(0).alias("length"))
    got = J.elongated(contigs.where("i = 0"), next_.select("query", "subject", "length").union(astray), contigs)
    return got.select("target", F.col("contigs").cast("long").alias("contigs"), F.col("length").cast("long").alias("length"), F.md5(F.col("seq").cast("binary")).alias("digest"))


@query("k03_kmer_outliers")
def k03_kmer(t: Tables) -> DataFrame:
    """K-3 in its production width: frequencies of 256 4-mers of all documents, candidates being the neighbours of each source's own along the
    chain of ids; no SQL (256 dimensions): tests hold it against numpy."""
    v = t.documents.select(F.col("source").alias("bin_id"), F.col("doc_id").alias("contig_id"), S.kmer_vector(F.upper("text"), 4, 500).alias("vector")).where("vector is not null")
    chain = t.documents.select(F.col("doc_id").alias("node1"), (F.col("doc_id") + 1).alias("node2"), F.lit(1).cast("long").alias("connections"))
    near = D.neighbours(v.select("bin_id", "contig_id"), chain)
    return K.candidate_outliers(v, near.select("bin_id", "contig_id").join(v.select("contig_id", "vector"), "contig_id").select("bin_id", "contig_id", "vector")).select("bin_id", "contig_id", "outlier")


@query(
    "i08_kmer_frequencies",
    """, mers AS (SELECT doc_id, upper(substr(text, CAST(i AS BIGINT), 4)) AS m FROM (SELECT doc_id, text, unnest(range(1, length(text) - 2)) AS i FROM documents WHERE length(text) >= 500)),
seen AS (SELECT doc_id, m, count(*) AS n FROM mers WHERE regexp_full_match(m, '[ACGT]{4}') GROUP BY 1, 2), both_s AS (SELECT doc_id, m, n FROM seen UNION ALL SELECT doc_id, reverse(translate(m, 'ACGT', 'TGCA')), n FROM seen),
total AS (SELECT doc_id, sum(n) AS t FROM both_s GROUP BY 1) SELECT doc_id, m AS kmer, round(sum(n) / any_value(t), 6) AS share FROM both_s JOIN total USING (doc_id) GROUP BY 1, 2""",
)
def i08_wide(t: Tables) -> DataFrame:
    """I-8 with its defaults, 256 4-mers of texts of 500 characters and more; those that occur."""
    v = t.documents.select("doc_id", S.kmer_vector(F.upper("text")).alias("v")).where("v is not null")
    names = F.array(*map(F.lit, S.all_kmers(4)))
    return v.select("doc_id", F.posexplode("v").alias("i", "share")).where("share > 0").select("doc_id", names[F.col("i")].alias("kmer"), F.round("share", 6).alias("share"))


@query("j03_reach_all", " SELECT bin_id, contig_id, min(level) AS level FROM (SELECT bin_id, contig_id, 0 AS level FROM brands UNION ALL SELECT b.bin_id, e.node2, 1 FROM brands b JOIN both_e e ON b.contig_id = e.node1 UNION ALL SELECT bin_id, f.node2, 2 FROM (SELECT DISTINCT b.bin_id, e.node2 FROM brands b JOIN both_e e ON b.contig_id = e.node1) x JOIN both_e f ON x.node2 = f.node1 UNION ALL SELECT bin_id, g.node2, 3 FROM (SELECT DISTINCT bin_id, f.node2 FROM (SELECT DISTINCT b.bin_id, e.node2 FROM brands b JOIN both_e e ON b.contig_id = e.node1) x JOIN both_e f ON x.node2 = f.node1) y JOIN both_e g ON y.node2 = g.node1) GROUP BY 1, 2")
def j03_all(t: Tables) -> DataFrame:
    """J-2 and J-3 over all edges and three hops."""
    return J.reach(t.brands(), t.edges(), 3, t.tasks)


_REACHED = "SELECT bin_id, contig_id, min(level) AS level FROM (SELECT bin_id, contig_id, 0 AS level FROM brands UNION ALL SELECT b.bin_id, e.node2, 1 FROM brands b JOIN both_e e ON b.contig_id = e.node1 UNION ALL SELECT bin_id, f.node2, 2 FROM (SELECT DISTINCT b.bin_id, e.node2 FROM brands b JOIN both_e e ON b.contig_id = e.node1) x JOIN both_e f ON x.node2 = f.node1 UNION ALL SELECT bin_id, g.node2, 3 FROM (SELECT DISTINCT bin_id, f.node2 FROM (SELECT DISTINCT b.bin_id, e.node2 FROM brands b JOIN both_e e ON b.contig_id = e.node1) x JOIN both_e f ON x.node2 = f.node1) y JOIN both_e g ON y.node2 = g.node1) GROUP BY 1, 2"


@query("j10_retrieval_all", f", found AS ({_REACHED}) SELECT bin_id, contig_id, level, cutoff FROM found JOIN depth USING (contig_id) JOIN fence USING (bin_id, sample_idx) CROSS JOIN (SELECT unnest([1.0::DOUBLE, 1.2, 1.5]) AS cutoff) WHERE level > 0 GROUP BY 1, 2, 3, 4 HAVING bool_and(depth >= q1 - cutoff * (q3 - q1) AND depth <= q3 + cutoff * (q3 - q1))")
def j10_all(t: Tables) -> DataFrame:
    """J-10 over all edges, three levels and three cutoffs."""
    return J.retrieval(t.brands(), t.edges(), t.depth(), n=t.tasks)


@H.hit_query("g05_twin", " SELECT trial, CASE WHEN cpn - ctn > cpn0 - ctn0 AND cpn - 5 * ctn >= cpn0 - 5 * ctn0 THEN 'accept' WHEN cpn - ctn > cpn0 - ctn0 THEN 'deep' WHEN cpn > cpn0 AND cpn0 >= 40 AND ctn0 <= 10 AND ctn <= 50 THEN 'deep' WHEN (cpn - 5 * ctn < cpn0 - 5 * ctn0 OR cpn < cpn0) AND cpn0 >= 40 AND ctn0 <= 15 AND ctn <= 50 THEN 'deep' ELSE 'keep' END AS verdict FROM trials")
def g05_twin(t: Tables) -> DataFrame:
    """The second scorer's queue of refined bins."""
    return G.refined(H.trials(t), twin=True).select("trial", "verdict")


@H.hit_query("c08_failed", ", lens AS (SELECT p_partkey AS contig_id, CAST(p_size * 40 AS BIGINT) AS len FROM part) SELECT query, subject, a.length, count(*) AS hits FROM aln a JOIN lens x ON query = x.contig_id JOIN lens y ON subject = y.contig_id WHERE identity >= 95 AND a.length >= 500 AND a.length / x.len + a.length / y.len < 1 GROUP BY 1, 2, 3")
def c08_failed(t: Tables) -> DataFrame:
    """The second scorer's side file: strong alignments that don't cover both contigs."""
    lengths = t.part.select(F.col("p_partkey").alias("contig_id"), (F.col("p_size") * 40).cast("long").alias("length"))
    return C.cross_alignments(H.alignments(t), lengths, 95, 500, failed=True).groupBy("query", "subject", "length").agg(F.count(F.lit(1)).alias("hits"))


@query("l01_mate_pairs", " SELECT a.l_orderkey AS read_id, a.l_partkey AS node1, b.l_partkey AS node2, CAST(greatest(a.l_shipdate, b.l_shipdate) AS VARCHAR) AS at FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = 1 AND b.l_linenumber = 2 AND b.l_shipdate BETWEEN a.l_shipdate - INTERVAL 30 DAY AND a.l_shipdate + INTERVAL 30 DAY")
def l01(t: Tables) -> DataFrame:
    """D-14 as a stream: the first two line items of an order are mates, which meet if they ship within 30 days."""
    base = f"{J.shared_folder(t.spark)}/stream-{uuid.uuid4().hex}"
    t.lineitem.where("l_linenumber <= 2").select(F.col("l_orderkey").alias("read_id"), F.col("l_linenumber").alias("mate"), F.col("l_partkey").alias("contig_id"), F.col("l_shipdate").cast("timestamp").alias("ts")).write.parquet(f"{base}/in")
    schema = "read_id long, mate int, contig_id long, ts timestamp"
    L.run_available(L.mate_pairs(t.spark.readStream.schema(schema).parquet(f"{base}/in"), "ts", "30 days"), f"{base}/out", f"{base}/state")
    return t.spark.read.schema("read_id long, node1 long, node2 long, at timestamp").parquet(f"{base}/out").withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss"))


_SCALED = f"SELECT bin_id, contig_id, i, v[i] AS x FROM (SELECT *, unnest(range(1, 20)) AS i FROM (SELECT bin_id, contig_id, list_concat(list_concat(d, {stats_sql('d')}), k) AS v FROM (SELECT p_brand AS bin_id, p_partkey AS contig_id, [CAST(p_size AS DOUBLE), CAST(p_retailprice AS DOUBLE), CAST(p_partkey % 7 AS DOUBLE)] AS d, [p_size / 50] AS k FROM part)))"


@H.hit_query("k05_scaled_features", f", raw AS ({_SCALED}) SELECT contig_id, i - 1 AS place, round(abs(x - m) / (greatest(hi - m, m - lo) + 1e-8), 3) + 0.0::DOUBLE AS value FROM (SELECT *, avg(x) OVER w AS m, min(x) OVER w AS lo, max(x) OVER w AS hi FROM raw WINDOW w AS (PARTITION BY bin_id, i))")
def k05_scaled(t: Tables) -> DataFrame:
    """K-5 with its scaling by bin; components of more than five samples are tested against numpy."""
    depths = F.array(F.col("p_size").cast("double"), F.col("p_retailprice").cast("double"), (F.col("p_partkey") % 7).cast("double"))
    c = t.part.select(F.col("p_brand").alias("bin_id"), F.col("p_partkey").alias("contig_id"), depths.alias("depths"), F.array(F.col("p_size") / 50).alias("kmers"))
    return K.scaled_features(c, 3).select("contig_id", F.posexplode("vector").alias("place", "value")).withColumn("value", F.round("value", 3) + 0.0)


@query("k05_components")
def k05_components(t: Tables) -> DataFrame:
    """K-5 of more than five samples: quantities of a part by line number are its depths in seven samples, scaled by brand and replaced by three
    components over all parts; no SQL (principal axes): tests hold it against numpy."""
    sold = t.lineitem.groupBy(F.col("l_partkey").alias("contig_id")).agg(*[F.sum(F.when(F.col("l_linenumber") == i, F.col("l_quantity")).otherwise(0)).cast("double").alias(f"d{i}") for i in range(1, 8)])
    parts = t.part.select(F.col("p_brand").alias("bin_id"), F.col("p_partkey").alias("contig_id"), F.array(F.col("p_size") / 50).alias("kmers"))
    c = parts.join(sold, "contig_id").select("bin_id", "contig_id", F.array(*[f"d{i}" for i in range(1, 8)]).alias("depths"), "kmers")
    return K.scaled_features(c, 7).select("contig_id", F.posexplode("vector").alias("place", "value")).withColumn("value", F.round("value", 6) + 0.0)
