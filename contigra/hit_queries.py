"""More operators on the driver's tables: alignments, variants, read ends and graphs, each with the same query in SQL.

Line items stand for alignments (part against supplier number, both ids of contigs), parts for variants of the bin
that their brand names.  Importing this module adds to ``QUERIES`` and ``SQL`` of ``contigra.queries``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigra.functions import scalar as S
from contigra.operators import aggregates as A
from contigra.operators import filters as C
from contigra.operators import graph as J
from contigra.operators import joins as D
from contigra.operators import ml as K
from contigra.operators import selection as G
from contigra.operators import sets as H
from contigra.queries import SQL, WITH, Tables, query, stats_sql

HITS = WITH + """, aln AS (SELECT *, qstart + length - 1 AS qend, sstart + length - 1 AS send FROM (SELECT *, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 1 + 5 * (l_linenumber - 1) END AS qstart, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 1 + slen - length ELSE 1 + 10 * (l_orderkey % 3) END AS sstart
  FROM (SELECT *, length + 10 * (l_linenumber - 1) AS qlen, length + 20 * (l_orderkey % 3) AS slen FROM (SELECT l_orderkey, l_linenumber, l_linestatus, l_returnflag, l_partkey AS query, l_suppkey AS subject, round(100 - 100 * l_tax, 2) AS identity, CAST(l_quantity * 40 AS BIGINT) AS length FROM lineitem)))),
ends AS (SELECT l_partkey AS contig, CASE WHEN l_linestatus = 'F' THEN 's' ELSE 'e' END AS "end", l_suppkey AS other FROM lineitem),
variants AS (SELECT p_brand AS bin_id, p_partkey AS number, 2.0 * p_size AS completeness, CAST(p_partkey % 7 AS DOUBLE) AS contamination, CAST(p_partkey % 1000 AS BIGINT) AS n50, CASE p_partkey % 3 WHEN 0 THEN 'IDBA' WHEN 1 THEN 'SPAdes' ELSE 'MEGAHIT' END AS assembler FROM part),
trials AS (SELECT p_partkey AS trial, 2.0 * p_size AS cpn, CAST(p_partkey % 60 AS DOUBLE) AS ctn, CAST(2 * (p_partkey % 50) AS DOUBLE) AS cpn0, CAST(p_partkey % 13 AS DOUBLE) AS ctn0 FROM part),
hit_pairs AS (SELECT query, subject, sum(length * identity / 100) AS aligned FROM aln GROUP BY 1, 2),
bin_hits AS (SELECT least(a.bin_id, b.bin_id) AS bin1, greatest(a.bin_id, b.bin_id) AS bin2, round(sum(aligned), 2) AS aligned FROM hit_pairs JOIN brands a ON query = a.contig_id JOIN brands b ON subject = b.contig_id WHERE a.bin_id <> b.bin_id GROUP BY 1, 2)
"""


def hit_query(name: str, sql: str):
    def register(f):
        query(name)(f)
        SQL[name] = HITS + sql
        return f

    return register


def alignments(t: Tables) -> DataFrame:
    ln, ok = F.col("l_linenumber") - 1, F.col("l_orderkey") % 3
    a = t.lineitem.select("l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag", F.col("l_partkey").alias("query"), F.col("l_suppkey").alias("subject"), F.round(100 - 100 * F.col("l_tax"), 2).alias("identity"), (F.col("l_quantity") * 40).cast("long").alias("length"))
    a = a.withColumns({"qlen": F.col("length") + 10 * ln, "slen": F.col("length") + 20 * ok, "qstart": F.when(F.col("l_linestatus") == "F", F.lit(1)).otherwise(1 + 5 * ln).cast("long")})
    a = a.withColumn("sstart", F.when(F.col("l_returnflag") == "A", F.lit(1)).when(F.col("l_returnflag") == "N", 1 + F.col("slen") - F.col("length")).otherwise(1 + 10 * ok))
    return a.withColumns({"qend": F.col("qstart") + F.col("length") - 1, "send": F.col("sstart") + F.col("length") - 1})


def ends(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_partkey").alias("contig"), F.when(F.col("l_linestatus") == "F", "s").otherwise("e").alias("end"), F.col("l_suppkey").alias("other"))


def variants(t: Tables) -> DataFrame:
    p = F.col("p_partkey")
    return t.part.select(F.col("p_brand").alias("bin_id"), p.alias("number"), (2.0 * F.col("p_size")).alias("completeness"), (p % 7).cast("double").alias("contamination"), (p % 1000).alias("n50"), F.when(p % 3 == 0, "IDBA").when(p % 3 == 1, "SPAdes").otherwise("MEGAHIT").alias("assembler"))


def trials(t: Tables) -> DataFrame:
    p = F.col("p_partkey")
    return t.part.select(p.alias("trial"), (2.0 * F.col("p_size")).alias("cpn"), (p % 60).cast("double").alias("ctn"), (2 * (p % 50)).cast("double").alias("cpn0"), (p % 13).cast("double").alias("ctn0"))


@hit_query("c07_self_alignments", """SELECT DISTINCT q AS query, s AS subject, identity, length FROM (SELECT *, CASE WHEN l_linenumber = 1 AND l_linestatus = 'F' THEN q ELSE CAST(subject AS VARCHAR) END AS s FROM (SELECT *, CAST(query AS VARCHAR) || CASE WHEN l_linenumber = 1 THEN '||' ELSE '' END AS q FROM aln)) WHERE identity >= 99 AND ((q <> s AND length >= 500) OR (q = s AND contains(q, '||')))""")
def c07(t: Tables) -> DataFrame:
    first = F.col("l_linenumber") == 1
    a = alignments(t).withColumn("query", F.concat(F.col("query").cast("string"), F.when(first, "||").otherwise("")))
    return C.self_alignments(a.select("query", F.when(first & (F.col("l_linestatus") == "F"), F.col("query")).otherwise(F.col("subject").cast("string")).alias("subject"), "identity", "length"))


@hit_query("c08_cross_alignments", "SELECT l_orderkey, l_linenumber, query, subject, a.length AS len1, b.length AS len2 FROM aln JOIN (SELECT p_partkey AS c, p_size * 50 AS length FROM part) a ON query = a.c JOIN (SELECT p_partkey AS c, p_size * 50 AS length FROM part) b ON subject = b.c WHERE identity >= 99 AND aln.length >= 1000 AND aln.length / a.length + aln.length / b.length >= 1")
def c08(t: Tables) -> DataFrame:
    lengths = t.part.select(F.col("p_partkey").alias("contig_id"), (F.col("p_size") * 50).alias("length"))
    return C.cross_alignments(alignments(t), lengths).select("l_orderkey", "l_linenumber", "query", "subject", "len1", "len2")


@hit_query("c09_overlap_hits", "SELECT l_orderkey, l_linenumber, query, subject FROM aln WHERE length >= 500 AND identity >= 99 AND query <> subject AND (qstart IN (1, qlen) OR qend IN (1, qlen)) AND (sstart IN (1, slen) OR send IN (1, slen))")
def c09(t: Tables) -> DataFrame:
    return C.overlap_hits(alignments(t)).select("l_orderkey", "l_linenumber", "query", "subject")


@hit_query("c10_self_connections", """SELECT DISTINCT least(query, subject) AS a, greatest(query, subject) AS b, q_end, s_end FROM (SELECT *, coalesce(CASE WHEN qstart = 1 THEN 's' WHEN qstart = qlen THEN 'e' END, CASE WHEN qend = 1 THEN 's' WHEN qend = qlen THEN 'e' END) AS q_end, coalesce(CASE WHEN sstart = 1 THEN 's' WHEN sstart = slen THEN 'e' END, CASE WHEN send = 1 THEN 's' WHEN send = slen THEN 'e' END) AS s_end FROM aln) WHERE identity >= 99 AND length >= 30 AND query <> subject AND q_end IS NOT NULL AND s_end IS NOT NULL""")
def c10(t: Tables) -> DataFrame:
    return C.self_connections(alignments(t)).select("a", "b", "q_end", "s_end")


@hit_query("c11_gap_hits", "SELECT l_orderkey, l_linenumber, query, subject FROM (SELECT *, min(subject) OVER (PARTITION BY query) AS lo, max(subject) OVER (PARTITION BY query) AS hi FROM aln WHERE identity >= 95 AND length >= 200 AND (qstart <= 5 OR qend >= qlen - 5) AND (sstart <= 5 OR send >= slen - 5)) WHERE lo < hi")
def c11(t: Tables) -> DataFrame:
    return C.gap_hits(alignments(t), identity=95, near=5).select("l_orderkey", "l_linenumber", "query", "subject")


@hit_query("c12_covering_hits", "SELECT l_orderkey, l_linenumber, query, subject FROM aln WHERE identity >= 95 AND length >= 200 AND length / slen >= 0.98")
def c12(t: Tables) -> DataFrame:
    return C.covered_hits(alignments(t), identity=95, share=0.98).select("l_orderkey", "l_linenumber", "query", "subject")


@hit_query("c13_extra_contigs", "SELECT l_orderkey, l_linenumber, query, subject FROM aln WHERE identity >= 95 AND length / slen >= 0.9")
def c13(t: Tables) -> DataFrame:
    return C.covered_hits(alignments(t), identity=95, length=0, share=0.9).select("l_orderkey", "l_linenumber", "query", "subject")


@hit_query("c14_end_reads", "SELECT doc_id, source AS rname FROM (SELECT *, doc_id % 3000 + length(text) / 2 AS middle FROM documents) WHERE 16 + doc_id % 20 NOT IN (19, 35) AND (middle <= 500 OR middle >= 3500)")
def c14(t: Tables) -> DataFrame:
    a = t.documents.select("doc_id", F.col("source").alias("rname"), (16 + F.col("doc_id") % 20).alias("flag"), (F.col("doc_id") % 3000).alias("pos"), F.col("text").alias("seq"))
    lengths = t.documents.select(F.col("source").alias("contig_id")).distinct().withColumn("length", F.lit(4000))
    return C.end_reads(a, lengths).select("doc_id", "rname")


@hit_query("c15_real_bins", "SELECT contig_id, name AS bin_id FROM (SELECT p_partkey AS contig_id, p_brand || CASE p_size % 6 WHEN 0 THEN '_noclass' WHEN 1 THEN '_unbined' WHEN 2 THEN '_genomes.0' WHEN 3 THEN '_genomes.7' ELSE '' END AS name FROM part) WHERE NOT (contains(name, 'noclass') OR contains(name, 'unbined') OR contains(name, '_genomes.0'))")
def c15(t: Tables) -> DataFrame:
    k = F.col("p_size") % 6
    suffix = F.when(k == 0, "_noclass").when(k == 1, "_unbined").when(k == 2, "_genomes.0").when(k == 3, "_genomes.7").otherwise("")
    return C.real_bins(t.part.select(F.col("p_partkey").alias("contig_id"), F.concat("p_brand", suffix).alias("bin_id")))


@hit_query("c16_binner_depth", "SELECT 'X' || p_partkey AS contig_id, p_retailprice AS s1, p_size * 2 AS s2 FROM part")
def c16(t: Tables) -> DataFrame:
    p = F.col("p_size")
    return C.binner_depth(t.part.select("p_partkey", p.alias("len"), p.alias("total"), F.col("p_retailprice").alias("s1"), p.alias("s1-var"), (p * 2).alias("s2"), p.alias("s2-var")))


@hit_query("c17_hybrid_depth", "SELECT p_partkey AS contig, p_size AS len, p_size + 1 AS total, p_size + 2 AS short, p_size + 3 AS short_var, p_size + 4 AS hifi, p_size + 5 AS hifi_var FROM part")
def c17(t: Tables) -> DataFrame:
    names = ["len", "total", "short", "short_var", "hifi", "hifi_var"]
    short, hifi = C.hybrid_depth(t.part.select(F.col("p_partkey").alias("contig"), *[(F.col("p_size") + i).alias(n) for i, n in enumerate(names)]))
    return short.join(hifi.select("contig", "hifi", "hifi_var"), "contig")


@hit_query("c20_read_ids", "SELECT o_orderkey, 'Seq' || row_number() OVER (PARTITION BY o_orderstatus, o_orderkey % 2 ORDER BY o_orderkey) || '_modifiedID_' || (o_orderkey % 2 + 1) || '/' || (o_orderkey % 2 + 1) AS read_id FROM orders")
def c20(t: Tables) -> DataFrame:
    return C.read_ids(t.orders.select("o_orderkey", F.col("o_orderstatus").alias("file"), (F.col("o_orderkey") % 2 + 1).alias("mate"), F.col("o_orderkey").alias("ordinal"))).select("o_orderkey", "read_id")


@hit_query("c23_shorter_variants", "SELECT p_brand AS bin_id, p_partkey AS variant FROM part JOIN (SELECT p_brand AS b, max(p_size) - 25 AS lines FROM part GROUP BY 1) ON p_brand = b WHERE p_size < lines")
def c23(t: Tables) -> DataFrame:
    v = t.part.select(F.col("p_brand").alias("bin_id"), F.col("p_partkey").alias("variant"), F.col("p_size").alias("lines"))
    return C.shorter_variants(v, v.groupBy("bin_id").agg((F.max("lines") - 25).alias("lines"))).select("bin_id", "variant")


@hit_query("c24_unbranched", """SELECT contig, "end", other FROM (SELECT *, count(*) OVER (PARTITION BY contig, "end") AS n FROM ends) WHERE n <> 2""")
def c24(t: Tables) -> DataFrame:
    return C.unbranched(ends(t)).select("contig", "end", "other")


@hit_query("d05_shared_within", "SELECT a.b AS bin1, c.b AS bin2, CAST(sum(a.length) AS BIGINT) AS shared FROM (SELECT DISTINCT l_returnflag || l_linestatus AS b, l_partkey, l_partkey % 100 + 1 AS length FROM lineitem) a JOIN (SELECT DISTINCT l_returnflag || l_linestatus AS b, l_partkey FROM lineitem) c ON a.l_partkey = c.l_partkey AND a.b < c.b GROUP BY 1, 2")
def d05(t: Tables) -> DataFrame:
    return D.shared_within(t.lineitem.select(F.concat("l_returnflag", "l_linestatus").alias("bin_id"), F.col("l_partkey").alias("contig_id"), (F.col("l_partkey") % 100 + 1).alias("length")).distinct())


@hit_query("d07_similar_gc", "SELECT e.bin1, e.bin2 FROM bin_edges e JOIN (SELECT p_brand AS b, round(avg(p_size), 4) AS gc FROM part GROUP BY 1) g ON e.bin1 = g.b JOIN (SELECT p_brand AS b, round(avg(p_size), 4) AS gc FROM part GROUP BY 1) h ON e.bin2 = h.b WHERE g.gc <> 0 AND 100 * abs(h.gc - g.gc) / g.gc <= 3")
def d07(t: Tables) -> DataFrame:
    gc = t.part.groupBy(F.col("p_brand").alias("bin_id")).agg(F.round(F.avg("p_size"), 4).alias("gc"))
    return D.similar_gc(D.bin_connections(t.edges(), t.brands(), n=t.tasks).select("bin1", "bin2"), gc, 3).select("bin1", "bin2")


@hit_query("d08_hit_bins", "SELECT bin1, bin2, aligned FROM bin_hits")
def d08(t: Tables) -> DataFrame:
    return D.hit_bins(alignments(t), t.brands(), t.tasks).withColumn("aligned", F.round("aligned", 2))


@hit_query("d09_members_of", "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def d09(t: Tables) -> DataFrame:
    return D.members_of(t.documents, t.labels.where("toxic = 1").select("doc_id"), "doc_id").select("doc_id", "source")


@hit_query("d16_overridden", "SELECT bin_id, completeness FROM quality_b UNION ALL SELECT bin_id, completeness FROM quality WHERE bin_id NOT IN (SELECT bin_id FROM quality_b)")
def d16(t: Tables) -> DataFrame:
    return D.overridden(t.quality().select("bin_id", "completeness"), t.quality("lang").select("bin_id", "completeness"), "bin_id")


@hit_query("d18_with_original", "SELECT bin_id || '.retrieved_1' AS bin_id, bin_id AS origin, completeness, completeness AS cpn0, contamination AS ctn0 FROM quality")
def d18(t: Tables) -> DataFrame:
    new = t.quality().select(F.concat("bin_id", F.lit(".retrieved_1")).alias("bin_id"), "completeness")
    return D.with_original(new, t.quality()).select("bin_id", "origin", "completeness", "cpn0", "ctn0")


@hit_query("e01_edge_sums", "SELECT l_partkey AS node1, l_suppkey AS node2, CAST(sum(l_linenumber) AS BIGINT) AS connections FROM lineitem GROUP BY 1, 2")
def e01(t: Tables) -> DataFrame:
    return A.edge_sums(t.lineitem.select(F.col("l_partkey").alias("node1"), F.col("l_suppkey").alias("node2"), F.col("l_linenumber").alias("connections")))


@hit_query("e03_end_edges", """SELECT c1 || e1 AS node1, c2 || e2 AS node2, count(*) AS connections FROM (SELECT CAST(l_suppkey AS VARCHAR) AS c1, CAST(l_partkey % 100 AS VARCHAR) AS c2, CASE WHEN l_linestatus = 'F' THEN 's' ELSE 'e' END AS e1, CASE WHEN l_returnflag = 'A' THEN 's' ELSE 'e' END AS e2, l_quantity * 100 AS n FROM lineitem) WHERE c1 <> c2 OR (n >= 3000 AND e1 <> e2) GROUP BY 1, 2""")
def e03(t: Tables) -> DataFrame:
    end = lambda c, v: F.when(F.col(c) == v, "s").otherwise("e")
    return A.end_edges(t.lineitem.select(F.col("l_suppkey").cast("string").alias("contig1"), end("l_linestatus", "F").alias("end1"), (F.col("l_partkey") % 100).cast("string").alias("contig2"), end("l_returnflag", "A").alias("end2"), (F.col("l_quantity") * 100).alias("length1")))


@hit_query("e04_hit_coverage", "SELECT contig_id, count(*) * 152 / any_value(p_size) AS coverage FROM hits JOIN part ON contig_id = p_partkey GROUP BY 1")
def e04(t: Tables) -> DataFrame:
    return A.hit_coverage(t.lineitem.select(F.col("l_partkey").alias("contig_id")), t.brands().select("contig_id", "length"), 151)


@hit_query("e05_symmetric", "SELECT bin1, bin2, CAST(sum(connections) AS BIGINT) AS connections FROM (SELECT bin1, bin2, connections FROM bin_edges UNION ALL SELECT bin2, bin1, connections FROM bin_edges) GROUP BY 1, 2")
def e05(t: Tables) -> DataFrame:
    return A.symmetric(D.bin_connections(t.edges(), t.brands(), n=t.tasks))


@hit_query("e13_aligned_bases", "SELECT query, subject, CAST(sum(floor(length * identity / 100)) AS BIGINT) AS aligned FROM aln GROUP BY 1, 2")
def e13(t: Tables) -> DataFrame:
    return A.aligned_bases(alignments(t))


@hit_query("e14_aligned_share", "SELECT bin1, bin2, round(50 * aligned / s1.size, 2) AS share1, round(50 * aligned / s2.size, 2) AS share2 FROM bin_hits JOIN (SELECT p_brand AS b, CAST(sum(p_size) AS BIGINT) * 1000 AS size FROM part GROUP BY 1) s1 ON bin1 = s1.b JOIN (SELECT p_brand AS b, CAST(sum(p_size) AS BIGINT) * 1000 AS size FROM part GROUP BY 1) s2 ON bin2 = s2.b")
def e14(t: Tables) -> DataFrame:
    sizes = t.part.groupBy(F.col("p_brand").alias("bin_id")).agg((F.sum("p_size") * 1000).alias("size"))
    return A.aligned_share(d08(t), sizes)


@hit_query("e20_fenced", "SELECT bin_id, contig_id, sample_idx, depth BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS in_fence FROM bin_depths JOIN fence USING (bin_id, sample_idx)")
def e20(t: Tables) -> DataFrame:
    d = t.brands().select("bin_id", "contig_id").join(t.depth(), "contig_id")
    return A.fenced(d, ["bin_id", "sample_idx"], "depth").select("bin_id", "contig_id", "sample_idx", "in_fence")


@hit_query("e24_mean_ratio", "SELECT l_returnflag AS bin1, l_linestatus AS bin2, l_linenumber AS sample_idx, round(coalesce(avg(CASE WHEN length >= 1000 AND (length / 1800 >= 0.5 OR length / 3000 >= 0.5) AND l_orderkey % 5 <> 0 THEN qlen / CAST(l_orderkey % 5 AS DOUBLE) END), 0), 6) AS ratio FROM aln GROUP BY 1, 2, 3")
def e24(t: Tables) -> DataFrame:
    a = alignments(t).select(F.col("l_returnflag").alias("bin1"), F.col("l_linestatus").alias("bin2"), F.col("l_linenumber").alias("sample_idx"), "length", F.lit(1800).alias("len1"), F.lit(3000).alias("len2"), F.col("qlen").cast("double").alias("depth1"), (F.col("l_orderkey") % 5).cast("double").alias("depth2"))
    return A.mean_ratio(a).withColumn("ratio", F.round("ratio", 6))


@hit_query("e29_merged_extent", "SELECT query, subject, round(pct, 6) AS pct, CASE WHEN pct >= 90 THEN '90-100' WHEN pct >= 80 THEN '80-90' WHEN pct >= 70 THEN '70-80' WHEN pct >= 60 THEN '60-70' ELSE '<60' END AS band, pct >= 95 AS kept FROM (SELECT query, subject, 100.0 * sum(length)::DOUBLE / (max(qend) - min(qstart) + 1) AS pct FROM aln GROUP BY 1, 2)")
def e29(t: Tables) -> DataFrame:
    return A.merged_extent(alignments(t)).withColumn("pct", F.round("pct", 6))


@hit_query("e30_end_degrees", """SELECT contig, count(*) FILTER ("end" = 's') AS at_start, count(*) FILTER ("end" = 'e') AS at_end, count(*) FILTER ("end" = 's') = 1 AND count(*) FILTER ("end" = 'e') = 1 AS straight FROM ends GROUP BY 1""")
def e30(t: Tables) -> DataFrame:
    return A.end_degrees(ends(t))


@hit_query("e32_majority", "SELECT l_partkey AS contig_id, sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) > 8 AS positive FROM lineitem GROUP BY 1")
def e32(t: Tables) -> DataFrame:
    return A.majority(t.lineitem.select(F.col("l_partkey").alias("contig_id"), (F.col("l_linestatus") == "F").cast("int").alias("vote")), ["contig_id"], 20)


@hit_query("e36_remapped_depth", "SELECT bin_id, sample_idx, round(avg(depth), 6) AS depth FROM bin_depths GROUP BY 1, 2")
def e36(t: Tables) -> DataFrame:
    d = t.brands().select("bin_id", "contig_id").join(t.depth(), "contig_id")
    return A.remapped_depth(d.select(F.concat_ws("|", "bin_id", "contig_id").alias("contig_id"), "sample_idx", "depth")).withColumn("depth", F.round("depth", 6))


@hit_query("e37_best_reads", "SELECT read_id FROM (SELECT read_id, row_number() OVER (PARTITION BY contigs ORDER BY score DESC, read_id) AS r FROM (SELECT l_orderkey AS read_id, list_sort(list(l_suppkey)) AS contigs, sum(l_linenumber) AS score FROM lineitem GROUP BY 1)) WHERE r = 1")
def e37(t: Tables) -> DataFrame:
    return A.best_reads(t.lineitem.select(F.col("l_orderkey").alias("read_id"), F.col("l_suppkey").alias("contig_id"), F.col("l_linenumber").alias("score"))).select("read_id")


@hit_query("g03_fold", "WITH_SAYS SELECT bin_id, selected FROM (SELECT *, row_number() OVER (PARTITION BY bin_id ORDER BY ordinal DESC, selected DESC) AS r FROM says) WHERE r = 1".replace("WITH_SAYS", ", folds AS (SELECT l_orderkey * 10 + l_linenumber AS ordinal, l_partkey AS bin1, l_suppkey + 100000000 AS bin2, l_linenumber % 3 AS winner FROM lineitem), says AS (SELECT ordinal, bin1 AS bin_id, winner = 1 AS selected FROM folds WHERE winner > 0 UNION ALL SELECT ordinal, bin2, winner = 2 FROM folds WHERE winner > 0)"))
def g03(t: Tables) -> DataFrame:
    return G.fold(t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ordinal"), F.col("l_partkey").alias("bin1"), (F.col("l_suppkey") + 100_000_000).alias("bin2"), (F.col("l_linenumber") % 3).alias("winner")))


@hit_query("g06_contig_status", "SELECT trial, CASE WHEN cpn - 5 * ctn > cpn0 - 5 * ctn0 THEN 'Positive' ELSE 'Neutral' END AS status FROM trials WHERE cpn - 5 * ctn >= cpn0 - 5 * ctn0")
def g06(t: Tables) -> DataFrame:
    return G.contig_status(trials(t)).select("trial", "status")


@hit_query("g07_deep_choice", "SELECT bin_id, number FROM (SELECT *, row_number() OVER (PARTITION BY bin_id ORDER BY completeness - 5 * contamination DESC, CASE WHEN completeness < 85 THEN -number ELSE number END DESC) AS r FROM variants) WHERE r = 1")
def g07(t: Tables) -> DataFrame:
    return G.deep_choice(variants(t)).select("bin_id", "number")


@hit_query("g08_rolled_back", "SELECT trial, cpn0 - 5 * ctn0 > cpn - 5 * ctn AS keep_original FROM trials")
def g08(t: Tables) -> DataFrame:
    return G.rolled_back(trials(t)).select("trial", "keep_original")


@hit_query("g11_reassembly_choice", "SELECT bin_id, number FROM (SELECT *, row_number() OVER (PARTITION BY bin_id ORDER BY completeness - 5 * contamination - CASE WHEN assembler = 'IDBA' THEN 3 ELSE 0 END DESC, CASE WHEN assembler <> 'IDBA' THEN 1 ELSE 0 END DESC, n50 DESC, assembler DESC, number DESC) AS r FROM variants) WHERE r = 1")
def g11(t: Tables) -> DataFrame:
    return G.reassembly_choice(variants(t)).select("bin_id", "number")


@hit_query("g13_polished", "SELECT trial, ctn <= ctn0 AS accepted FROM trials")
def g13(t: Tables) -> DataFrame:
    return G.polished(trials(t)).select("trial", "accepted")


@hit_query("g18_longest_merge", "SELECT contig_id, merged FROM (SELECT *, row_number() OVER (PARTITION BY contig_id ORDER BY length(merged) DESC, merged DESC) AS r FROM (SELECT DISTINCT l_suppkey AS contig_id, l_partkey || '_' || l_linenumber AS merged FROM lineitem)) WHERE r = 1")
def g18(t: Tables) -> DataFrame:
    return G.longest_merge(t.lineitem.select(F.col("l_suppkey").alias("contig_id"), F.concat(F.col("l_partkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string")).alias("merged")))


@hit_query("h02_excepted", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def h02(t: Tables) -> DataFrame:
    return H.excepted(t.documents.select("doc_id"), t.labels.select("doc_id"), "doc_id")


@hit_query("h04_unordered", "SELECT DISTINCT least(l_partkey, l_suppkey) AS l_partkey, greatest(l_partkey, l_suppkey) AS l_suppkey FROM lineitem")
def h04(t: Tables) -> DataFrame:
    return H.unordered(t.lineitem, "l_partkey", "l_suppkey")


@hit_query("i10_differences", "SELECT trial, round(CASE WHEN cpn + cpn0 = 0 THEN 0 ELSE 200 * abs(cpn - cpn0) / (cpn + cpn0) END, 6) AS of_mean, round(100 * abs(cpn - cpn0) / CASE WHEN cpn + cpn0 = 0 THEN 1 ELSE cpn + cpn0 END, 6) AS of_sum, round(CASE WHEN cpn0 <> 0 THEN 100 * abs(cpn - cpn0) / cpn0 END, 6) AS of_reference FROM trials")
def i10(t: Tables) -> DataFrame:
    return trials(t).select("trial", F.round(S.pct_avg("cpn", "cpn0"), 6).alias("of_mean"), F.round(S.pct_sum("cpn", "cpn0"), 6).alias("of_sum"), F.round(S.pct_ref("cpn", "cpn0"), 6).alias("of_reference"))


@hit_query("j01_one_hop", "SELECT bin_id, contig_id, 0 AS level FROM brands UNION ALL SELECT bin_id, contig_id, 1 FROM near")
def j01(t: Tables) -> DataFrame:
    return J.reach(t.brands(), t.edges(), 1, t.tasks)


def rivals(t: Tables) -> DataFrame:
    """Pairs of bins with lineages, sizes and connections."""
    p = F.col("trial")
    one = F.when(p % 3 == 0, "s__a").when(p % 3 == 1, "g__b").otherwise("root")
    two = F.when(p % 2 == 0, "g__b").otherwise("p__c")
    return trials(t).select("trial", F.col("cpn").alias("cpn1"), F.col("ctn").alias("ctn1"), F.col("cpn0").alias("cpn2"), F.col("ctn0").alias("ctn2"), one.alias("lineage1"), two.alias("lineage2"), (p % 500).alias("size1"), (p * 7 % 500).alias("size2"), (p % 4).alias("connections1"), (p % 3).alias("connections2"))


RIVALS = """, rivals AS (SELECT trial, cpn AS cpn1, ctn AS ctn1, cpn0 AS cpn2, ctn0 AS ctn2, CASE trial % 3 WHEN 0 THEN 's__a' WHEN 1 THEN 'g__b' ELSE 'root' END AS lineage1, CASE trial % 2 WHEN 0 THEN 'g__b' ELSE 'p__c' END AS lineage2, CASE trial % 3 WHEN 0 THEN 11.4 WHEN 1 THEN 7.6 ELSE 0 END AS w1, CASE trial % 2 WHEN 0 THEN 7.6 ELSE 1.5 END AS w2,
  trial % 500 AS size1, trial * 7 % 500 AS size2, (trial % 500) / nullif(trial % 4, 0) AS r1, (trial * 7 % 500) / nullif(trial % 3, 0) AS r2 FROM trials) """


def chain(t: Tables, length: int) -> DataFrame:
    """Paths of ``length`` parts with neighbouring numbers."""
    p = F.col("p_partkey")
    return t.part.where(p % length != length - 1).select(p.alias("node1"), (p + 1).alias("node2"))


@hit_query("g09_best_variant", "SELECT bin_id, variant FROM (SELECT *, row_number() OVER (PARTITION BY bin_id ORDER BY completeness - 5 * contamination DESC, number % 3 DESC, CASE WHEN number % 2 = 1 THEN 1 ELSE 0 END DESC, variant DESC) AS r FROM (SELECT *, repeat('.', CAST(number % 3 AS INTEGER)) || number AS variant FROM variants)) WHERE r = 1")
def g09(t: Tables) -> DataFrame:
    n = F.col("number")
    dots = F.when(n % 3 == 0, "").when(n % 3 == 1, ".").otherwise("..")
    return G.best_variant(variants(t).select("bin_id", F.concat(dots, n.cast("string")).alias("variant"), "completeness", "contamination", (n % 2).cast("string").alias("threshold"))).select("bin_id", "variant")


@hit_query("g12_hybrid_choice", ", v AS (SELECT *, completeness - 5 * contamination AS five FROM variants), tops AS (SELECT bin_id, max(n50) AS top_n50, max(five) AS top_five FROM v WHERE assembler <> 'IDBA' GROUP BY 1) SELECT bin_id, number FROM (SELECT bin_id, number, row_number() OVER (PARTITION BY bin_id ORDER BY CASE WHEN five >= 40 THEN 1000 + five ELSE completeness - contamination END DESC, n50 DESC, assembler DESC, number DESC) AS r FROM v LEFT JOIN tops USING (bin_id) WHERE assembler <> 'IDBA' OR top_five IS NULL OR five - top_five >= 6 OR (five - top_five >= 3 AND n50 / nullif(top_n50, 0) >= 0.5)) WHERE r = 1")
def g12(t: Tables) -> DataFrame:
    return G.hybrid_choice(variants(t)).select("bin_id", "number")


@hit_query("g14_merge_candidates", RIVALS + "SELECT trial FROM rivals WHERE trial % 5 <> 0 AND lineage1 = lineage2 AND cpn1 + cpn2 <= 105")
def g14(t: Tables) -> DataFrame:
    return G.merge_candidates(rivals(t).withColumn("alike", F.col("trial") % 5 != 0)).select("trial")


@hit_query("g15_similar_bins", "SELECT bin_id, min(bin_id) OVER (PARTITION BY bin_id // 10) AS component, CAST(sum(good) OVER (PARTITION BY bin_id // 10) - good AS BIGINT) AS partners FROM (SELECT p AS bin_id, CASE WHEN p IN (SELECT p_partkey FROM part WHERE p_partkey % 7 <= 5) THEN 1 ELSE 0 END AS good FROM (SELECT p_partkey AS p FROM part WHERE p_partkey % 10 <> 9 UNION SELECT p_partkey + 1 FROM part WHERE p_partkey % 10 <> 9))")
def g15(t: Tables) -> DataFrame:
    quality = variants(t).select(F.col("number").alias("bin_id"), "contamination")
    return G.similar_bins(chain(t, 10), quality)


@hit_query("g17_by_lineage", RIVALS + "SELECT trial, CASE WHEN w1 > w2 THEN 1 WHEN w1 < w2 THEN 2 WHEN cpn1 - ctn1 > cpn2 - ctn2 THEN 1 WHEN cpn1 - ctn1 < cpn2 - ctn2 THEN 2 WHEN r1 > r2 THEN 1 WHEN r1 < r2 THEN 2 WHEN size1 > size2 THEN 1 ELSE 2 END AS winner, CASE WHEN w1 * (cpn1 - ctn1) >= w2 * (cpn2 - ctn2) THEN 1 ELSE 2 END AS by_product FROM rivals")
def g17(t: Tables) -> DataFrame:
    return rivals(t).select("trial", G.by_lineage().alias("winner"), G.by_lineage(multiply=True).alias("by_product"))


@hit_query("g19_final_ties", "SELECT trial, CASE WHEN trial % 3 = 0 THEN 2 ELSE trial % 3 END AS winner FROM trials")
def g19(t: Tables) -> DataFrame:
    return G.final_ties(trials(t).select("trial", (F.col("trial") % 3).alias("winner")), final=True)


@hit_query("h07_changed_variants", "SELECT bin_id, variant FROM (SELECT *, lead(flags) OVER (PARTITION BY bin_id ORDER BY variant) AS after FROM (SELECT l_suppkey AS bin_id, l_linenumber AS variant, list_sort(list(DISTINCT l_returnflag || l_linestatus)) AS flags FROM lineitem GROUP BY 1, 2)) WHERE flags IS DISTINCT FROM after")
def h07(t: Tables) -> DataFrame:
    m = t.lineitem.select(F.col("l_suppkey").alias("bin_id"), F.col("l_linenumber").alias("variant"), F.concat("l_returnflag", "l_linestatus").alias("flags"))
    return H.changed_variants(m, ["flags"])


@hit_query("i04_gc_percent", "SELECT doc_id, round(100.0 * (length(text) - length(replace(replace(text, 'G', ''), 'C', '')))::DOUBLE / nullif(length(text), 0), 6) AS gc FROM documents")
def i04(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.round(S.gc_percent("text"), 6).alias("gc"))


@hit_query("i08_kmer_vector", """, mers AS (SELECT doc_id, upper(substr(text, CAST(i AS BIGINT), 2)) AS m FROM (SELECT doc_id, text, unnest(range(1, length(text))) AS i FROM documents)), seen AS (SELECT doc_id, m, count(*) AS n FROM mers WHERE regexp_full_match(m, '[ACGT]{2}') GROUP BY 1, 2),
both_s AS (SELECT doc_id, m, n FROM seen UNION ALL SELECT doc_id, reverse(translate(m, 'ACGT', 'TGCA')), n FROM seen), total AS (SELECT doc_id, sum(n) AS t FROM both_s GROUP BY 1), summed AS (SELECT doc_id, m, sum(n) AS n FROM both_s GROUP BY 1, 2)
SELECT g.doc_id, g.kmer, round(coalesce(n, 0) / t, 6) AS share FROM (SELECT doc_id, t, a || b AS kmer FROM total CROSS JOIN (SELECT unnest(['A', 'C', 'G', 'T']) AS a) CROSS JOIN (SELECT unnest(['A', 'C', 'G', 'T']) AS b)) g LEFT JOIN summed s ON s.doc_id = g.doc_id AND s.m = g.kmer""")
def i08(t: Tables) -> DataFrame:
    v = t.documents.select("doc_id", S.kmer_vector(F.upper("text"), 2, 1).alias("v")).where("v is not null")
    names = F.array(*map(F.lit, S.all_kmers(2)))
    return v.select("doc_id", F.posexplode("v").alias("i", "share")).select("doc_id", names[F.col("i")].alias("kmer"), F.round("share", 6).alias("share"))


@hit_query("i09_windows", "SELECT doc_id, i, md5(CASE WHEN i < cuts THEN substr(text, CAST(i * 500 + 1 AS BIGINT), 500) ELSE substr(text, CAST(i * 500 + 1 AS BIGINT)) END) AS digest FROM (SELECT doc_id, text, cuts, unnest(range(0, cuts + 1)) AS i FROM (SELECT doc_id, text, CAST(greatest(ceil((length(text) - 1000) / 500), 0) AS BIGINT) AS cuts FROM documents))")
def i09(t: Tables) -> DataFrame:
    w = t.documents.select("doc_id", F.posexplode(S.windows("text", 500)).alias("i", "piece"))
    return w.select("doc_id", "i", F.md5(F.col("piece").cast("binary")).alias("digest"))


@hit_query("i12_strip_extension", "SELECT p_partkey, replace(p_name, ' ', '.') AS name, regexp_replace(replace(p_name, ' ', '.'), '\\.[^.]*$', '') AS stem FROM part")
def i12(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.translate("p_name", " ", ".").alias("name")).withColumn("stem", S.strip_extension("name"))


@hit_query("i14_number", "SELECT p_partkey, TRY_CAST(s AS DOUBLE) AS value FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN CAST(p_size AS VARCHAR) ELSE p_size || '.25' END AS s FROM part)")
def i14(t: Tables) -> DataFrame:
    k, size = F.col("p_partkey") % 3, F.col("p_size").cast("string")
    return t.part.select("p_partkey", S.number(F.when(k == 0, F.col("p_name")).when(k == 1, size).otherwise(F.concat(size, F.lit(".25")))).alias("value"))


@hit_query("j03_three_hops", "SELECT m.p_partkey AS bin_id, c.p AS contig_id, abs(c.p - m.p_partkey) AS level FROM part m JOIN (SELECT p_partkey AS p FROM part UNION SELECT p_partkey + 1 FROM part WHERE p_partkey % 50 <> 49) c ON c.p // 50 = m.p_partkey // 50 AND abs(c.p - m.p_partkey) <= 3")
def j03(t: Tables) -> DataFrame:
    seeds = t.part.select(F.col("p_partkey").alias("bin_id"), F.col("p_partkey").alias("contig_id"))
    return J.reach(seeds, chain(t, 50), 3)


@hit_query("j05_gap_groups", "SELECT p_partkey AS node, p_partkey - p_partkey % 50 AS component FROM part")
def j05(t: Tables) -> DataFrame:
    return J.connected_components(chain(t, 50))


@hit_query("j08_elongate", "SELECT p_partkey AS target, p_partkey + s AS contig_id, s AS step FROM (SELECT p_partkey, unnest(range(0, least(50 - p_partkey % 50, (SELECT max(p_partkey) FROM part) + 2 - p_partkey))) AS s FROM part)")
def j08(t: Tables) -> DataFrame:
    near = chain(t, 50).select(F.col("node1").alias("query"), F.col("node2").alias("subject"), F.lit(100).alias("length"))
    far = near.select("query", (F.col("subject") + 1).alias("subject"), F.lit(50).alias("length"))
    return J.elongate(t.part.select(F.col("p_partkey").alias("contig_id")), near.union(far))


@hit_query("j12_single_paths", """, h AS (SELECT l_orderkey AS read_id, l_partkey * 10 + l_linenumber AS contig_id, CASE WHEN l_linestatus = 'F' THEN 's' ELSE 'e' END AS "end" FROM lineitem) SELECT read_id, contig_id, "end" FROM (SELECT *, min(read_id) OVER (PARTITION BY contig_id, "end") AS lo, max(read_id) OVER (PARTITION BY contig_id, "end") AS hi FROM h) WHERE lo = hi""")
def j12(t: Tables) -> DataFrame:
    h = t.lineitem.select(F.col("l_orderkey").alias("read_id"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("contig_id"), F.when(F.col("l_linestatus") == "F", "s").otherwise("e").alias("end"))
    return J.single_paths(h).select("read_id", "contig_id", "end")


@hit_query("k04_neighbour_outliers", "SELECT bin_id, contig_id, sample_idx, depth < q1 - 1.5 * (q3 - q1) OR depth > q3 + 1.5 * (q3 - q1) AS outlier FROM near JOIN depth USING (contig_id) JOIN fence USING (bin_id, sample_idx)")
def k04(t: Tables) -> DataFrame:
    near = D.neighbours(t.brands(), t.edges(), t.tasks).join(t.depth(), "contig_id")
    return K.outside(t.bin_depths(), near, 1.5, "depth", ["bin_id", "sample_idx"]).select("bin_id", "contig_id", "sample_idx", "outlier")


@hit_query("k05_features", f"""SELECT contig_id, i - 1 AS place, round(v[i], 4) + 0.0::DOUBLE AS value FROM (SELECT contig_id, list_concat(list_concat(d, {stats_sql('d')}), k) AS v, unnest(range(1, 20)) AS i FROM (SELECT p_partkey AS contig_id, [CAST(p_size AS DOUBLE), CAST(p_retailprice AS DOUBLE), 1.0::DOUBLE] AS d, [0.5::DOUBLE] AS k FROM part))""")
def k05(t: Tables) -> DataFrame:
    depths = F.array(F.col("p_size").cast("double"), F.col("p_retailprice").cast("double"), F.lit(1.0))
    f = K.features(t.part.select(F.col("p_partkey").alias("contig_id"), depths.alias("depths"), F.array(F.lit(0.5)).alias("kmers")), 3)
    return f.select("contig_id", F.posexplode("vector").alias("place", "value")).withColumn("value", F.round("value", 4))
