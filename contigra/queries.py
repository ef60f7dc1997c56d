"""Each operator on the driver's tables, with the same query in SQL.

Documents stand for contigs (``source`` and ``lang`` for two bin sets), parts for contigs with depths (one sample a
return flag) and brands for their bins, orders for reads, and parts of one order for connected contigs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigra.functions import scalar as S
from contigra.operators import aggregates as A
from contigra.operators import filters as C
from contigra.operators import graph as J
from contigra.operators import joins as D
from contigra.operators import ml as K
from contigra.operators import selection as G
from contigra.operators import sets as H
from contigra.operators import windows as W
from contigra.plans import dereplicate as P

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


JUDGED = """, judged AS (SELECT bin1, bin2, CASE WHEN a.completeness - a.contamination > b.completeness - b.contamination THEN 1 WHEN a.completeness - a.contamination < b.completeness - b.contamination THEN 2 WHEN a.genome_size > b.genome_size THEN 1 ELSE 2 END AS winner FROM accepted JOIN quality a ON bin1 = a.bin_id JOIN quality_b b ON bin2 = b.bin_id) """


class Tables:
    """The driver's tables as the data model."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def members(self, by: str) -> DataFrame:
        return self.documents.select(F.col(by).alias("bin_id"), F.col("doc_id").alias("contig_id"), F.col("n_chars").alias("length"))

    def brands(self) -> DataFrame:
        return self.part.select(F.col("p_brand").alias("bin_id"), F.col("p_partkey").alias("contig_id"), F.col("p_size").cast("long").alias("length"))

    def depth(self) -> DataFrame:
        sample = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
        return self.lineitem.groupBy(F.col("l_partkey").alias("contig_id"), sample.alias("sample_idx")).agg(F.round(F.avg("l_quantity"), 6).alias("depth"))

    def bin_depths(self) -> DataFrame:
        return self.brands().select("bin_id", "contig_id").join(self.depth(), "contig_id")

    def hits(self) -> DataFrame:
        return self.lineitem.select(F.col("l_orderkey").alias("read_id"), F.col("l_partkey").alias("contig_id"), F.col("l_extendedprice").alias("score"), F.col("l_linenumber").cast("long").alias("ordinal"))

    @property
    def tasks(self) -> int | None:
        """Over how many tasks line items and their pairs are dealt where they are many."""
        return D.tasks(self.spark, self.lineitem.count())

    def edges(self) -> DataFrame:
        n = self.tasks
        p = D.over(self.lineitem.select("l_orderkey", "l_partkey"), n, "l_orderkey").distinct()
        q = p.select("l_orderkey", F.col("l_partkey").alias("node2"))
        j = p.withColumnRenamed("l_partkey", "node1").join(q, "l_orderkey").where("node1 < node2").select("node1", "node2")
        return D.over(j, n, "node1", "node2").groupBy("node1", "node2").agg(F.count(F.lit(1)).alias("connections"))

    def quality(self, by: str = "source") -> DataFrame:
        j = self.documents.join(self.labels, "doc_id")
        return j.groupBy(F.col(by).alias("bin_id")).agg(F.round(100 * F.avg("quality"), 4).alias("completeness"), F.round(100 * F.avg("toxic"), 4).alias("contamination"), F.sum("n_chars").alias("genome_size"), F.max("n_chars").cast("double").alias("n50"))


#: Shared parts of the SQL twins.
WITH = """WITH mem_a AS (SELECT source AS bin_id, doc_id AS contig_id, n_chars AS length FROM documents),
mem_b AS (SELECT lang AS bin_id, doc_id AS contig_id, n_chars AS length FROM documents),
brands AS (SELECT p_brand AS bin_id, p_partkey AS contig_id, CAST(p_size AS BIGINT) AS length FROM part),
depth AS (SELECT l_partkey AS contig_id, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS sample_idx, round(avg(l_quantity), 6) AS depth FROM lineitem GROUP BY 1, 2),
bin_depths AS (SELECT b.bin_id, contig_id, sample_idx, depth FROM brands b JOIN depth USING (contig_id)),
hits AS (SELECT l_orderkey AS read_id, l_partkey AS contig_id, l_extendedprice AS score, CAST(l_linenumber AS BIGINT) AS ordinal FROM lineitem),
dl AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
edges AS (SELECT a.l_partkey AS node1, b.l_partkey AS node2, count(*) AS connections FROM dl a JOIN dl b ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey GROUP BY 1, 2),
quality AS (SELECT source AS bin_id, round(100 * avg(l.quality), 4) AS completeness, round(100 * avg(l.toxic), 4) AS contamination, CAST(sum(n_chars) AS BIGINT) AS genome_size, CAST(max(n_chars) AS DOUBLE) AS n50 FROM documents JOIN labels l USING (doc_id) GROUP BY 1),
quality_b AS (SELECT lang AS bin_id, round(100 * avg(l.quality), 4) AS completeness, round(100 * avg(l.toxic), 4) AS contamination, CAST(sum(n_chars) AS BIGINT) AS genome_size, CAST(max(n_chars) AS DOUBLE) AS n50 FROM documents JOIN labels l USING (doc_id) GROUP BY 1),
sizes_a AS (SELECT bin_id, CAST(sum(length) AS BIGINT) AS size FROM mem_a GROUP BY 1), sizes_b AS (SELECT bin_id, CAST(sum(length) AS BIGINT) AS size FROM mem_b GROUP BY 1),
shared AS (SELECT a.bin_id AS bin1, b.bin_id AS bin2, CAST(sum(a.length) AS BIGINT) AS shared FROM mem_a a JOIN mem_b b USING (contig_id) GROUP BY 1, 2),
scored AS (SELECT bin1, bin2, round(100.0 * shared / s1.size, 2) AS pct1, round(100.0 * shared / s2.size, 2) AS pct2 FROM shared JOIN sizes_a s1 ON bin1 = s1.bin_id JOIN sizes_b s2 ON bin2 = s2.bin_id),
best AS (SELECT bin1, bin2, pct1, pct2 FROM (SELECT *, row_number() OVER (PARTITION BY bin1 ORDER BY pct1 DESC, bin2) AS r FROM scored) WHERE r = 1),
accepted AS (SELECT * FROM best WHERE pct1 + pct2 >= 100 OR pct1 >= 50 OR pct2 >= 50),
bin_cov AS (SELECT bin_id, sample_idx, avg(depth) AS depth FROM bin_depths GROUP BY 1, 2),
bin_edges AS (SELECT a.bin_id AS bin1, b.bin_id AS bin2, CAST(sum(connections) AS BIGINT) AS connections FROM edges JOIN brands a ON node1 = a.contig_id JOIN brands b ON node2 = b.contig_id WHERE a.bin_id <> b.bin_id GROUP BY 1, 2),
pairs AS (SELECT DISTINCT least(bin1, bin2) AS bin1, greatest(bin1, bin2) AS bin2 FROM bin_edges),
quality_p AS (SELECT p_brand AS bin_id, round(avg(2.0 * p_size), 1) AS completeness, round(avg(p_partkey % 25), 1) AS contamination, CAST(sum(p_size) AS BIGINT) AS genome_size, CAST(max(p_size) AS DOUBLE) AS n50 FROM part GROUP BY 1),
qp AS (SELECT a.bin_id AS bin1, b.bin_id AS bin2, a.completeness AS cpn1, a.contamination AS ctn1, a.genome_size AS size1, a.n50 AS n50_1, b.completeness AS cpn2, b.contamination AS ctn2, b.genome_size AS size2, b.n50 AS n50_2 FROM pairs JOIN quality_p a ON bin1 = a.bin_id JOIN quality_p b ON bin2 = b.bin_id),
fence AS (SELECT bin_id, sample_idx, quantile_cont(depth, 0.25) AS q1, quantile_cont(depth, 0.75) AS q3, avg(depth) AS mean FROM bin_depths GROUP BY 1, 2),
both_e AS (SELECT node1, node2, connections FROM edges UNION ALL SELECT node2, node1, connections FROM edges),
near AS (SELECT b.bin_id, e.node2 AS contig_id, CAST(sum(e.connections) AS BIGINT) AS connections FROM brands b JOIN both_e e ON b.contig_id = e.node1 WHERE NOT EXISTS (SELECT 1 FROM brands m WHERE m.bin_id = b.bin_id AND m.contig_id = e.node2) GROUP BY 1, 2)
"""


def query(name: str, sql: str | None = None):
    """Register a query of Tables, and its SQL after the shared parts."""

    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[name] = WITH + sql
        return f

    return register


def brand_quality(t: Tables) -> DataFrame:
    p = t.part.groupBy(F.col("p_brand").alias("bin_id"))
    return p.agg(F.round(F.avg(2.0 * F.col("p_size")), 1).alias("completeness"), F.round(F.avg(F.col("p_partkey") % 25), 1).alias("contamination"), F.sum("p_size").cast("long").alias("genome_size"), F.max("p_size").cast("double").alias("n50"))


def connected_pairs(t: Tables) -> DataFrame:
    """Pairs of brands that edges connect (D-3), smaller name first."""
    return H.unordered(D.bin_connections(t.edges(), t.brands(), n=t.tasks).select("bin1", "bin2"), "bin1", "bin2")


def _pairs(t: Tables) -> DataFrame:
    """Connected pairs of bins with both qualities (D-17)."""
    return D.pair_quality(connected_pairs(t), brand_quality(t))


@query("dereplicate", JUDGED + """SELECT 'a' AS side, bin_id FROM sizes_a WHERE bin_id NOT IN (SELECT bin1 FROM judged WHERE winner = 2) UNION ALL SELECT 'b', bin_id FROM sizes_b WHERE bin_id NOT IN (SELECT bin2 FROM judged WHERE winner = 1)""")
def dereplicate(t: Tables) -> DataFrame:
    return P.dereplicate(t.members("source"), t.members("lang"), t.quality(), t.quality("lang"))


@query("c01_min_length", "SELECT doc_id AS contig_id, source || '-' || row_number() OVER (PARTITION BY source ORDER BY doc_id) AS new_id, n_chars AS length FROM documents WHERE n_chars >= 1000")
def c01(t: Tables) -> DataFrame:
    d = t.documents.select(F.col("doc_id").alias("contig_id"), F.col("source").alias("assembly"), F.col("n_chars").alias("length"), F.col("doc_id").alias("ordinal"))
    return C.min_length(d).select("contig_id", "new_id", "length")


@query("c02_single_contig_bins", "SELECT contig_id, assembly, number FROM (SELECT doc_id AS contig_id, source AS assembly, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS number FROM documents) WHERE n_chars >= 10000")
def c02(t: Tables) -> DataFrame:
    d = t.documents.select(F.col("doc_id").alias("contig_id"), F.col("source").alias("assembly"), F.col("n_chars").alias("length"), F.col("doc_id").alias("ordinal"))
    return C.single_contig_bins(d, 10_000).select("contig_id", "assembly", "number")


@query("c03_oversize", "SELECT bin_id, size FROM sizes_a WHERE size < 150000")
def c03(t: Tables) -> DataFrame:
    return C.oversize(t.members("source"), 150_000)


@query("c04_weak_bins", "SELECT bin_id, completeness, contamination, genome_size FROM quality WHERE completeness > 80 AND genome_size > 20000")
def c04(t: Tables) -> DataFrame:
    return C.weak_bins(t.members("source"), t.quality(), 80, 20_000)


@query("c05_cutoff", "SELECT * FROM quality WHERE completeness >= 80 AND contamination < 12")
def c05(t: Tables) -> DataFrame:
    return C.cutoff(t.quality(), 80, 12)


@query("c06_contamination_gate", "SELECT bin1 AS a, bin2 AS b FROM qp WHERE NOT (ctn1 >= 12 AND cpn1 - ctn1 <= 80) AND NOT (ctn2 >= 12 AND cpn2 - ctn2 <= 80)")
def c06(t: Tables) -> DataFrame:
    return C.gated_pairs(_pairs(t).select(F.col("bin1").alias("a"), F.col("bin2").alias("b")), brand_quality(t)).select("a", "b")


@query("c18_reassembled", "SELECT bin_id, contig_id, length FROM (SELECT *, count(*) OVER (PARTITION BY bin_id) AS n FROM mem_a WHERE length >= 1000) WHERE n >= 2")
def c18(t: Tables) -> DataFrame:
    return C.reassembled(t.members("source"))


@query("c19_quality_tier", "SELECT bin_id, CASE WHEN completeness - 5 * contamination >= 70 THEN 'high' WHEN completeness - 5 * contamination >= 50 THEN 'medium' ELSE 'low' END AS tier FROM quality")
def c19(t: Tables) -> DataFrame:
    return t.quality().select("bin_id", C.tier().alias("tier"))


@query("c21_fragments", "SELECT doc_id || '_' || (i // 2 + 1) AS read_id, CAST(i % 2 + 1 AS INTEGER) AS mate, substr(text, CAST(i * 100 + 1 AS BIGINT), 100) AS seq FROM (SELECT doc_id, text, unnest(range(0, (length(text) // 200) * 2)) AS i FROM documents)")
def c21(t: Tables) -> DataFrame:
    return C.fragments(t.documents.select(F.col("doc_id").cast("string").alias("read_id"), F.col("text").alias("seq")))


@query("c22_renumbered", "SELECT bin_id, contig_id, 'bin' || n AS new_bin, 'bin' || n || '_' || m AS new_contig FROM (SELECT bin_id, contig_id, dense_rank() OVER (ORDER BY bin_id) AS n, row_number() OVER (PARTITION BY bin_id ORDER BY contig_id) AS m FROM mem_a)")
def c22(t: Tables) -> DataFrame:
    return C.renumbered(t.members("source"))


@query("d03_bin_connections", "SELECT x.bin_id AS bin1, y.bin_id AS bin2, CAST(sum(connections) AS BIGINT) AS connections FROM edges JOIN brands x ON node1 = x.contig_id JOIN brands y ON node2 = y.contig_id WHERE x.bin_id <> y.bin_id GROUP BY 1, 2")
def d03(t: Tables) -> DataFrame:
    return D.bin_connections(t.edges(), t.brands(), n=t.tasks)


@query("d04_shared_bases", "SELECT bin1, bin2, shared FROM shared")
def d04(t: Tables) -> DataFrame:
    return D.shared(t.members("source"), t.members("lang"))


@query("d06_similar_coverage", "SELECT a.bin_id AS bin1, b.bin_id AS bin2 FROM bin_cov a JOIN bin_cov b ON a.sample_idx = b.sample_idx AND a.bin_id < b.bin_id GROUP BY 1, 2 HAVING bool_and(a.depth <= 10 OR b.depth <= 10 OR 200.0 * abs(a.depth - b.depth) / (a.depth + b.depth) <= 2)")
def d06(t: Tables) -> DataFrame:
    return D.similar_coverage(A.bin_coverage(t.brands(), t.depth()), 10, 2)


@query("d10_black_list", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def d10(t: Tables) -> DataFrame:
    return D.without(t.documents.select("doc_id", "source"), t.labels.where("toxic = 1").select("doc_id"), "doc_id")


@query("d11_neighbours", "SELECT bin_id, contig_id, connections FROM near")
def d11(t: Tables) -> DataFrame:
    return D.neighbours(t.brands(), t.edges(), t.tasks)


@query("d12_read_neighbours", "SELECT o.bin_id, h.contig_id, CAST(sum(o.w) AS BIGINT) AS support FROM (SELECT bin_id, read_id, count(*) AS w FROM hits JOIN brands USING (contig_id) GROUP BY 1, 2) o JOIN hits h USING (read_id) WHERE NOT EXISTS (SELECT 1 FROM brands m WHERE m.bin_id = o.bin_id AND m.contig_id = h.contig_id) GROUP BY 1, 2")
def d12(t: Tables) -> DataFrame:
    return D.read_neighbours(t.brands(), t.hits(), t.tasks)


@query("d13_paired", "SELECT bin_id, read_id, mate FROM (SELECT l_suppkey AS bin_id, l_orderkey AS read_id, (l_linenumber - 1) % 2 + 1 AS mate FROM lineitem) JOIN (SELECT l_suppkey AS bin_id, l_orderkey AS read_id FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT (l_linenumber - 1) % 2) = 2) USING (bin_id, read_id)")
def d13(t: Tables) -> DataFrame:
    return D.paired(t.lineitem.select(F.col("l_suppkey").alias("bin_id"), F.col("l_orderkey").alias("read_id"), ((F.col("l_linenumber") - 1) % 2 + 1).alias("mate")))


@query("d14_mate_edges", "SELECT max(CASE WHEN r = 1 THEN contig_id END) AS node1, max(CASE WHEN r = 2 THEN contig_id END) AS node2 FROM (SELECT read_id, contig_id, row_number() OVER (PARTITION BY read_id ORDER BY ordinal, contig_id) AS r FROM hits) GROUP BY read_id HAVING count(*) >= 2")
def d14(t: Tables) -> DataFrame:
    return D.mate_edges(t.hits())


@query("d15_evidence_levels", "SELECT bin_id, contig_id, CASE WHEN NOT (ss AND ll) OR (s AND l) THEN 1 WHEN s THEN 2 ELSE 3 END AS level FROM (SELECT bin_id, contig_id, bool_or(k = 1) AS s, bool_or(k = 2) AS l, bool_or(bool_or(k = 1)) OVER (PARTITION BY bin_id) AS ss, bool_or(bool_or(k = 2)) OVER (PARTITION BY bin_id) AS ll FROM (SELECT l_suppkey AS bin_id, l_partkey AS contig_id, 1 AS k FROM lineitem WHERE l_returnflag = 'A' UNION ALL SELECT l_suppkey, l_partkey, 2 FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1, 2)")
def d15(t: Tables) -> DataFrame:
    part = lambda f: t.lineitem.where(F.col("l_returnflag") == f).select(F.col("l_suppkey").alias("bin_id"), F.col("l_partkey").alias("contig_id"))
    return D.evidence_levels(part("A"), part("R"))


@query("d17_pair_quality", "SELECT * FROM qp")
def d17(t: Tables) -> DataFrame:
    return _pairs(t)


@query("e02_condensed_edges", "SELECT node1, node2, connections FROM edges WHERE connections >= 2")
def e02(t: Tables) -> DataFrame:
    e = t.edges().select(F.concat(F.col("node1").cast("string"), F.lit("s")).alias("node1"), F.concat(F.col("node2").cast("string"), F.lit("e")).alias("node2"), "connections")
    out = A.condensed_edges(e, n=t.tasks)
    a, b = F.col("node1").cast("long"), F.col("node2").cast("long")
    return out.select(F.least(a, b).alias("node1"), F.greatest(a, b).alias("node2"), "connections")


@query("e06_total_connections", "SELECT bin_id, CAST(coalesce(sum(connections), 0) AS BIGINT) AS total FROM (SELECT DISTINCT bin_id FROM brands) LEFT JOIN (SELECT x.bin_id AS bin_id, connections FROM both_e JOIN brands x ON node1 = x.contig_id JOIN brands y ON node2 = y.contig_id WHERE x.bin_id <> y.bin_id) USING (bin_id) GROUP BY 1")
def e06(t: Tables) -> DataFrame:
    return A.total_connections(t.brands(), A.symmetric(D.bin_connections(t.edges(), t.brands(), n=t.tasks)))


@query("e07_coverage_matrix", "SELECT contig_id, round(sum(depth) / 3, 3) AS average, max(CASE WHEN sample_idx = 1 THEN depth END) AS coverage_1, max(CASE WHEN sample_idx = 2 THEN depth END) AS coverage_2, max(CASE WHEN sample_idx = 3 THEN depth END) AS coverage_3 FROM depth GROUP BY 1")
def e07(t: Tables) -> DataFrame:
    return A.coverage_matrix(t.depth(), 3).select("contig_id", "average", "coverage_1", "coverage_2", "coverage_3")


def _ladder(head: str, steps: list[tuple[int, int, int, str]]) -> str:
    """A bucket ladder in SQL: the labels of ``head``, then steps of growing width."""
    rungs = " ".join(f"WHEN depth >= {low} AND depth < {high} THEN '{prefix}' || CAST({low} + {step} * ceil((depth - {low}) / {step}) AS BIGINT)" for low, high, step, prefix in steps)
    return f"CASE WHEN depth = 0 THEN '0000' WHEN depth < 9 THEN '000' || CAST(floor(depth + 1) AS BIGINT) WHEN depth = 9 THEN '0009' {head} {rungs} ELSE '10000' END"


COARSE = _ladder("WHEN depth < 10 THEN '0010'", S.COVERAGE_STEPS)
FINE = _ladder("WHEN depth < 20 THEN '00' || CAST(floor(depth + 1) AS BIGINT)", S.FINE_STEPS)


@query("i02_coverage_buckets", f"SELECT contig_id, sample_idx, {COARSE} AS coarse, {FINE} AS fine FROM depth")
def i02(t: Tables) -> DataFrame:
    return t.depth().select("contig_id", "sample_idx", S.covrange("depth").alias("coarse"), S.dcovrange("depth").alias("fine"))


@query("e09_bin_coverage", "SELECT bin_id, sample_idx, round(depth, 4) AS depth FROM bin_cov")
def e09(t: Tables) -> DataFrame:
    return A.bin_coverage(t.brands(), t.depth()).select("bin_id", "sample_idx", F.round("depth", 4).alias("depth"))


@query("e10_bin_gc", "SELECT source AS bin_id, round(100.0 * sum(length(text) - length(replace(replace(text, 'G', ''), 'C', ''))) / sum(length(text)), 1) AS gc, CAST(sum(length(text)) AS BIGINT) AS size, count(*) AS contigs FROM documents GROUP BY 1")
def e10(t: Tables) -> DataFrame:
    return A.bin_gc(t.members("source"), t.documents.select(F.col("doc_id").alias("contig_id"), F.col("text").alias("seq")))


@query("e11_shared_percent", "SELECT * FROM scored")
def e11(t: Tables) -> DataFrame:
    return P.scored(t.members("source"), t.members("lang"))


@query("e15_read_contigs", "SELECT read_id, contig_id, n FROM (SELECT *, count(*) OVER (PARTITION BY read_id) AS k FROM (SELECT read_id, contig_id, count(*) AS n FROM hits GROUP BY 1, 2)) WHERE k >= 2")
def e15(t: Tables) -> DataFrame:
    return A.read_contigs(t.hits(), 1, 2)


@query("e16_two_contig_edges", "SELECT node1, node2, count(*) AS connections FROM (SELECT read_id, min(contig_id) AS node1, max(contig_id) AS node2 FROM hits GROUP BY 1 HAVING count(DISTINCT contig_id) = 2) GROUP BY 1, 2")
def e16(t: Tables) -> DataFrame:
    return A.two_contig_edges(t.hits())


@query("e17_supported", "SELECT node1, node2, connections FROM edges WHERE connections >= 3")
def e17(t: Tables) -> DataFrame:
    return A.supported(t.edges(), "connections", 3)


@query("e18_nth_quartiles", "SELECT bin_id, sample_idx, CASE WHEN len(l) // 4 > 0 THEN l[len(l) // 4] END AS q1, CASE WHEN len(l) * 3 // 4 > 0 THEN l[len(l) * 3 // 4] END AS q3 FROM (SELECT bin_id, sample_idx, list_sort(list(depth)) AS l FROM bin_depths GROUP BY 1, 2)")
def e18(t: Tables) -> DataFrame:
    return A.nth_quartiles(t.bin_depths(), ["bin_id", "sample_idx"], "depth")


@query("e19_quartiles", "SELECT bin_id, sample_idx, round(q1, 4) AS q1, round(q3, 4) AS q3 FROM fence")
def e19(t: Tables) -> DataFrame:
    return A.quartiles(t.bin_depths(), ["bin_id", "sample_idx"], "depth").select("bin_id", "sample_idx", F.round("q1", 4).alias("q1"), F.round("q3", 4).alias("q3"))


@query("e21_core_contigs", "SELECT bin_id, contig_id FROM bin_depths JOIN fence USING (bin_id, sample_idx) GROUP BY 1, 2 HAVING bool_and(depth >= q1 - 1.5 * (q3 - q1) AND depth <= q3 + 1.5 * (q3 - q1))")
def e21(t: Tables) -> DataFrame:
    return A.core_contigs(t.bin_depths(), 1.5)


@query("e22_core_depth", ", core AS (SELECT bin_id, contig_id FROM bin_depths JOIN fence USING (bin_id, sample_idx) GROUP BY 1, 2 HAVING bool_and(depth >= q1 - 1.5 * (q3 - q1) AND depth <= q3 + 1.5 * (q3 - q1))) SELECT bin_id, sample_idx, round(coalesce(avg(CASE WHEN c.contig_id IS NOT NULL THEN depth END), 0), 4) AS depth FROM bin_depths d LEFT JOIN core c USING (bin_id, contig_id) GROUP BY 1, 2")
def e22(t: Tables) -> DataFrame:
    return A.core_depth(t.bin_depths(), A.core_contigs(t.bin_depths(), 1.5)).select("bin_id", "sample_idx", F.round("depth", 4).alias("depth"))


def _depth_pairs(t: Tables) -> DataFrame:
    """Connected pairs with the mean depths of both bins by sample."""
    c = A.bin_coverage(t.brands(), t.depth())
    one, two = c.toDF("bin1", "sample_idx", "depth1"), c.toDF("bin2", "sample_idx", "depth2")
    return connected_pairs(t).join(one, "bin1").join(two, ["bin2", "sample_idx"])


_DEPTH_PAIRS = "pairs JOIN bin_cov a ON a.bin_id = bin1 JOIN bin_cov b ON b.bin_id = bin2 AND a.sample_idx = b.sample_idx"


@query("e23_depth_ratio", f"SELECT a.bin_id AS bin1, b.bin_id AS bin2, a.sample_idx, round(a.depth / CASE WHEN b.depth = 0 THEN 1 ELSE b.depth END, 4) AS ratio FROM {_DEPTH_PAIRS}")
def e23(t: Tables) -> DataFrame:
    return A.depth_ratio(_depth_pairs(t)).select("bin1", "bin2", "sample_idx", F.round("ratio", 4).alias("ratio"))


@query("e25_vote", f"SELECT a.bin_id AS bin1, b.bin_id AS bin2, bool_and(100 * abs(a.depth - b.depth) / (a.depth + b.depth) <= 10) AS alike FROM {_DEPTH_PAIRS} GROUP BY 1, 2")
def e25(t: Tables) -> DataFrame:
    return A.vote(_depth_pairs(t))


@query("e26_veto", f"SELECT a.bin_id AS bin1, b.bin_id AS bin2 FROM {_DEPTH_PAIRS} GROUP BY 1, 2 HAVING NOT bool_or(200 * abs(a.depth - b.depth) / (a.depth + b.depth) > 20)")
def e26(t: Tables) -> DataFrame:
    return A.veto(_depth_pairs(t))


@query("e27_confirmed_clean", "SELECT bin_id, contig_id, bool_and(mean = 0 OR 100 * abs(depth - mean) / mean < 30 OR (depth >= q1 - (q3 - q1) AND depth <= q3 + (q3 - q1))) AS clean FROM bin_depths JOIN fence USING (bin_id, sample_idx) GROUP BY 1, 2")
def e27(t: Tables) -> DataFrame:
    return A.confirmed_clean(t.bin_depths())


@query("e28_first_ratios", "SELECT contig_id, sample_idx, round(CASE WHEN coalesce(one, 0) = 0 THEN depth ELSE depth / one END, 6) AS ratio FROM (SELECT *, max(CASE WHEN sample_idx = 1 THEN depth END) OVER (PARTITION BY contig_id) AS one FROM depth)")
def e28(t: Tables) -> DataFrame:
    return A.first_ratios(t.depth()).select("contig_id", "sample_idx", F.round("ratio", 6).alias("ratio"))


@query("e31_distinct_sequences", "SELECT doc_id AS contig_id, min(doc_id) OVER (PARTITION BY text) AS first, count(*) OVER (PARTITION BY text) AS copies FROM documents")
def e31(t: Tables) -> DataFrame:
    return A.sequence_classes(t.documents.select(F.col("doc_id").alias("contig_id"), F.col("text").alias("seq")))


def stats_sql(v: str) -> str:
    """The 15 statistics of a list of doubles as a list, in SQL."""
    n, mean, var = f"len({v})", f"list_avg({v})", f"list_var_pop({v})"
    total = lambda f: f"list_sum(list_transform({v}, lambda x: {f}))"
    peak, rms, mean_abs = f"list_max(list_transform({v}, lambda x: abs(x)))", f"sqrt({total('x * x')} / ({n} + 1e-7))", f"({total('abs(x)')} / ({n} + 1e-7))"
    root = f"pow({total('sqrt(abs(x))')} / ({n} + 1e-7), 2)"
    moment = lambda k: f"{total(f'pow(x - {mean}, {k})')} / (({n} - 1) * pow(sqrt({var}), {k}) + 1e-7)"
    return f"[{mean}, {var}, sqrt({var}), list_max({v}), list_min({v}), {peak}, {rms}, {mean_abs}, {root}, {rms} / ({mean} + 1e-7), {peak} / ({rms} + 1e-7), {peak} / ({mean} + 1e-7), {peak} / ({root} + 1e-7), {moment(3)}, {moment(4)}]"


#: Places of the statistics whose divisor is a mean that may be near 0; they are compared as rounded logarithms.
_STEEP = (9, 11)


@query("e33_vector_stats", f"SELECT vec_id, i - 1 AS place, round(CASE WHEN i - 1 IN {_STEEP} THEN ln(1 + abs(s[i])) ELSE s[i] END, 4) + 0.0::DOUBLE AS value FROM (SELECT vec_id, {stats_sql('v')} AS s, unnest(range(1, 16)) AS i FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings))")
def e33(t: Tables) -> DataFrame:
    s = t.embeddings.select("vec_id", F.posexplode(S.vector_stats(F.col("embedding").cast("array<double>"))).alias("place", "value"))
    return s.withColumn("value", F.round(F.when(F.col("place").isin(*_STEEP), F.log1p(F.abs("value"))).otherwise(F.col("value")), 4))


@query("e34_normalised", "SELECT bin_id, contig_id, sample_idx, round(abs(depth - m) / (greatest(hi - m, m - lo) + 1e-8), 5) AS scaled FROM bin_depths JOIN (SELECT bin_id, sample_idx, avg(depth) AS m, min(depth) AS lo, max(depth) AS hi FROM bin_depths GROUP BY 1, 2) USING (bin_id, sample_idx)")
def e34(t: Tables) -> DataFrame:
    return A.normalised(t.bin_depths(), ["bin_id", "sample_idx"], "depth").select("bin_id", "contig_id", "sample_idx", F.round("scaled", 5).alias("scaled"))


@query("fw1_best_hits", "SELECT * FROM best")
def fw1(t: Tables) -> DataFrame:
    return W.best_hits(P.scored(t.members("source"), t.members("lang")))


@query("fw2_accepted", "SELECT * FROM accepted")
def fw2(t: Tables) -> DataFrame:
    return W.accepted(W.best_hits(P.scored(t.members("source"), t.members("lang"))))


@query("fw3_numbered", "SELECT bin_id, round(d, 4) AS depth, row_number() OVER (ORDER BY round(d, 4), bin_id) AS n FROM (SELECT bin_id, avg(depth) AS d FROM bin_depths GROUP BY 1)")
def fw3(t: Tables) -> DataFrame:
    b = t.bin_depths().groupBy("bin_id").agg(F.round(F.avg("depth"), 4).alias("depth"))
    return W.numbered(b, [F.asc("depth"), F.asc("bin_id")])


@query("fw4_top_neighbours", "SELECT bin_id, contig_id, connections FROM (SELECT *, count(*) OVER (PARTITION BY bin_id) AS k, rank() OVER (PARTITION BY bin_id ORDER BY connections DESC) AS r FROM near) WHERE k <= 20 OR r <= 19")
def fw4(t: Tables) -> DataFrame:
    return W.top_neighbours(D.neighbours(t.brands(), t.edges(), t.tasks))


@query("fw5_third_largest", "SELECT bin_id, contig_id, connections FROM (SELECT *, count(*) OVER (PARTITION BY bin_id) AS k, list_sort(list(connections) OVER (PARTITION BY bin_id), 'DESC')[3] AS third FROM near) WHERE k < 8 OR connections >= third")
def fw5(t: Tables) -> DataFrame:
    return W.third_largest(D.neighbours(t.brands(), t.edges(), t.tasks), "connections")


@query("fw7_running_records", "SELECT user_id, event_id, value FROM (SELECT *, max(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM events) WHERE value >= 1 AND (b IS NULL OR value > b)")
def fw7(t: Tables) -> DataFrame:
    return W.running_records(t.events, "user_id", "value", "event_id", 1).select("user_id", "event_id", "value")


@query("fw8_best_alignment", "SELECT read_id, contig_id, score, ordinal FROM (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY score DESC, ordinal) AS r FROM hits) WHERE r = 1")
def fw8(t: Tables) -> DataFrame:
    return W.best_by(t.hits(), ["read_id"], "score", "ordinal")


@query("fw10_last_status", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def fw10(t: Tables) -> DataFrame:
    return W.last_by(t.events, ["user_id"], ["ts", "event_id"], ["event_id", "event_type"])


@query("g01_within_assembly", "SELECT bin1, bin2, CASE WHEN cpn1 - ctn1 > cpn2 - ctn2 THEN 1 WHEN cpn1 - ctn1 < cpn2 - ctn2 THEN 2 WHEN size1 > size2 THEN 1 ELSE 2 END AS winner FROM qp")
def g01(t: Tables) -> DataFrame:
    return _pairs(t).select("bin1", "bin2", G.within_assembly().alias("winner"))


@query("g02_across_assemblies", "SELECT bin1, bin2, CASE WHEN cpn1 - 5 * ctn1 > cpn2 - 5 * ctn2 THEN 1 WHEN cpn1 - 5 * ctn1 < cpn2 - 5 * ctn2 THEN 2 WHEN size1 = size2 AND n50_1 = n50_2 THEN 1 ELSE 0 END AS winner FROM qp")
def g02(t: Tables) -> DataFrame:
    return _pairs(t).select("bin1", "bin2", G.across_assemblies().alias("winner"))


@query("g04_survivors", "SELECT bin_id FROM quality_p WHERE bin_id NOT IN (SELECT CASE WHEN cpn1 - 5 * ctn1 > cpn2 - 5 * ctn2 THEN bin2 ELSE bin1 END FROM qp WHERE cpn1 - 5 * ctn1 <> cpn2 - 5 * ctn2)")
def g04(t: Tables) -> DataFrame:
    return G.survivors(brand_quality(t).select("bin_id"), _pairs(t).withColumn("winner", G.across_assemblies()))


@query("g05_refined", "SELECT bin1, bin2, CASE WHEN cpn1 - ctn1 > cpn2 - ctn2 AND cpn1 - 5 * ctn1 >= cpn2 - 5 * ctn2 THEN 'accept' WHEN cpn1 - ctn1 > cpn2 - ctn2 THEN 'deep' WHEN cpn1 > cpn2 AND cpn2 >= 40 AND ctn2 <= 10 AND ctn1 <= 50 THEN 'deep' ELSE 'keep' END AS verdict FROM qp")
def g05(t: Tables) -> DataFrame:
    p = _pairs(t).select("bin1", "bin2", F.col("cpn1").alias("cpn"), F.col("ctn1").alias("ctn"), F.col("cpn2").alias("cpn0"), F.col("ctn2").alias("ctn0"))
    return G.refined(p).select("bin1", "bin2", "verdict")


@query("h01_union", "SELECT 'a' AS side, bin_id, contig_id FROM mem_a UNION ALL SELECT 'b', bin_id, contig_id FROM mem_b")
def h01(t: Tables) -> DataFrame:
    return H.union(*[t.members(c).select(F.lit(s).alias("side"), "bin_id", "contig_id") for s, c in (("a", "source"), ("b", "lang"))])


@query("h03_in_both", "SELECT DISTINCT l_partkey AS contig_id FROM lineitem WHERE l_returnflag = 'A' AND l_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 40)")
def h03(t: Tables) -> DataFrame:
    one = t.lineitem.where("l_returnflag = 'A'").select(F.col("l_partkey").alias("contig_id")).distinct()
    return H.in_both(one, t.lineitem.where("l_returnflag = 'R' and l_quantity > 40").select(F.col("l_partkey").alias("contig_id")), "contig_id")


@query("h05_distinct_sets", "SELECT min(read_id) AS read_id FROM (SELECT read_id, string_agg(DISTINCT CAST(contig_id AS VARCHAR), ',' ORDER BY CAST(contig_id AS VARCHAR)) AS s FROM hits GROUP BY 1) GROUP BY s")
def h05(t: Tables) -> DataFrame:
    return H.distinct_sets(t.hits(), "read_id", ["contig_id"])


@query("i05_reverse_complement", "SELECT doc_id, md5(reverse(translate(text, 'ACGTacgt', 'TGCAtgca'))) AS digest FROM documents")
def i05(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(S.reverse_complement("text").cast("binary")).alias("digest"))


@query("j02_reach", ", strong AS (SELECT node1, node2 FROM both_e WHERE connections >= 2) SELECT bin_id, contig_id, min(level) AS level FROM (SELECT bin_id, contig_id, 0 AS level FROM brands UNION ALL SELECT b.bin_id, e.node2, 1 FROM brands b JOIN strong e ON b.contig_id = e.node1 UNION ALL SELECT b.bin_id, f.node2, 2 FROM brands b JOIN strong e ON b.contig_id = e.node1 JOIN strong f ON e.node2 = f.node1) GROUP BY 1, 2")
def j02(t: Tables) -> DataFrame:
    return J.reach(t.brands(), t.edges().where("connections >= 2"), 2, t.tasks)


@query("j04_connected_components")
def j04(t: Tables) -> DataFrame:
    return J.connected_components(t.edges().where("connections >= 3").select("node1", "node2"))


SQL["j04_connected_components"] = WITH.replace("WITH mem_a", "WITH RECURSIVE mem_a", 1) + ", walk AS (SELECT node1 AS x, node1 AS y FROM both_e WHERE connections >= 3 UNION SELECT w.x, e.node2 FROM walk w JOIN both_e e ON w.y = e.node1 AND e.connections >= 3) SELECT x AS node, min(y) AS component FROM walk GROUP BY 1"


@query("k02_outliers", "SELECT bin_id, contig_id, sample_idx, depth < q1 - 1.5 * (q3 - q1) OR depth > q3 + 1.5 * (q3 - q1) AS outlier FROM bin_depths JOIN fence USING (bin_id, sample_idx)")
def k02(t: Tables) -> DataFrame:
    d = t.bin_depths()
    return K.outside(d, d, 1.5, "depth", ["bin_id", "sample_idx"]).select("bin_id", "contig_id", "sample_idx", "outlier")


@query("k01_first_component")
def k01(t: Tables) -> DataFrame:
    return K.first_component(t.embeddings.select(F.col("label").alias("bin_id"), F.col("vec_id").alias("contig_id"), F.col("embedding").alias("vector")))


@query("k07_ensemble")
def k07(t: Tables) -> DataFrame:
    return K.ensemble(t.embeddings, [K.Network(64, seed=s) for s in range(5)], "vec_id", "embedding")


@query("k09_sample_subsets", "SELECT contig_id, a.sample_idx AS s1, b.sample_idx AS s2, a.depth AS d1, b.depth AS d2 FROM depth a JOIN depth b USING (contig_id) WHERE a.sample_idx < b.sample_idx")
def k09(t: Tables) -> DataFrame:
    s = K.sample_subsets(t.depth(), 3, 2)
    return s.select("contig_id", F.col("subset")[0].alias("s1"), F.col("subset")[1].alias("s2"), F.col("depths")[0].alias("d1"), F.col("depths")[1].alias("d2"))


@query("recruit", "SELECT bin_id, contig_id, connections FROM (SELECT *, count(*) OVER (PARTITION BY bin_id) AS k, rank() OVER (PARTITION BY bin_id ORDER BY connections DESC) AS r FROM near WHERE contig_id NOT IN (SELECT p_partkey FROM part WHERE p_size > 45)) WHERE k <= 20 OR r <= 19")
def recruit(t: Tables) -> DataFrame:
    bad = t.part.where("p_size > 45").select(F.col("p_partkey").alias("contig_id"))
    black = D.neighbours(t.brands(), t.edges(), t.tasks).join(bad, "contig_id", "left_semi").select("bin_id", "contig_id")
    return P.recruit(t.brands(), t.edges(), black, n=t.tasks)


def _mers(table: str, id_: str, name: str) -> str:
    return f"SELECT DISTINCT {id_} AS {name}, substr(text, CAST(i AS BIGINT), 21) AS m FROM (SELECT {id_}, text, unnest(range(1, length(text) - 19)) AS i FROM {table} WHERE length(text) >= 21)"


@query("d19_kmer_hits", f", q AS ({_mers('benchmark', 'item_id', 'query')}), d AS (SELECT * FROM ({_mers('documents', 'doc_id', 'subject')}) WHERE m IN (SELECT m FROM q)) SELECT query, subject, count(*) AS seeds FROM q JOIN d USING (m) GROUP BY 1, 2 HAVING count(*) >= 20")
def d19(t: Tables) -> DataFrame:
    return D.kmer_hits(t.benchmark.select(F.col("item_id").alias("id"), F.col("text").alias("seq")), t.documents.select(F.col("doc_id").alias("id"), F.col("text").alias("seq")), 21, 20)
