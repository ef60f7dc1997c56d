"""Joins, groupings, rankings, choices, sequences, iterations and models that the other modules leave out, with SQL.

Importing this module adds to ``QUERIES`` and ``SQL`` of ``contigra.queries``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigra.functions import scalar as S
from contigra.hit_queries import hit_query, trials, variants
from contigra.operators import aggregates as A
from contigra.operators import graph as J
from contigra.operators import joins as D
from contigra.operators import ml as K
from contigra.operators import selection as G
from contigra.operators import sequences as I
from contigra.operators import sets as H
from contigra.operators import windows as W
from contigra.plans import dereplicate as P
from contigra.queries import _DEPTH_PAIRS, FINE, SQL, WITH, Tables, _depth_pairs, brand_quality, connected_pairs, query


@query("d01_with_coverage", "SELECT bin_id, contig_id, length, sample_idx, depth FROM brands JOIN depth USING (contig_id)")
def d01(t: Tables) -> DataFrame:
    return D.with_coverage(t.brands(), t.depth())


@query("d02_contig_bins", "SELECT p_partkey AS contig_id, CAST(p_size AS BIGINT) AS length, b AS bin_id FROM part JOIN (SELECT DISTINCT l_partkey, l_returnflag || l_linestatus AS b FROM lineitem) ON p_partkey = l_partkey")
def d02(t: Tables) -> DataFrame:
    members = t.lineitem.select(F.concat("l_returnflag", "l_linestatus").alias("bin_id"), F.col("l_partkey").alias("contig_id"))
    return D.contig_bins(t.brands().select("contig_id", "length"), members)


@query("d22_unmapped_reads", "SELECT o_orderkey AS read_id, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 10)")
def d22(t: Tables) -> DataFrame:
    reads = t.orders.select(F.col("o_orderkey").alias("read_id"), "o_totalprice")
    mapped = t.lineitem.where("l_quantity > 10").select(F.col("l_orderkey").alias("read_id"))
    return D.members_of(reads, D.without(reads.select("read_id"), mapped, "read_id"), "read_id")


@query("e08_bin_average", "SELECT bin_id, round(avg(average), 6) AS average FROM brands JOIN (SELECT contig_id, round(sum(depth) / 3, 3) AS average FROM depth GROUP BY 1) USING (contig_id) GROUP BY 1")
def e08(t: Tables) -> DataFrame:
    return A.bin_average(t.brands(), A.coverage_matrix(t.depth(), 3)).select("bin_id", F.round("average", 6).alias("average"))


@query("e12_reciprocal_percent", "SELECT bin1, bin2, pct1, round(pct1 * s1.size / s2.size, 2) AS pct2 FROM scored JOIN sizes_a s1 ON bin1 = s1.bin_id JOIN sizes_b s2 ON bin2 = s2.bin_id")
def e12(t: Tables) -> DataFrame:
    a, b = t.members("source"), t.members("lang")
    pairs = P.scored(a, b).select("bin1", "bin2", "pct1").join(P.sizes(a).toDF("bin1", "size1"), "bin1").join(P.sizes(b).toDF("bin2", "size2"), "bin2")
    return A.reciprocal_percent(pairs).select("bin1", "bin2", "pct1", "pct2")


_SETS = "SELECT '{0}' AS how, l_returnflag, l_linestatus, grouping(l_returnflag, l_linestatus) AS level, count(DISTINCT l_suppkey) AS \"distinct\", count(*) AS \"rows\" FROM lineitem GROUP BY {0}(l_returnflag, l_linestatus)"


@query("e35_grouped_sets", f"{_SETS.format('cube')} UNION ALL {_SETS.format('rollup')}")
def e35(t: Tables) -> DataFrame:
    keys = ["l_returnflag", "l_linestatus"]
    both = [A.grouped_sets(t.lineitem.select(*keys, "l_suppkey"), keys, "l_suppkey", how).withColumn("how", F.lit(how)) for how in ("cube", "rollup")]
    return both[0].unionByName(both[1])


@query("fw6_bin_records", "SELECT bin_id, contig_id, length FROM (SELECT *, max(length) OVER (PARTITION BY bin_id ORDER BY contig_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM mem_a) WHERE length >= 50 AND (b IS NULL OR length > b)")
def fw6(t: Tables) -> DataFrame:
    return W.running_records(t.members("source"), "bin_id", "length", "contig_id")


@query("fw9_first_row", "SELECT query, subject, ordinal FROM (SELECT l_partkey AS query, l_suppkey AS subject, l_orderkey * 10 + l_linenumber AS ordinal, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey * 10 + l_linenumber, l_suppkey) AS r FROM lineitem) WHERE r = 1")
def fw9(t: Tables) -> DataFrame:
    h = t.lineitem.select(F.col("l_partkey").alias("query"), F.col("l_suppkey").alias("subject"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ordinal"))
    return W.first_row(h.withColumn("at", F.struct("ordinal", "subject")), ["query"], "at").select("query", "subject", "ordinal")


@query("fw11_ordered", "SELECT bin_id, completeness, contamination FROM quality_p ORDER BY completeness DESC, bin_id")
def fw11(t: Tables) -> DataFrame:
    return W.ordered(brand_quality(t).select("bin_id", "completeness", "contamination"), F.desc("completeness"), "bin_id")


@query("fw12_has_rows", "SELECT k, (SELECT count(*) FROM documents) >= k AS enough FROM (SELECT unnest([1::BIGINT, 100, 1000000000]) AS k)")
def fw12(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([(k, W.has_rows(t.documents.select("doc_id"), k)) for k in (1, 100, 10**9)], "k long, enough boolean")


@hit_query("g10_base_variant", "SELECT base, variant FROM (SELECT *, row_number() OVER (PARTITION BY base ORDER BY five DESC, dots DESC, one DESC, variant DESC) AS r FROM (SELECT p_brand || p_type AS base, 2.0 * p_size - 5 * (p_partkey % 7) AS five, p_partkey % 3 AS dots, p_partkey % 2 = 1 AS one, repeat('.', CAST(p_partkey % 3 AS INTEGER)) || p_partkey AS variant FROM part)) WHERE r = 1")
def g10(t: Tables) -> DataFrame:
    n = F.col("number")
    dots = F.when(n % 3 == 0, "").when(n % 3 == 1, ".").otherwise("..")
    v = variants(t).join(t.part.select(F.col("p_partkey").alias("number"), "p_type"), "number")
    return G.best_variant(v.select(F.concat("bin_id", "p_type").alias("base"), F.concat(dots, n.cast("string")).alias("variant"), "completeness", "contamination", (n % 2).cast("string").alias("threshold")), "base").select("base", "variant")


@query("g16_merged_ties", f", late AS (SELECT bin_id, CAST(substr(bin_id, 7, 1) AS DOUBLE) AS ctn, genome_size, n50 FROM quality_p), alike AS (SELECT a.bin_id AS one, b.bin_id AS two FROM {_DEPTH_PAIRS} GROUP BY 1, 2 HAVING NOT bool_or(200 * abs(a.depth - b.depth) / (a.depth + b.depth) > 20)) SELECT bin1, bin2, CASE WHEN a.ctn < b.ctn THEN 1 WHEN a.ctn > b.ctn THEN 2 WHEN a.genome_size = b.genome_size AND a.n50 = b.n50 THEN 1 WHEN one IS NOT NULL THEN 1 ELSE 0 END AS winner FROM pairs JOIN late a ON bin1 = a.bin_id JOIN late b ON bin2 = b.bin_id LEFT JOIN alike ON bin1 = one AND bin2 = two")
def g16(t: Tables) -> DataFrame:
    """Pairs judged by later scores, which tie for many of them, and then by depth."""
    late = brand_quality(t).withColumns({"completeness": F.lit(50.0), "contamination": F.substring("bin_id", 7, 1).cast("double")})
    return G.merged_ties(connected_pairs(t), late, _depth_pairs(t))


@query("h06_concatenated", "SELECT 'd' || doc_id AS contig_id, n_chars AS length FROM documents UNION ALL SELECT 'p' || p_partkey, p_size FROM part UNION ALL SELECT 'b' || item_id, length(text) FROM benchmark")
def h06(t: Tables) -> DataFrame:
    named = lambda df, letter, id_, n: df.select(F.concat(F.lit(letter), F.col(id_).cast("string")).alias("contig_id"), n.cast("long").alias("length"))
    return H.union(named(t.documents, "d", "doc_id", F.col("n_chars")), named(t.part, "p", "p_partkey", F.col("p_size")), named(t.benchmark, "b", "item_id", F.length("text")))


@query("i01_intervalue", "SELECT p_partkey, CASE WHEN ceil(p_size / 3) <= 13 THEN CAST(3 * ceil(p_size / 3) AS BIGINT) END AS value FROM part")
def i01(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", S.intervalue(0, 40, 3, "p_size").alias("value"))


@query("i03_fine_buckets", f"SELECT p_partkey, {FINE} AS bucket FROM (SELECT p_partkey, p_retailprice AS depth FROM part)")
def i03(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", S.dcovrange("p_retailprice").alias("bucket"))


@query("i06_merged_overlaps", "SELECT 'q' || doc_id || '--s' || doc_id AS contig_id, md5(text) AS digest FROM documents WHERE length(text) >= 3")
def i06(t: Tables) -> DataFrame:
    """The first and the last two thirds of each text, every second one turned over, merge into the text again."""
    d = t.documents.where(F.length("text") >= 3).withColumns({"n": F.floor(F.length("text") / 3).cast("int"), "m": F.length("text"), "q": F.concat(F.lit("q"), F.col("doc_id").cast("string")), "s": F.concat(F.lit("s"), F.col("doc_id").cast("string")), "back": F.col("doc_id") % 2 == 1})
    tail = F.substring("text", F.col("n") + 1, F.col("m"))
    contigs = d.select(F.col("q").alias("contig_id"), F.substring("text", F.lit(1), 2 * F.col("n")).alias("seq")).union(d.select("s", F.when(F.col("back"), S.reverse_complement(tail)).otherwise(tail)))
    rest = F.col("m") - F.col("n")
    hits = d.select(F.col("q").alias("query"), F.col("s").alias("subject"), (F.col("n") + 1).alias("qstart"), (2 * F.col("n")).alias("qend"), F.when(F.col("back"), rest).otherwise(1).alias("sstart"), F.when(F.col("back"), rest - F.col("n") + 1).otherwise(F.col("n")).alias("send"), F.when(F.col("back"), "-").otherwise("+").alias("strand"))
    return I.merge_overlaps(hits, contigs).select("contig_id", F.md5(F.col("seq").cast("binary")).alias("digest"))


@query("i07_bridged", "SELECT 'a' || doc_id || '--b' || doc_id AS contig_id, md5(text) AS digest FROM documents WHERE length(text) >= 6")
def i07(t: Tables) -> DataFrame:
    """Two parts of each text, apart or overlapping, joined over the whole text as the read that spans both."""
    n = F.floor(F.length("text") / 3).cast("int")
    id_ = F.col("doc_id").cast("string")
    d = t.documents.where(F.length("text") >= 6).withColumn("start", F.when(F.col("doc_id") % 2 == 0, 2 * n + 1).otherwise(n - 1))
    two = F.substring("text", F.col("start"), F.length("text"))
    back = F.col("doc_id") % 3 == 0
    return I.bridge(d.select(F.concat(F.lit("a"), id_).alias("contig1"), F.concat(F.lit("b"), id_).alias("contig2"), F.substring("text", F.lit(1), n).alias("seq1"), F.when(back, S.reverse_complement(two)).otherwise(two).alias("seq2"), F.lit("+").alias("strand1"), F.when(back, "-").otherwise("+").alias("strand2"), n.alias("read_end1"), F.col("start").alias("read_start2"), F.col("text").alias("read"))).select("contig_id", F.md5(F.col("seq").cast("binary")).alias("digest"))


@query("i11_scores", "SELECT bin_id, round(completeness - contamination, 6) AS within, round(completeness - 5 * contamination, 6) AS across FROM quality")
def i11(t: Tables) -> DataFrame:
    return t.quality().select("bin_id", F.round(S.delta("completeness", "contamination"), 6).alias("within"), F.round(S.delta("completeness", "contamination", 5), 6).alias("across"))


@query("i13_prefix_id", "SELECT p_partkey, split_part(replace(p_name, ' ', '_'), '_', 1) AS id FROM part")
def i13(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", S.prefix_id(F.translate("p_name", " ", "_")).alias("id"))


@query("i15_round_even", "SELECT p_partkey, round_even(CAST(p_size AS DOUBLE) / 8, 2) AS value FROM part")
def i15(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", S.round_even(F.col("p_size") / 8, 2).alias("value"))


@query("j06_similar_clusters")
def j06(t: Tables) -> DataFrame:
    return J.connected_components(D.similar_coverage(A.bin_coverage(t.brands(), t.depth()), 10, 5))


SQL["j06_similar_clusters"] = WITH.replace("WITH mem_a", "WITH RECURSIVE mem_a", 1) + ", alike AS (SELECT a.bin_id AS x, b.bin_id AS y FROM bin_cov a JOIN bin_cov b ON a.sample_idx = b.sample_idx AND a.bin_id <> b.bin_id GROUP BY 1, 2 HAVING bool_and(a.depth <= 10 OR b.depth <= 10 OR 200.0 * abs(a.depth - b.depth) / (a.depth + b.depth) <= 5)), walk AS (SELECT x, y FROM alike UNION SELECT w.x, e.y FROM walk w JOIN alike e ON w.y = e.x) SELECT x AS node, least(x, min(y)) AS component FROM walk GROUP BY 1"


def _folded(n: int, a: int, b: int) -> str:
    """Bin sets a and b (tables m: members, q: quality) merged into set n, in SQL."""
    sizes = lambda i: f"(SELECT bin_id, sum(length) AS size FROM m{i} GROUP BY 1)"
    kept = lambda k, i, side: f"SELECT * FROM {k}{i} WHERE bin_id NOT IN (SELECT bin{side} FROM w{n} WHERE winner = {3 - side})"
    return f""", p{n} AS (SELECT bin1, bin2, round(100.0 * shared / s.size, 2) AS pct1, round(100.0 * shared / u.size, 2) AS pct2 FROM (SELECT x.bin_id AS bin1, y.bin_id AS bin2, sum(x.length) AS shared FROM m{a} x JOIN m{b} y USING (contig_id) GROUP BY 1, 2) JOIN {sizes(a)} s ON bin1 = s.bin_id JOIN {sizes(b)} u ON bin2 = u.bin_id),
    h{n} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY bin1 ORDER BY pct1 DESC, bin2) AS r FROM p{n}) WHERE r = 1 AND (pct1 + pct2 >= 100 OR pct1 >= 50 OR pct2 >= 50)),
    w{n} AS (SELECT bin1, bin2, CASE WHEN x.completeness - x.contamination > y.completeness - y.contamination THEN 1 WHEN x.completeness - x.contamination < y.completeness - y.contamination THEN 2 WHEN x.genome_size > y.genome_size THEN 1 ELSE 2 END AS winner FROM h{n} JOIN q{a} x ON bin1 = x.bin_id JOIN q{b} y ON bin2 = y.bin_id),
    m{n} AS ({kept('m', a, 1)} UNION ALL {kept('m', b, 2)}), q{n} AS ({kept('q', a, 1)} UNION ALL {kept('q', b, 2)})"""


@query("j07_folded_sets", ", m1 AS (SELECT * FROM mem_a), q1 AS (SELECT * FROM quality), m2 AS (SELECT * FROM mem_b), q2 AS (SELECT * FROM quality_b), m3 AS (SELECT 'm' || doc_id % 7 AS bin_id, doc_id AS contig_id, n_chars AS length FROM documents), q3 AS (SELECT 'm' || doc_id % 7 AS bin_id, round(100 * avg(l.quality), 4) AS completeness, round(100 * avg(l.toxic), 4) AS contamination, CAST(sum(n_chars) AS BIGINT) AS genome_size, CAST(max(n_chars) AS DOUBLE) AS n50 FROM documents JOIN labels l USING (doc_id) GROUP BY 1)" + _folded(4, 1, 2) + _folded(5, 4, 3) + " SELECT bin_id, contig_id, length FROM m5")
def j07(t: Tables) -> DataFrame:
    """Three sets: by source, by language, by remainder of the id."""
    third = F.concat(F.lit("m"), (F.col("doc_id") % 7).cast("string")).alias("bin_id")
    members = t.documents.select(third, F.col("doc_id").alias("contig_id"), F.col("n_chars").alias("length"))
    quality = t.documents.join(t.labels, "doc_id").groupBy(third).agg(F.round(100 * F.avg("quality"), 4).alias("completeness"), F.round(100 * F.avg("toxic"), 4).alias("contamination"), F.sum("n_chars").alias("genome_size"), F.max("n_chars").cast("double").alias("n50"))
    return P.dereplicate_all([(t.members("source"), t.quality()), (t.members("lang"), t.quality("lang")), (members, quality)])[0]


@hit_query("j09_fixpoint", "SELECT trial, CASE WHEN ctn <= 4 THEN ctn ELSE ctn - 4 * ceil((ctn - 4) / 4) END AS ctn FROM trials")
def j09(t: Tables) -> DataFrame:
    """Rounds that take 4 off every contamination above 4, until their sum stays."""
    polish = lambda df: df.withColumn("ctn", F.when(F.col("ctn") > 4, F.col("ctn") - 4).otherwise(F.col("ctn")))
    return J.fixpoint(trials(t).select("trial", "ctn"), polish, lambda df: df.agg(F.sum("ctn")).first()[0])


@query("j10_retrieval", ", strong AS (SELECT node1, node2 FROM both_e WHERE connections >= 2), found AS (SELECT bin_id, contig_id, min(level) AS level FROM (SELECT bin_id, contig_id, 0 AS level FROM brands UNION ALL SELECT b.bin_id, e.node2, 1 FROM brands b JOIN strong e ON b.contig_id = e.node1 UNION ALL SELECT b.bin_id, f.node2, 2 FROM brands b JOIN strong e ON b.contig_id = e.node1 JOIN strong f ON e.node2 = f.node1) GROUP BY 1, 2) SELECT bin_id, contig_id, level, cutoff FROM found JOIN depth USING (contig_id) JOIN fence USING (bin_id, sample_idx) CROSS JOIN (SELECT unnest([1.0::DOUBLE, 1.2, 1.5]) AS cutoff) WHERE level > 0 GROUP BY 1, 2, 3, 4 HAVING bool_and(depth >= q1 - cutoff * (q3 - q1) AND depth <= q3 + cutoff * (q3 - q1))")
def j10(t: Tables) -> DataFrame:
    return J.retrieval(t.brands(), t.edges().where("connections >= 2"), t.depth(), 2, n=t.tasks)


@query("j11_roadmap", "SELECT read_id, row_number() OVER (PARTITION BY read_id ORDER BY start, contig_id, strand) - 1 AS place, contig_id, strand FROM (SELECT *, count(*) OVER (PARTITION BY read_id) AS k FROM (SELECT l_orderkey AS read_id, l_partkey AS contig_id, l_linenumber AS start, CASE l_linestatus WHEN 'F' THEN '+' ELSE '-' END AS strand, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_extendedprice DESC, l_linenumber) AS r FROM lineitem) WHERE r = 1) WHERE k >= 2")
def j11(t: Tables) -> DataFrame:
    h = t.lineitem.select(F.col("l_orderkey").alias("read_id"), F.col("l_partkey").alias("contig_id"), F.col("l_linenumber").alias("start"), F.when(F.col("l_linestatus") == "F", "+").otherwise("-").alias("strand"), F.col("l_extendedprice").alias("score"))
    return J.roadmap(h).select("read_id", F.posexplode("contigs").alias("place", "c")).select("read_id", "place", "c.contig_id", "c.strand")


#: First axes of groups of points (g, x, y) in closed form, with the largest part positive.
_AXES = """, sums AS (SELECT g, avg(x) AS mx, avg(y) AS my, 0.5 * atan2(2 * covar_pop(x, y), var_pop(x) - var_pop(y)) AS a FROM points GROUP BY 1),
axes AS (SELECT g, mx, my, s * cos(a) AS vx, s * sin(a) AS vy FROM (SELECT *, CASE WHEN abs(cos(a)) >= abs(sin(a)) THEN sign(cos(a)) ELSE sign(sin(a)) END AS s FROM sums)),
own_pc AS (SELECT g, id, (x - mx) * vx + (y - my) * vy AS pc FROM points JOIN axes USING (g)), pc_fence AS (SELECT g, quantile_cont(pc, 0.25) AS q1, quantile_cont(pc, 0.75) AS q3 FROM own_pc GROUP BY 1)"""
_PROFILES = """, wide AS (SELECT contig_id AS id, CASE WHEN one = 0 THEN 0.1 ELSE one END AS one, two, three FROM (SELECT contig_id, coalesce(max(CASE WHEN sample_idx = 1 THEN depth END), 0) AS one, coalesce(max(CASE WHEN sample_idx = 2 THEN depth END), 0) AS two, coalesce(max(CASE WHEN sample_idx = 3 THEN depth END), 0) AS three FROM depth GROUP BY 1)),
profiles AS (SELECT id, two / one AS x, three / one AS y FROM wide), points AS (SELECT bin_id AS g, id, x, y FROM brands JOIN profiles ON contig_id = id)"""
_OUT = "pc < q1 - 1.5 * (q3 - q1) OR pc > q3 + 1.5 * (q3 - q1)"


@query("k01_depth_component", _PROFILES + _AXES + " SELECT g AS bin_id, id AS contig_id, round(pc, 4) + 0.0::DOUBLE AS pc1 FROM own_pc")
def k01(t: Tables) -> DataFrame:
    """K-1 on depth profiles of three samples, which have two ratios."""
    v = t.brands().select("bin_id", "contig_id").join(K.depth_profiles(t.depth(), 3), "contig_id")
    return K.first_component(v).select("bin_id", "contig_id", (F.round("pc1", 4) + 0.0).alias("pc1"))


@query("k02_candidate_outliers", _PROFILES + _AXES + f", by_depth AS (SELECT bin_id, contig_id, bool_or(depth < q1 - 1.5 * (q3 - q1) OR depth > q3 + 1.5 * (q3 - q1)) AS d FROM near JOIN depth USING (contig_id) JOIN fence USING (bin_id, sample_idx) GROUP BY 1, 2), tried AS (SELECT g, n.contig_id, (x - mx) * vx + (y - my) * vy AS pc FROM near n JOIN profiles ON n.contig_id = id JOIN axes ON g = n.bin_id) SELECT bin_id, contig_id, d AS by_depth, {_OUT} AS by_profile, d OR {_OUT} AS outlier FROM by_depth JOIN (SELECT g AS bin_id, contig_id, pc FROM tried) USING (bin_id, contig_id) JOIN pc_fence ON g = bin_id")
def k02(t: Tables) -> DataFrame:
    return K.coverage_outliers(t.brands(), D.neighbours(t.brands(), t.edges(), t.tasks), t.depth(), 3)


@query("k03_vector_outliers", ", points AS (SELECT label AS g, vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)" + _AXES + f" SELECT g AS bin_id, id AS contig_id, {_OUT} AS outlier FROM (SELECT a.g, p.id, (x - mx) * vx + (y - my) * vy AS pc FROM points p JOIN axes a ON p.g <> a.g) JOIN pc_fence USING (g)")
def k03(t: Tables) -> DataFrame:
    """K-3 on two parts of each vector: every vector as a candidate for the groups of all other labels (a fixed number)."""
    v = t.embeddings.select(F.col("label").alias("bin_id"), F.col("vec_id").alias("contig_id"), F.slice(F.col("embedding").cast("array<double>"), 1, 2).alias("vector"))
    labels = [r[0] for r in v.select("bin_id").distinct().collect()]
    tried = v.withColumn("other", F.explode(F.array(*map(F.lit, labels)))).where("other <> bin_id").select(F.col("other").cast("int").alias("bin_id"), "contig_id", "vector")
    return K.candidate_outliers(v, tried).select("bin_id", "contig_id", "outlier")


NETWORKS = [K.Network(2, hidden=3, seed=s) for s in range(3)]


def _network_sql(w: dict, n: int) -> str:
    """The class that a network of weights ``w`` gives the points (id, x0, x1), in SQL: one subquery a layer."""

    def layer(sql: str, k: str, letter: str, out: str, keep: str = "", norm: str = "", more: str = "") -> str:
        a, b = w[k], w[f"{k}.bias"]
        columns = []
        for j in range(a.shape[1]):
            e = " + ".join([f"{b[j]:.17e}", *(f"{letter}{i} * {a[i, j]:.17e}" for i in range(a.shape[0]))])
            if norm:
                e = f"greatest((({e}) - {w[norm + '.mean'][j]:.17e}) / sqrt({w[norm + '.var'][j]:.17e} + 1e-5) * {w[norm + '.scale'][j]:.17e} + {w[norm + '.shift'][j]:.17e}, 0)"
            columns.append(f"{e}{f' + 2 * {more}{j}' if more else ''} AS {out}{j}")
        return f"(SELECT id, {keep}{', '.join(columns)} FROM {sql})"

    size = w["embed"].shape[1]
    carry = "".join(f"h{i}, " for i in range(size))
    sql = layer("points", "embed", "x", "h")
    for block in ("m1", "m2"):
        sql = layer(layer(sql, f"{block}.0", "h", "u", carry, f"{block}.0"), f"{block}.1", "u", "v", carry, f"{block}.1")
        sql = layer(sql, f"{block}.2", "v", "h", "", "", "h")
    return f"(SELECT id, CASE WHEN c1 > c0 THEN 1 ELSE 0 END AS vote{n} FROM {layer(sql, 'cls', 'h', 'c')})"


@query("k06_networks", ", points AS (SELECT p_partkey AS id, CAST(p_size AS DOUBLE) / 50 AS x0, p_retailprice / 2000 AS x1 FROM part) SELECT id AS contig_id, CAST(vote0 + vote1 + vote2 AS BIGINT) AS votes FROM " + " JOIN ".join(_network_sql(net.w, n) + f" n{n}" + (" USING (id)" if n else "") for n, net in enumerate(NETWORKS)))
def k06(t: Tables) -> DataFrame:
    """K-6 and K-7 with parameters that went through a table."""
    loaded = [K.Network.load(n.parameters(t.spark), 2) for n in NETWORKS]
    v = t.part.select(F.col("p_partkey").alias("contig_id"), F.array(F.col("p_size") / 50, F.col("p_retailprice") / 2000).alias("vector"))
    return K.ensemble(v, loaded, "contig_id")


@query("refine", ", flagged AS (SELECT bin_id, contig_id, sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) > 8 AS positive FROM brands JOIN lineitem ON contig_id = l_partkey GROUP BY 1, 2), sound AS (SELECT bin_id, contig_id, bool_and(mean = 0 OR 100 * abs(depth - mean) / mean < 30 OR (depth >= q1 - (q3 - q1) AND depth <= q3 + (q3 - q1))) AS clean FROM bin_depths JOIN fence USING (bin_id, sample_idx) GROUP BY 1, 2) SELECT bin_id, contig_id, positive AND NOT clean AS outlier FROM flagged JOIN sound USING (bin_id, contig_id)")
def refine(t: Tables) -> DataFrame:
    votes = t.brands().join(t.lineitem.select(F.col("l_partkey").alias("contig_id"), (F.col("l_linestatus") == "F").cast("int").alias("vote")), "contig_id")
    return P.refine(t.bin_depths(), votes, 20)
