"""Readers and writers by round trip: the driver's tables are written in each format, read back, and held against SQL.

What is written lies in a new folder of the session's shared folder.  Importing this module adds to ``QUERIES`` and ``SQL``.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contigra.hit_queries import alignments, hit_query
from contigra.operators import aggregates as A
from contigra.operators.graph import shared_folder
from contigra.queries import Tables, brand_quality, query
from contigra.sources import readers as R
from contigra.sources import writers as B


def folder(t: Tables, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def sequences(t: Tables) -> DataFrame:
    """Documents as contigs of letters only, in bins by language."""
    return t.documents.select(F.col("lang").alias("bin_id"), text("doc_id").alias("contig_id"), F.regexp_replace("text", "[^A-Za-z]", "").alias("seq"))


SEQUENCES = ", seqs AS (SELECT lang AS bin_id, CAST(doc_id AS VARCHAR) AS contig_id, regexp_replace(text, '[^A-Za-z]', '', 'g') AS seq FROM documents) "


@query("a01_fasta", SEQUENCES + "SELECT contig_id, CAST(length(seq) AS INTEGER) AS length, md5(seq) AS digest FROM seqs")
def a01(t: Tables) -> DataFrame:
    path = folder(t, "fasta")
    B.write_fasta(sequences(t), path)
    return R.read_fasta(t.spark, f"{path}/*").select("contig_id", "length", F.md5(F.col("seq").cast("binary")).alias("digest"))


def reads(t: Tables) -> DataFrame:
    return sequences(t).select("bin_id", (F.length("seq") % 2 + 1).alias("mate"), F.col("contig_id").alias("read_id"), "seq", F.regexp_replace("seq", ".", "I").alias("qual"))


@query("a02_fastq", SEQUENCES + "SELECT contig_id AS read_id, CAST(length(seq) % 2 + 1 AS INTEGER) AS mate, md5(seq) AS digest, length(seq) AS quals, true AS whole FROM seqs")
def a02(t: Tables) -> DataFrame:
    path = folder(t, "fastq")
    B.write_fastq(reads(t), path)
    both = [R.read_fastq(t.spark, f"{path}/bin_id=*/mate={m}", m) for m in (1, 2)]
    return both[0].union(both[1]).select("read_id", "mate", F.md5(F.col("seq").cast("binary")).alias("digest"), F.length("qual").cast("long").alias("quals"), "whole")


@query("a03_sam", "SELECT 'r' || l_orderkey AS qname, CAST(16 + l_linenumber AS INTEGER) AS flag, 'c' || l_partkey AS rname, CAST(l_suppkey AS INTEGER) AS pos, CAST(l_quantity AS INTEGER) AS mapq, CAST(l_quantity AS INTEGER) || 'M' AS cigar, 'ACGT' AS seq FROM lineitem WHERE l_linenumber <> 7")
def a03(t: Tables) -> DataFrame:
    """Lines of eleven fields and header lines are no alignments."""
    n = F.col("l_quantity").cast("int").cast("string")
    fields = [F.concat(F.lit("r"), text("l_orderkey")), text(16 + F.col("l_linenumber")), F.concat(F.lit("c"), text("l_partkey")), text("l_suppkey"), n, F.concat(n, F.lit("M"))]
    fields += [F.lit(x) for x in ("*", "0", "0", "ACGT", "IIII")] + [F.when(F.col("l_linenumber") != 7, "NM:i:0")]
    heads = t.region.select(F.concat(F.lit("@SQ\t"), "r_name").alias("value"))
    path = folder(t, "sam")
    t.lineitem.select(F.concat_ws("\t", *fields).alias("value")).union(heads).write.text(path)
    return R.read_sam(t.spark, path).select("qname", "flag", "rname", "pos", "mapq", "cigar", "seq")


_DEPTHS = "SELECT CAST(contig_id AS VARCHAR) AS contig_id, length, s AS sample_idx, coalesce(max(CASE WHEN d.sample_idx = s THEN depth END), {}) AS depth FROM (SELECT contig_id, length, CAST(unnest([1, 2, 3]) AS INTEGER) AS s FROM brands) LEFT JOIN depth d USING (contig_id) GROUP BY 1, 2, 3"


@query("a04_depth", _DEPTHS.format("0"))
def a04(t: Tables) -> DataFrame:
    wide = A.coverage_matrix(t.depth(), 3)
    own = t.brands().join(wide, "contig_id", "left")
    c = [F.coalesce(f"coverage_{i}", F.lit(0.0)) for i in (1, 2, 3)]
    path = folder(t, "depth")
    B.write_tsv(own.select(F.col("contig_id").alias("contigName"), F.col("length").alias("contigLen"), F.coalesce("total", F.lit(0.0)).alias("totalAvgDepth"), *[x for i, d in enumerate(c, 1) for x in (d.alias(f"s{i}.bam"), F.lit(1.5).alias(f"s{i}.bam-var"))]), path)
    return R.read_depth(t.spark, path)



@query("a05_coverage_matrix", _DEPTHS.format("NULL"))
def a05(t: Tables) -> DataFrame:
    wide = t.brands().select("contig_id", "length").join(A.coverage_matrix(t.depth(), 3), "contig_id", "left")
    path = folder(t, "coverage")
    B.write_tsv(wide, path)
    return R.read_coverage_matrix(t.spark, path)


@query("a06_quality", "SELECT layout, bin_id, genome_size, completeness, contamination, n50 FROM quality_p CROSS JOIN (SELECT unnest(['own', 'raw']) AS layout)")
def a06(t: Tables) -> DataFrame:
    q = brand_quality(t)
    none = [F.lit("-").alias(f"x{i}") for i in range(4)]
    layouts = {"own": q.select("bin_id", "genome_size", "completeness", "contamination", "n50"), "raw": q.select(F.col("bin_id").alias("Name"), "completeness", "contamination", *none[:3], "n50", none[3], "genome_size")}
    out = []
    for name, df in layouts.items():
        path = folder(t, "quality")
        B.write_tsv(df, path)
        out.append(R.read_quality(t.spark, path).withColumn("layout", F.lit(name)))
    return out[0].unionByName(out[1])


@query("a07_checkm1", "SELECT bin_id, CASE WHEN contamination < 12 THEN 'g__X' ELSE 'root' END AS lineage, CASE WHEN contamination < 12 THEN completeness ELSE 0 END AS completeness, CASE WHEN contamination < 12 THEN CAST(genome_size AS DOUBLE) ELSE 0 END AS genome_size, CASE WHEN contamination < 12 THEN contamination ELSE 0 END AS contamination, CASE WHEN contamination < 12 THEN n50 ELSE 0 END AS mean_scaffold_length FROM quality_p")
def a07(t: Tables) -> DataFrame:
    """Bins that the scorer left without values are root and 0."""
    own = F.format_string("{'marker lineage': 'g__X', 'Completeness': %s, 'Genome size': %s, 'Contamination': %s, 'Mean scaffold length': %s}", *map(text, ("completeness", "genome_size", "contamination", "n50")))
    path = folder(t, "checkm1")
    brand_quality(t).select(F.concat("bin_id", F.lit("\t"), F.when(F.col("contamination") < 12, own).otherwise("{}")).alias("value")).write.text(path)
    return R.read_checkm1(t.spark, path)


@query("a08_kmers", "SELECT CAST(p_partkey AS VARCHAR) AS contig_id, i - 1 AS place, [CAST(p_size AS DOUBLE), p_retailprice, 0.25::DOUBLE][i] AS share FROM (SELECT *, unnest([1, 2, 3]) AS i FROM part)")
def a08(t: Tables) -> DataFrame:
    path = folder(t, "kmers")
    B.write_tsv(t.part.select(F.col("p_partkey").alias("Contig"), F.col("p_size").alias("AAAA"), F.col("p_retailprice").alias("AAAT"), F.lit(0.25).alias("AAAC")), path)
    return R.read_kmers(t.spark, path).select("contig_id", F.posexplode("kmers").alias("place", "share"))


@query("a09_connections", "SELECT CAST(node1 AS VARCHAR) AS node1, CAST(0 AS INTEGER) AS interaction, CAST(node2 AS VARCHAR) AS node2, connections FROM edges")
def a09(t: Tables) -> DataFrame:
    path = folder(t, "connections")
    B.write_tsv(t.edges().select("node1", F.lit(0).alias("interaction"), "node2", "connections"), path)
    return R.read_connections(t.spark, path)


@hit_query("a10_blast6", "SELECT l_linenumber = 7 AS broken, CASE WHEN l_linenumber = 7 THEN 'broken ' || l_orderkey ELSE CAST(query AS VARCHAR) END AS query, CASE WHEN l_linenumber <> 7 THEN CAST(subject AS VARCHAR) END AS subject, CASE WHEN l_linenumber = 7 THEN 1 ELSE identity END AS identity, CAST(CASE WHEN l_linenumber = 7 THEN 1 ELSE length END AS INTEGER) AS length, CAST(CASE WHEN l_linenumber = 7 THEN 1 ELSE qstart END AS INTEGER) AS qstart, CAST(CASE WHEN l_linenumber = 7 THEN 0 ELSE qend END AS INTEGER) AS qend, CAST(CASE WHEN l_linenumber = 7 THEN 1 ELSE sstart END AS INTEGER) AS sstart, CAST(CASE WHEN l_linenumber = 7 THEN 0 ELSE send END AS INTEGER) AS send FROM aln")
def a10(t: Tables) -> DataFrame:
    fields = F.concat_ws("\t", *map(text, ("query", "subject", "identity", "length")), F.lit("0"), F.lit("0"), *map(text, ("qstart", "qend", "sstart", "send")), F.lit("0.0"), F.lit("100"))
    path = folder(t, "blast6")
    alignments(t).select(F.when(F.col("l_linenumber") == 7, F.concat(F.lit("broken "), text("l_orderkey"))).otherwise(fields).alias("value")).write.text(path)
    return R.read_blast6(t.spark, path).select(F.col("bad").isNotNull().alias("broken"), "query", "subject", "identity", "length", "qstart", "qend", "sstart", "send")


@query("a11_assignments", "SELECT kind, bin_id, CAST(contig_id AS VARCHAR) AS contig_id FROM brands CROSS JOIN (SELECT unnest(['concoct', 'metabinner', 'vamb']) AS kind)")
def a11(t: Tables) -> DataFrame:
    out = []
    for kind in ("concoct", "metabinner", "vamb"):
        path, m = folder(t, kind), t.brands()
        m = m.select("bin_id", "contig_id") if kind == "vamb" else m.select("contig_id", "bin_id")
        m.write.csv(path, sep="," if kind == "concoct" else "\t", header=kind == "concoct")
        out.append(R.read_assignments(t.spark, path, kind).withColumn("kind", F.lit(kind)))
    return reduce(DataFrame.unionByName, out)


@query("a12_repr_map", "SELECT l_orderkey, 'c' || l_linenumber AS key, CAST(max(l_partkey) AS DOUBLE) AS value FROM lineitem GROUP BY 1, 2")
def a12(t: Tables) -> DataFrame:
    one = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_partkey").alias("p"))
    pair = F.format_string("'c%s': %s", text("l_linenumber"), text("p"))
    cell = one.groupBy("l_orderkey").agg(F.concat(F.lit("{"), F.concat_ws(", ", F.collect_list(pair)), F.lit("}")).alias("cell"))  # seven lines an order at most
    return cell.select("l_orderkey", F.explode(R.repr_map("cell")))


@query("a13_compressed", SEQUENCES + "SELECT contig_id, CAST(length(seq) AS INTEGER) AS length, md5(seq) AS digest FROM seqs")
def a13(t: Tables) -> DataFrame:
    path = folder(t, "fasta-gz")
    sequences(t).select(F.concat(F.lit(">"), "contig_id", F.lit("\n"), "seq").alias("value")).write.text(path, compression="gzip")
    return R.read_fasta(t.spark, path).select("contig_id", "length", F.md5(F.col("seq").cast("binary")).alias("digest"))


@query("a14_bins", SEQUENCES + "SELECT 'bin_id=' || bin_id AS binset, contig_id, CAST(length(seq) AS INTEGER) AS length FROM seqs")
def a14(t: Tables) -> DataFrame:
    path = folder(t, "bins")
    B.write_fasta(sequences(t), path)
    return R.read_bins(t.spark, path, "*.txt").select("binset", "contig_id", "length")


@query("a15_datasets", "SELECT p_partkey, CAST(s AS INTEGER) AS sample, CAST(m AS INTEGER) AS mate, CASE s WHEN 0 THEN 'a' ELSE 'b' END || (m + 1) || '_' || p_partkey AS name FROM part CROSS JOIN (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(s, m)")
def a15(t: Tables) -> DataFrame:
    n = F.concat(F.lit("_"), text("p_partkey"))
    line = F.concat(F.lit("a1"), n, F.lit(",a2"), n, F.lit("/b1"), n, F.lit(",b2"), n, F.lit("/"))
    s = t.part.select("p_partkey", F.posexplode(R.datasets(line)).alias("sample", "mates"))
    return s.select("p_partkey", "sample", F.posexplode("mates").alias("mate", "name"))


@query("b01_bins", "SELECT bin_id, contig_id, length FROM mem_a")
def b01(t: Tables) -> DataFrame:
    path = folder(t, "bin-tables")
    B.write_bins(t.members("source"), path)
    return t.spark.read.parquet(path).select("bin_id", "contig_id", "length")


@query("b02_fastq_by_bin", SEQUENCES + "SELECT bin_id, CAST(length(seq) % 2 + 1 AS INTEGER) AS mate, 4 * count(*) AS lines FROM seqs GROUP BY 1, 2")
def b02(t: Tables) -> DataFrame:
    path = folder(t, "fastq")
    B.write_fastq(reads(t), path)
    return t.spark.read.text(path).groupBy("bin_id", F.col("mate").cast("int").alias("mate")).agg(F.count(F.lit(1)).alias("lines"))


@query("b03_tsv", "SELECT bin1, bin2, connections FROM bin_edges")
def b03(t: Tables) -> DataFrame:
    from contigra.operators.joins import bin_connections

    path = folder(t, "tsv")
    B.write_tsv(bin_connections(t.edges(), t.brands(), n=t.tasks), path)
    return t.spark.read.csv(path, sep="\t", header=True, schema="bin1 string, bin2 string, connections long")


@query("b04_stage", "SELECT node1, node2, connections, CAST(2 AS INTEGER) AS last FROM edges WHERE connections >= 2")
def b04(t: Tables) -> DataFrame:
    """Two stages of a manifest; the second run of each finds it done."""
    path = folder(t, "stages")
    m = B.StageManifest(t.spark, f"{path}/manifest")
    for _ in range(2):
        edges = m.run(1, "edges", t.edges, f"{path}/edges")
        strong = m.run(2, "strong", lambda e=edges: e.where("connections >= 2"), f"{path}/strong")
    return strong.withColumn("last", F.lit(m.last()))


@query("b05_metrics", "SELECT unnest(['rows', 'null_doc_id', 'null_text', 'null_lang', 'null_source', 'null_n_chars']) AS metric, unnest([count(*), count(*) - count(doc_id), count(*) - count(text), count(*) - count(lang), count(*) - count(source), count(*) - count(n_chars)]) AS value FROM documents")
def b05(t: Tables) -> DataFrame:
    """What a run counted while it wrote; one row a metric."""
    df, o = B.observed(t.documents, f"metrics-{uuid.uuid4().hex}")
    df.write.format("noop").mode("overwrite").save()
    return t.spark.createDataFrame(sorted(o.get.items()), "metric string, value long")


@query("b06_report", "SELECT bin_id, 'bin' || row_number() OVER (ORDER BY completeness - 5 * contamination DESC, bin_id) AS final_name FROM quality_p")
def b06(t: Tables) -> DataFrame:
    path = folder(t, "report")
    B.write_report(brand_quality(t), path)
    return t.spark.read.csv(path, sep="\t", header=True).select("bin_id", "final_name")


@query("b07_bundle", "SELECT 'connections' AS part, CAST(node1 AS VARCHAR) AS a, CAST(node2 AS VARCHAR) AS b, CAST(connections AS DOUBLE) AS value FROM edges UNION ALL SELECT 'contigs', bin_id, CAST(contig_id AS VARCHAR), CAST(length AS DOUBLE) FROM brands UNION ALL SELECT 'coverage', CAST(contig_id AS VARCHAR), CAST(sample_idx AS VARCHAR), depth FROM depth")
def b07(t: Tables) -> DataFrame:
    path = folder(t, "bundle")
    B.write_bundle(t.edges(), t.brands(), t.depth(), path)
    columns = {"connections": ("node1", "node2", "connections"), "contigs": ("bin_id", "contig_id", "length"), "coverage": ("contig_id", "sample_idx", "depth")}
    parts = [t.spark.read.parquet(f"{path}/{name}").select(F.lit(name).alias("part"), text(a).alias("a"), text(b).alias("b"), F.col(v).cast("double").alias("value")) for name, (a, b, v) in columns.items()]
    return reduce(DataFrame.union, parts)
