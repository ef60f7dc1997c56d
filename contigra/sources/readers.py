"""A-1 to A-15: file formats as DataFrames with fixed schemas.

Layouts are told by their header, never by a failed parse.  Files are read by Spark alone, so
any store that Spark opens will do.
"""

from __future__ import annotations

import io
import tarfile
import zipfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLAST = "query string, subject string, identity double, length int, mismatches int, gaps int, qstart int, qend int, sstart int, send int, evalue double, bitscore double"


def _file() -> Column:
    return F.element_at(F.split(F.input_file_name(), "/"), -1)


def _records(df: DataFrame) -> DataFrame:
    """Records between line ends followed by ``>``; the first of a file still has its own ``>``."""
    return df.withColumn("value", F.regexp_replace("value", "^>", "")).where(F.col("value").rlike(r"\S"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """A-1: contig_id (first word after ``>``), seq, length, file.  Only a ``>`` that begins a line begins a record."""
    raw = _records(spark.read.text(path, lineSep="\n>").select(_file().alias("file"), "value"))
    seq = F.regexp_replace(F.regexp_replace("value", r"^[^\n]*", ""), r"\s", "")
    return raw.select(F.regexp_extract("value", r"^(\S+)", 1).alias("contig_id"), seq.alias("seq"), F.length(seq).alias("length"), "file")


def read_fastq(spark: SparkSession, path: str, mate: int = 1) -> DataFrame:
    """A-2: read_id, seq, qual, ordinal, file, mate, whole: four lines a record, per file; ``whole`` is false for a broken last record.

    Files are read in splits like any text.  Lines are numbered within their split and moved on by the lines of the file's
    splits before it, which gives each line its place in its record.
    """
    raw = spark.read.text(path).select(_file().alias("file"), F.col("_metadata.file_path").alias("path_"), F.col("_metadata.file_block_start").alias("block_"), "value")
    lines = raw.withColumn("at_", F.monotonically_increasing_id())  # counts up through a split
    splits = lines.groupBy("path_", "block_").agg(F.min("at_").alias("first_"), F.count(F.lit(1)).alias("n_"))
    before = F.sum("n_").over(Window.partitionBy("path_").orderBy("block_").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("path_", "block_", "first_", F.coalesce(before, F.lit(0)).alias("before_"))
    line = F.col("at_") - F.col("first_") + F.col("before_")
    placed = lines.join(F.broadcast(splits), ["path_", "block_"]).withColumns({"ordinal": F.floor(line / 4), "part_": line % 4})  # one row a split
    part = lambda i: F.max(F.when(F.col("part_") == i, F.col("value")))
    records = placed.groupBy("path_", "ordinal").agg(F.first("file").alias("file"), part(0).alias("head_"), part(1).alias("seq"), part(3).alias("qual"), F.count(F.lit(1)).alias("n_"))
    return records.select("file", F.regexp_extract("head_", r"^.(\S*)", 1).alias("read_id"), "seq", "qual", "ordinal", F.lit(mate).alias("mate"), (F.col("n_") == 4).alias("whole"))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """A-3: alignments of 12 fields and more, without headers."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("@")).where(F.size(f) >= 12)
    return rows.select(f[0].alias("qname"), f[1].cast("int").alias("flag"), f[2].alias("rname"), f[3].cast("int").alias("pos"), f[4].cast("int").alias("mapq"), f[5].alias("cigar"), f[9].alias("seq"), f[10].alias("qual"))


def _unpivot(wide: DataFrame, id_: str, length: str, samples: list[str], value: str = "depth") -> DataFrame:
    array = F.array(*[F.struct(F.lit(i + 1).alias("sample_idx"), F.col(f"`{c}`").cast("double").alias(value)) for i, c in enumerate(samples)])
    return wide.select(F.col(f"`{id_}`").alias("contig_id"), F.col(f"`{length}`").cast("double").cast("long").alias("length"), F.explode(array).alias("s")).select("contig_id", "length", "s.*")


def read_depth(spark: SparkSession, path: str) -> DataFrame:
    """A-4: contig_id, length, sample_idx (from 1), depth; variance columns are left out."""
    wide = spark.read.csv(path, sep="\t", header=True)
    return _unpivot(wide, wide.columns[0], wide.columns[1], [c for c in wide.columns[3:] if not c.endswith("-var")])


def read_coverage_matrix(spark: SparkSession, path: str) -> DataFrame:
    """A-5: contig_id, length, sample_idx, depth from columns 3i+1."""
    wide = spark.read.csv(path, sep="\t", header=True)
    return _unpivot(wide, wide.columns[0], wide.columns[1], wide.columns[4::3])


def read_quality(spark: SparkSession, path: str) -> DataFrame:
    """A-6: bin_id, genome_size, completeness, contamination, n50 of either layout, told by its header."""
    wide = spark.read.csv(path, sep="\t", header=True)
    c = [f"`{x}`" for x in wide.columns]
    own = any(x.lower() in ("bin_id", "binid") for x in wide.columns[:1]) or len(c) < 9
    at = (0, 1, 2, 3, 4) if own else (0, 8, 1, 2, 6)
    names = ("bin_id", "genome_size", "completeness", "contamination", "n50")
    kinds = ("string", "long", "double", "double", "double")
    return wide.select(*[F.col(c[i]).try_cast("double").cast(k).alias(n) if k == "long" else F.col(c[i]).try_cast(k).alias(n) for i, n, k in zip(at, names, kinds, strict=True)])


def read_checkm1(spark: SparkSession, path: str) -> DataFrame:
    """A-7: bin_id, lineage, completeness, genome_size, contamination, mean_scaffold_length; failures are root and 0."""
    v = F.col("value")

    def num(key: str) -> Column:
        return F.coalesce(F.regexp_extract(v, rf"'{key}': ([0-9.eE+-]+)", 1).try_cast("double"), F.lit(0.0))

    lineage = F.regexp_extract(v, r"'marker lineage': '([^']*)'", 1)
    return spark.read.text(path).select(F.substring_index(v, "\t", 1).alias("bin_id"), F.when(lineage == "", "root").otherwise(lineage).alias("lineage"), num("Completeness").alias("completeness"), num("Genome size").alias("genome_size"), num("Contamination").alias("contamination"), num("Mean scaffold length").alias("mean_scaffold_length"))


def read_kmers(spark: SparkSession, path: str) -> DataFrame:
    """A-8: contig_id, kmers."""
    wide = spark.read.csv(path, sep="\t", header=True)
    return wide.select(F.col(f"`{wide.columns[0]}`").alias("contig_id"), F.array(*[F.col(f"`{c}`").cast("double") for c in wide.columns[1:]]).alias("kmers"))


def read_connections(spark: SparkSession, path: str) -> DataFrame:
    """A-9: node1, interaction, node2, connections."""
    return spark.read.csv(path, sep="\t", header=True, schema="node1 string, interaction int, node2 string, connections long")


def read_blast6(spark: SparkSession, path: str) -> DataFrame:
    """A-10: twelve named columns; a malformed line is kept with identity 1, length 1, starts 1 and ends 0, and its text in ``bad``."""
    f = F.split("value", "\t")
    kinds = [c.strip().split(" ") for c in BLAST.split(",")]
    df = spark.read.text(path).select(*[F.get(f, F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(kinds)], F.when(F.size(f) != len(kinds), F.col("value")).alias("bad"))
    return df.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in (("identity", 1.0), ("length", 1), ("qstart", 1), ("qend", 0), ("sstart", 1), ("send", 0))})


def read_assignments(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A-11: bin_id, contig_id of concoct (csv), metabinner (tsv) or vamb (tsv, cluster first)."""
    header = kind == "concoct"
    df = spark.read.csv(path, sep="," if kind == "concoct" else "\t", header=header).toDF("a", "b")
    return df.select("b", "a").toDF("bin_id", "contig_id") if kind != "vamb" else df.toDF("bin_id", "contig_id")


def repr_map(column: str | Column) -> Column:
    """A-12: text of a mapping such as ``{'c1': 14, 'c2': 3}`` as a map of doubles."""
    body = F.regexp_replace(F.col(column) if isinstance(column, str) else column, r"[{}'\"\s]", "")
    return F.when(body != "", F.transform_values(F.str_to_map(body, F.lit(","), F.lit(":")), lambda _, v: v.try_cast("double"))).otherwise(F.create_map().cast("map<string,double>"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """A-13: name, content of each member of .zip and .tar.gz files; .gz text is read by the other readers as it is."""

    def inside(name: str, content: bytes) -> Iterator[tuple[str, bytes]]:
        if name.endswith(".zip"):
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                yield from ((i.filename, z.read(i)) for i in z.infolist() if not i.is_dir())
        else:
            with tarfile.open(fileobj=io.BytesIO(content)) as t:
                yield from ((m.name, t.extractfile(m).read()) for m in t if m.isfile())

    def members(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                for member in inside(name, content):  # one unpacked member at a time
                    yield pd.DataFrame([member], columns=["name", "content"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(members, "name string, content binary")


def read_bins(spark: SparkSession, folder: str, pattern: str = "*.fa*") -> DataFrame:
    """A-14: binset (folder), bin_id (file), contig_id, length: all bins below a folder, in no order."""
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(folder, lineSep="\n>")
    parts = F.split(F.input_file_name(), "/")
    raw = _records(raw.select(F.element_at(parts, -2).alias("binset"), F.element_at(parts, -1).alias("bin_id"), "value"))
    seq = F.regexp_replace(F.regexp_replace("value", r"^[^\n]*", ""), r"\s", "")
    return raw.select("binset", "bin_id", F.regexp_extract("value", r"^(\S+)", 1).alias("contig_id"), F.length(seq).alias("length"))


def parse_datasets(text: str) -> list[list[str]]:
    """A-15: ``a1,a2/b1,b2``: samples apart by ``/``, mates by ``,``."""
    return [[m for m in s.split(",") if m] for s in text.split("/") if s]


def datasets(column: str | Column) -> Column:
    """A-15 of a text column: samples, each an array of its mates."""
    parts = lambda c, sep: F.filter(F.split(c, sep), lambda x: x != "")
    return F.transform(parts(column, "/"), lambda s: parts(s, ","))


MEMBERS = T.StructType([T.StructField(n, T.StringType()) for n in ("binset", "bin_id", "contig_id")])
