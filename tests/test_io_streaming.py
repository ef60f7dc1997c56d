"""Sources, sinks, streaming, and the oracle on the smallest tables."""

import io
import zipfile

import duckdb
import pytest
from pyspark.sql import functions as F

from contigra.sources import readers as R
from contigra.sources import writers as B
from contigra.streaming import edges as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_fasta_and_bins(spark, tmp_path):
    (tmp_path / "set").mkdir()
    (tmp_path / "set" / "bin1.fa").write_text(">c1 some text\nACG\nT\n>c2\nGG\n")
    assert [tuple(r) for r in R.read_fasta(spark, str(tmp_path / "set")).orderBy("contig_id").collect()] == [("c1", "ACGT", 4, "bin1.fa"), ("c2", "GG", 2, "bin1.fa")]
    assert R.read_bins(spark, str(tmp_path)).select("binset", "bin_id", "length").orderBy("length").first()[:] == ("set", "bin1.fa", 2)
    B.write_fasta(R.read_fasta(spark, str(tmp_path / "set")).withColumn("bin_id", F.lit("b")), str(tmp_path / "out"))
    assert R.read_fasta(spark, str(tmp_path / "out" / "bin_id=b")).count() == 2


def test_fastq_sam(spark, tmp_path):
    (tmp_path / "r.fq").write_text("@a 1\nACGT\n+\nIIII\n@b\nGG\n+\nII\n")
    assert [tuple(r) for r in R.read_fastq(spark, str(tmp_path / "r.fq")).select("read_id", "seq", "qual", "ordinal").collect()] == [("a", "ACGT", "IIII", 0), ("b", "GG", "II", 1)]
    (tmp_path / "x.sam").write_text("@HD\n" + "\t".join(["q", "99", "c", "5", "60", "4M", "=", "9", "4", "ACGT", "IIII", "NM:i:0"]) + "\nshort\tline\n")
    assert R.read_sam(spark, str(tmp_path / "x.sam")).select("qname", "flag", "pos").first()[:] == ("q", 99, 5)


def test_depth_quality_blast(spark, tmp_path):
    (tmp_path / "d.txt").write_text("contigName\tcontigLen\ttotalAvgDepth\ts1.bam\ts1.bam-var\ts2.bam\ts2.bam-var\nc\t10\t3\t1\t9\t2\t9\n")
    assert [tuple(r) for r in R.read_depth(spark, str(tmp_path / "d.txt")).collect()] == [("c", 10, 1, 1.0), ("c", 10, 2, 2.0)]
    (tmp_path / "raw.tsv").write_text("Name\tCompleteness\tContamination\tModel\tx\ty\tN50\tz\tGenome_Size\nb\t90.5\t1.5\tm\t0\t0\t77\t0\t1000\n")
    (tmp_path / "own.tsv").write_text("Bin_ID\tGenome_size\tCompleteness\tContamination\tN50\nb\t1000\t90.5\t1.5\t77\n")
    (tmp_path / "typo.tsv").write_text("Bin_ID\tGenome_size\tCompletenes\tContamination\tN50\nb\t1000\t90.5\t1.5\t77\n")
    for name in ("raw", "own", "typo"):
        assert R.read_quality(spark, str(tmp_path / f"{name}.tsv")).first()[:] == ("b", 1000, 90.5, 1.5, 77.0)
    (tmp_path / "c1.tsv").write_text("b\t{'marker lineage': 'g__X', 'Completeness': 90.5, 'Genome size': 1000, 'Contamination': 1.5, 'Mean scaffold length': 50.0}\nc\t{}\n")
    assert [tuple(r) for r in R.read_checkm1(spark, str(tmp_path / "c1.tsv")).collect()] == [("b", "g__X", 90.5, 1000.0, 1.5, 50.0), ("c", "root", 0.0, 0.0, 0.0, 0.0)]
    (tmp_path / "b6").write_text("q\ts\t99.5\t600\t0\t0\t1\t600\t1\t600\t0.0\t1000\nbroken line\n")
    assert R.read_blast6(spark, str(tmp_path / "b6")).count() == 2


def test_small_formats(spark, tmp_path):
    (tmp_path / "c.csv").write_text("contig,cluster\nk1,3\n")
    (tmp_path / "v.tsv").write_text("7\tk1\n")
    assert R.read_assignments(spark, str(tmp_path / "c.csv"), "concoct").first()[:] == ("3", "k1")
    assert R.read_assignments(spark, str(tmp_path / "v.tsv"), "vamb").first()[:] == ("7", "k1")
    df = spark.createDataFrame([("{'c1': 14, 'c2': 3}",), ("{}",)], "x string")
    assert [r[0] for r in df.select(R.repr_map("x")).collect()] == [{"c1": 14.0, "c2": 3.0}, {}]
    assert R.parse_datasets("a1,a2/b1,b2") == [["a1", "a2"], ["b1", "b2"]]
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("in/x.fa", ">c\nA\n")
    (tmp_path / "a.zip").write_bytes(buffer.getvalue())
    assert R.read_archive(spark, str(tmp_path / "a.zip")).first()["name"] == "in/x.fa"


def test_manifest_runs_a_stage_once(spark, tmp_path):
    m, made = B.StageManifest(spark, str(tmp_path / "manifest")), []

    def make():
        made.append(1)
        return spark.range(3)

    for _ in range(2):
        assert m.run(1, "one", make, str(tmp_path / "one")).count() == 3
    assert len(made) == 1 and m.last() == 1


def test_observed(spark):
    df, o = B.observed(spark.createDataFrame([(1, None), (2, "x")], "a int, b string"), "m")
    df.collect()
    assert o.get == {"rows": 2, "null_a": 0, "null_b": 1}


def test_stream_matches_batch(spark, tmp_path):
    pairs = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "c")], "node1 string, node2 string")
    pairs.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(pairs.schema).parquet(str(tmp_path / "in"))
    q = E.edge_counts(stream).writeStream.outputMode("complete").format("memory").queryName("edge_counts").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("edge_counts").collect())) == sorted(map(tuple, E.edge_counts(pairs).collect()))
    ev = spark.read.parquet(f"{SF}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    ev.write.parquet(str(tmp_path / "ev"))
    s = spark.readStream.schema(ev.schema).parquet(str(tmp_path / "ev"))
    E.run_available(E.windowed_counts(s, "ts", "event_type", "1 day"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0


def _rows(values):
    return sorted(tuple("N" if v is None else f"{v:.6g}" if isinstance(v, float) else str(v) for v in r) for r in values)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def _names():
    from contigra import format_queries, hit_queries, more_queries, sequence_queries  # noqa: F401  (they add to the queries)
    from contigra.queries import SQL

    return sorted(SQL)


@pytest.mark.parametrize("name", _names())
def test_oracle(spark, duck, name):
    from contigra import queries

    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = duck.sql(queries.SQL[name])
    assert sorted(want.columns) == columns
    assert _rows(got.select(*columns).collect()) == _rows(want.select(*columns).fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_fasta_headers_may_hold_the_mark(spark, tmp_path):
    for i, body in enumerate([">a x>y >z\nAC\nGT\n>b\n\n>c >\r\nTT\r\n", ">only\nACGT", "\n"]):
        (tmp_path / f"s{i}.fa").write_text(body)
    got = sorted(tuple(r) for r in R.read_fasta(spark, str(tmp_path)).select("contig_id", "seq", "file").collect())
    assert got == [("a", "ACGT", "s0.fa"), ("b", "", "s0.fa"), ("c", "TT", "s0.fa"), ("only", "ACGT", "s1.fa")]
    bins = sorted(tuple(r) for r in R.read_bins(spark, str(tmp_path)).select("bin_id", "contig_id", "length").collect())
    assert bins == [("s0.fa", "a", 4), ("s0.fa", "b", 0), ("s0.fa", "c", 2), ("s1.fa", "only", 4)]


def test_mates_meet_across_restarts(spark, tmp_path):
    """Mates that arrive in different runs meet; the runs together give what the batch query gives, each pair once."""
    from pyspark.sql import functions as F

    from contigra.streaming import edges as L

    schema = "read_id string, mate int, contig_id string, ts timestamp"
    at = lambda m: f"2024-01-01 {m // 60:02}:{m % 60:02}:00"
    runs = [
        [("r1", 1, "c1", 0), ("r2", 1, "c2", 3), ("r2", 2, "c3", 4), ("r5", 2, "c9", 1), (None, 1, "c1", 2)],
        [("r1", 2, "c4", 20), ("r3", 2, "c5", 22), (None, 2, "c1", 21)],
        [("r3", 1, "c6", 40), ("r4", 1, "c7", 45), ("r5", 1, "c8", 200)],
        [("r4", 2, "c8", 300), ("r6", 1, "a", 301), ("r6", 2, "b", 301)],
    ]
    folder, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for rows in runs:
        spark.createDataFrame([(r, m, c, at(t)) for r, m, c, t in rows], "read_id string, mate int, contig_id string, ts string").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(folder)
        L.run_available(L.mate_pairs(spark.readStream.schema(schema).parquet(folder), "ts", "1 hour"), out, state)
    got = sorted(tuple(r)[:3] for r in spark.read.parquet(out).collect())
    want = sorted(tuple(r)[:3] for r in L.mate_pairs(spark.read.parquet(folder), "ts", "1 hour").collect())
    assert got == want == [("r1", "c1", "c4"), ("r2", "c2", "c3"), ("r3", "c6", "c5"), ("r6", "a", "b")]
    L.run_available(L.mate_pairs(spark.readStream.schema(schema).parquet(folder), "ts", "1 hour"), out, state)
    assert spark.read.parquet(out).count() == len(want)


def test_archives_give_their_members(spark, tmp_path):
    import io
    import tarfile
    import zipfile

    files = {"x/a.fa": b">a\nAC\n", "b.fa": b"", "c.bin": bytes(range(256)) * 4000}
    with zipfile.ZipFile(tmp_path / "one.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in files.items():
            z.writestr(name, body)
    with tarfile.open(tmp_path / "two.tar.gz", "w:gz") as t:
        for name, body in files.items():
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    for one in ("one.zip", "two.tar.gz"):
        assert {r["name"]: bytes(r["content"]) for r in R.read_archive(spark, str(tmp_path / one)).collect()} == files
