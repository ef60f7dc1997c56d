"""I-*: scalar functions against worked values."""

import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contigra.functions import scalar as S

BUCKETS = [(0, "0000", "0000"), (3.2, "0004", "0004"), (9, "0009", "0009"), (9.5, "0010", "0010"), (10, "0010", "0011"), (13, "0014", "0014"), (49, "0050", "0050"), (97, "00100", "0098"), (299, "0300", "0300"), (995.5, "01000", "01000"), (1001, "1050", "1010"), (4999, "5000", "5000"), (5000, "10000", "10000"), (-1, "10000", "10000")]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_buckets(spark):
    df = spark.createDataFrame([(float(x),) for x, _, _ in BUCKETS], "x double")
    assert [(r[0], r[1]) for r in df.select(S.covrange("x"), S.dcovrange("x")).collect()] == [(a, b) for _, a, b in BUCKETS]


def test_intervalue(spark):
    assert [one(spark, S.intervalue(10, 20, 2, F.lit(x))) for x in (10, 13, 20, 5, 23)] == [10, 14, 20, 10, None]


def test_gc_and_complement(spark):
    assert one(spark, S.gc_percent(F.lit("GGCAtc"))) == 50.0
    assert one(spark, S.reverse_complement(F.lit("AACGTTN"))) == "NAACGTT"
    assert one(spark, S.slice_1(F.lit("ABCDE"), 2, 4)) == "BCD"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("ACGTacgtN", max_size=40), min_size=1, max_size=8))
def test_reverse_complement_is_an_involution(spark, seqs):
    df = spark.createDataFrame([(s,) for s in seqs], "s string")
    assert [r[0] for r in df.select(S.reverse_complement(S.reverse_complement("s"))).collect()] == seqs


def test_kmers(spark):
    v = one(spark, S.kmer_vector(F.lit("AACGTT"), 4, 1))
    got = {k: x for k, x in zip(S.all_kmers(), v, strict=True) if x}
    assert got == {"AACG": pytest.approx(1 / 3, abs=1e-7), "CGTT": pytest.approx(1 / 3, abs=1e-7), "ACGT": pytest.approx(1 / 3, abs=1e-7)}
    assert S.all_kmers()[:5] == ["AAAA", "AAAT", "AAAC", "AAAG", "AATA"]
    assert one(spark, S.kmer_vector(F.lit("AACGTT"), 4)) is None
    assert one(spark, S.kmer_vector(F.lit("NNNN"), 4, 1)) is None
    assert math.isclose(sum(one(spark, S.kmer_vector(F.lit("ACGTTGCANGGTACCA" * 5), 4, 1))), 1, abs_tol=1e-5)


def test_kmers_of_a_long_sequence(spark):
    seq = "".join(np.random.default_rng(5).choice(list("ACGTN"), 300_000, p=[0.3, 0.2, 0.2, 0.29, 0.01]))
    seen = Counter(seq[i : i + 4] for i in range(len(seq) - 3) if "N" not in seq[i : i + 4])
    both = seen + Counter({x.translate(str.maketrans("ACGT", "TGCA"))[::-1]: n for x, n in seen.items()})
    got = spark.createDataFrame([(seq,)], "s string").select(S.kmer_vector("s")).first()[0]
    assert got == pytest.approx([both[x] / both.total() for x in S.all_kmers()], abs=1e-8)
    assert one(spark, S.kmer_vector(F.lit(None).cast("string"))) is None
    assert one(spark, S.kmer_counts(F.lit("AACGN"), 4)) == ["AACG", "CGTT"]


def test_windows(spark):
    assert one(spark, S.windows(F.lit("ABCDEFGHIJ"), 3)) == ["ABC", "DEF", "GHIJ"]
    assert one(spark, S.windows(F.lit("AB"), 3)) == ["AB"]


def test_differences(spark):
    assert one(spark, S.pct_sum(F.lit(10), F.lit(11))) == pytest.approx(4.76, abs=0.01)
    assert one(spark, S.pct_sum(F.lit(0), F.lit(0))) == 0
    assert one(spark, S.pct_avg(F.lit(10), F.lit(30))) == 100
    assert one(spark, S.pct_ref(F.lit(13), F.lit(10))) == 30
    assert one(spark, S.pct_ref(F.lit(1), F.lit(0))) is None


def test_text(spark):
    assert one(spark, S.strip_extension(F.lit("a.b.fa"))) == "a.b"
    assert one(spark, S.count_of(F.lit("a.b.c"), ".")) == 2
    assert one(spark, S.prefix_id(F.lit("bin7_3"))) == "bin7"
    assert one(spark, S.number(F.lit("12.5"))) == 12.5 and one(spark, S.number(F.lit("x"))) is None
    assert one(spark, S.round_even(F.lit(0.125), 2)) == 0.12
    assert [one(spark, S.lineage_weight(F.lit(x))) for x in ("s__x", "k__y", "what")] == [11.4, 1.0, 0.0]


def test_vector_stats(spark):
    x = np.array([1.0, -2.0, 3.0, 4.5])
    m, s, n = x.mean(), x.std(), len(x)
    got = one(spark, S.vector_stats(F.array(*[F.lit(float(v)) for v in x])))
    assert got[:6] == pytest.approx([m, x.var(), s, 4.5, -2.0, 4.5])
    assert got[13] == pytest.approx(((x - m) ** 3).sum() / ((n - 1) * s**3 + 1e-7))
    assert got[14] == pytest.approx(((x - m) ** 4).sum() / ((n - 1) * s**4 + 1e-7))
