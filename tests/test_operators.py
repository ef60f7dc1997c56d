"""Operators on small fixtures with worked values."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from contigra.operators import aggregates as A
from contigra.operators import filters as C
from contigra.operators import graph as J
from contigra.operators import joins as D
from contigra.operators import ml as K
from contigra.operators import selection as G
from contigra.operators import sequences as Q
from contigra.operators import sets as H
from contigra.operators import windows as W
from contigra.plans import dereplicate as P


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


@pytest.fixture(scope="module")
def sets(spark):
    a = spark.createDataFrame([("a1", "c1", 600), ("a1", "c2", 400), ("a2", "c3", 500)], "bin_id string, contig_id string, length long")
    b = spark.createDataFrame([("b1", "c1", 600), ("b1", "c4", 200), ("b2", "c2", 400), ("b2", "c3", 500)], "bin_id string, contig_id string, length long")
    return a, b


def test_overlap_and_best_hits(sets):
    s = P.scored(*sets)
    assert rows(s) == [("a1", "b1", 60.0, 75.0), ("a1", "b2", 40.0, 44.44), ("a2", "b2", 100.0, 55.56)]
    assert rows(W.accepted(W.best_hits(s))) == [("a1", "b1", 60.0, 75.0), ("a2", "b2", 100.0, 55.56)]


def test_dereplicate(spark, sets):
    q = "bin_id string, completeness double, contamination double, genome_size long"
    qa = spark.createDataFrame([("a1", 90.0, 5.0, 10), ("a2", 80.0, 1.0, 5)], q)
    qb = spark.createDataFrame([("b1", 88.0, 1.0, 10), ("b2", 80.0, 1.0, 4)], q)
    assert rows(P.dereplicate(*sets, qa, qb)) == [("a", "a2"), ("b", "b1")]


def test_selectors(spark):
    s = "cpn1 double, ctn1 double, size1 long, n50_1 double, cpn2 double, ctn2 double, size2 long, n50_2 double"
    df = spark.createDataFrame([(90.0, 5.0, 1, 1.0, 88.0, 1.0, 1, 1.0), (95.0, 4.0, 1, 1.0, 80.0, 0.0, 1, 1.0), (80.0, 1.0, 3, 1.0, 80.0, 1.0, 2, 1.0), (80.0, 1.0, 3, 1.0, 80.0, 1.0, 3, 1.0)], s)
    assert [tuple(r) for r in df.select(G.within_assembly(), G.across_assemblies()).collect()] == [(2, 2), (1, 2), (1, 0), (2, 1)]


def test_gate(spark):
    df = spark.createDataFrame([(95.0, 12.0), (90.0, 12.0), (70.0, 11.9)], "completeness double, contamination double")
    assert [r[0] for r in df.select(C.gate()).collect()] == [False, True, False]


def test_quartiles_and_fence(spark):
    df = spark.createDataFrame([("b", float(x)) for x in (1, 2, 3, 4, 100)], "bin_id string, v double")
    assert rows(A.quartiles(df, ["bin_id"], "v")) == [("b", 2.0, 4.0)]
    assert rows(A.nth_quartiles(df, ["bin_id"], "v")) == [("b", 1.0, 3.0)]
    assert rows(A.fenced(df, ["bin_id"], "v").where("in_fence"), "v") == [(1.0,), (2.0,), (3.0,), (4.0,)]
    few = spark.createDataFrame([("b", 1.0)], "bin_id string, v double")
    assert rows(A.nth_quartiles(few, ["bin_id"], "v")) == [("b", None, None)]


def test_ranks_of_values_in_many_bands(spark):
    rng = np.random.default_rng(3)
    groups = {
        "wide": np.concatenate([rng.normal(0, 1, 301), 10.0 ** rng.uniform(-12, 12, 300), -(10.0 ** rng.uniform(-9, 9, 200))]),
        "ties": rng.integers(-2, 3, 400).astype(float),
        "zero": np.zeros(7),
        "one": np.array([5.0]),
        None: rng.uniform(1, 2, 50),
    }
    df = spark.createDataFrame([(g, float(v)) for g, x in groups.items() for v in rng.permutation(x)] + [("wide", None), ("none", None)], "bin_id string, v double")
    plain = {r[0]: r[1:] for r in A.quartiles(df, ["bin_id"], "v").collect()}
    assert set(plain) == set(groups)
    nth = {r[0]: r[1:] for r in A.nth_quartiles(df, ["bin_id"], "v").collect()}
    for g, x in groups.items():
        assert plain[g] == pytest.approx(tuple(np.quantile(x, [0.25, 0.75])), rel=1e-12)
        at = [int(len(x) * p) for p in (0.25, 0.75)]
        assert nth[g] == tuple(float(np.sort(x)[i - 1]) if i else None for i in at)
    end = spark.createDataFrame([("x", v) for v in (float("inf"), 1.0, float("-inf"), 3e-320)], "bin_id string, v double")
    assert rows(A.nth_quartiles(end, ["bin_id"], "v")) == [("x", float("-inf"), 1.0)]


def test_ranks_are_cut_before_the_shuffle(spark):
    near = spark.createDataFrame([("b", f"c{i}", i // 2) for i in range(60)] + [("s", f"c{i}", 1) for i in range(5)] + [(None, f"c{i}", i) for i in range(30)], "bin_id string, contig_id string, connections long")
    plan = W.top_neighbours(near)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    kept = [tuple(r) for r in W.top_neighbours(near).collect()]
    assert sorted(r[2] for r in kept if r[0] == "b") == sorted([i // 2 for i in range(60)])[-20:]
    assert sum(r[0] == "s" for r in kept) == 5 and sorted(r[2] for r in kept if r[0] is None) == list(range(11, 30))
    third = [tuple(r) for r in W.third_largest(near, "connections").collect()]
    assert sorted(r[2] for r in third if r[0] == "b") == [28, 28, 29, 29]
    assert sum(r[0] == "s" for r in third) == 5 and sorted(r[2] for r in third if r[0] is None) == [27, 28, 29]


def test_edges(spark):
    e = spark.createDataFrame([("n1", "n2", 2), ("n2", "n1", 3)], "node1 string, node2 string, connections long")
    assert rows(A.edge_sums(e)) == [("n1", "n2", 2), ("n2", "n1", 3)]
    assert rows(A.condensed_edges(e)) == [("n1", "n2", 5)]


def test_vote(spark):
    s = "bin1 string, bin2 string, depth1 double, depth2 double"
    df = spark.createDataFrame([("a", "b", 10.0, 11.0), ("a", "b", 20.0, 25.0), ("a", "c", 10.0, 11.0), ("a", "c", 20.0, 24.0)], s)
    assert rows(A.vote(df)) == [("a", "b", False), ("a", "c", True)]


def test_majority_flags_on_any_vote_of_five(spark):
    v = spark.createDataFrame([("x", m, int(m == 0)) for m in range(5)] + [("y", m, 0) for m in range(5)], "contig_id string, model int, vote int")
    assert rows(A.majority(v, ["contig_id"], 5)) == [("x", True), ("y", False)]


def test_long_read_support(spark):
    hits = spark.createDataFrame([("r", c) for c, n in (("c1", 14), ("c2", 14), ("c3", 13)) for _ in range(n)] + [("q", c) for c, n in (("c1", 14), ("c2", 13)) for _ in range(n)], "read_id string, contig_id string")
    assert rows(A.read_contigs(hits), "read_id", "contig_id") == [("r", "c1"), ("r", "c2")]


def test_filters(spark):
    c = spark.createDataFrame([("g", 1, 900), ("g", 2, 1000), ("g", 3, 600_000)], "assembly string, ordinal int, length long")
    assert rows(C.min_length(c), "new_id", "ordinal") == [("g-1", 2), ("g-2", 3)]
    assert rows(C.single_contig_bins(c), "number") == [(3,)]
    r = spark.createDataFrame([("r", "A" * 350), ("s", "A" * 150)], "read_id string, seq string")
    assert rows(C.fragments(r), "read_id", "mate") == [("r_1", 1), ("r_1", 2)]
    h = spark.createDataFrame([("a", "b", 99.5, 600, 1, 600, 1000, 401, 1000, 1000), ("a", "c", 99.5, 600, 5, 604, 1000, 1, 600, 1000)], "query string, subject string, identity double, length int, qstart int, qend int, qlen int, sstart int, send int, slen int")
    assert rows(C.overlap_hits(h), "subject") == [("b",)]
    b = spark.createDataFrame([("x_genomes.0.fa",), ("x_genomes.1.fa",), ("unbined",)], "bin_id string")
    assert rows(C.real_bins(b)) == [("x_genomes.1.fa",)]
    a = spark.createDataFrame([("x||y", "x||y", 99.0, 10), ("x||y", "x||y", 99.0, 10), ("x", "x", 100.0, 900), ("x", "z", 99.0, 499)], "query string, subject string, identity double, length int")
    assert rows(C.self_alignments(a)) == [("x||y", "x||y", 99.0, 10)]


def test_evidence_levels(spark):
    s = spark.createDataFrame([("b", "c1"), ("b", "c2"), ("only", "c9")], "bin_id string, contig_id string")
    n = spark.createDataFrame([("b", "c1"), ("b", "c3")], "bin_id string, contig_id string")
    assert rows(D.evidence_levels(s, n)) == [("b", "c1", 1), ("b", "c2", 2), ("b", "c3", 3), ("only", "c9", 1)]


def test_neighbours_and_reach(spark):
    m = spark.createDataFrame([("b", "c1"), ("b", "c2")], "bin_id string, contig_id string")
    e = spark.createDataFrame([("c1", "c2", 5), ("c1", "c3", 2), ("c4", "c3", 1), ("c2", "c3", 1)], "node1 string, node2 string, connections long")
    assert rows(D.neighbours(m, e)) == [("b", "c3", 3)]
    assert rows(J.reach(m, e, 3)) == [("b", "c1", 0), ("b", "c2", 0), ("b", "c3", 1), ("b", "c4", 2)]


def test_components_of_a_path(spark):
    n = 40
    order = np.random.default_rng(0).permutation(n)
    e = spark.createDataFrame([(int(order[i]), int(order[i + 1])) for i in range(n - 1)] + [(100, 101)], "a long, b long")
    found = rows(J.connected_components(e))
    assert {c for _, c in found} == {0, 100} and len(found) == n + 2


def test_components_of_a_long_random_path(spark):
    n = 10_000
    order = np.random.default_rng(1).permutation(n)
    e = spark.createDataFrame(list(zip(order[:-1].tolist(), order[1:].tolist(), strict=True)), "a long, b long")
    began = time.time()
    got = J.connected_components(e)
    assert got.count() == n and got.agg(F.max("component")).first()[0] == 0
    assert time.time() - began < 60


def test_thirty_rounds_of_cuts_keep_estimates_small(spark):
    df = spark.range(50).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    more = spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    got = J.fixpoint(df, lambda d: d.join(more, "k").select("k", F.least(F.col("v") + F.col("w"), F.lit(30)).alias("v")), lambda d: d.agg(F.sum("v")).first()[0])
    assert got.agg(F.min("v"), F.max("v"), F.count("k")).first() == (30, 30, 50)
    assert got._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 40
    folded = J.fold_sets([df.limit(1)] + [more.select("k", F.col("w").alias("v"))] * 30, lambda a, b: a.union(b.join(a.select("k"), "k", "left_anti")))
    assert folded.count() == 50
    with pytest.raises(RuntimeError):
        J.fixpoint(df, lambda d: d.withColumn("v", F.col("v") + 1), lambda d: d.agg(F.sum("v")).first()[0], 3)


def test_long_elongation(spark):
    n = 3000
    o = spark.createDataFrame([(i, i + 1, 5) for i in range(n)], "query long, subject long, length int")
    got = J.elongate(spark.createDataFrame([(0,), (n - 5,)], "contig_id long"), o)
    assert got.groupBy("target").agg(F.max("step")).sort("target").collect() == [(0, n), (n - 5, 5)]


def test_ranked(spark):
    near = spark.createDataFrame([("b", f"c{i}", i if i > 3 else 3) for i in range(25)] + [("s", "c", 1)], "bin_id string, contig_id string, connections long")
    kept = W.top_neighbours(near)
    assert kept.where("bin_id = 's'").count() == 1 and kept.where("bin_id = 'b'").count() == 19
    r = spark.createDataFrame([("g", 1, 60.0), ("g", 2, 55.0), ("g", 3, 70.0), ("g", 4, 40.0)], "k string, o int, v double")
    assert rows(W.running_records(r, "k", "v", "o"), "o") == [(1,), (3,)]
    assert rows(W.best_by(r, ["k"], "v", "o"), "o") == [(3,)]
    assert W.has_rows(r, 4) and not W.has_rows(r, 5)


def test_fold_lets_a_later_win_count(spark):
    p = spark.createDataFrame([(1, "x", "y", 1), (2, "y", "z", 1), (3, "z", "w", 0)], "ordinal int, bin1 string, bin2 string, winner int")
    assert rows(G.fold(p)) == [("x", True), ("y", True), ("z", False)]
    assert rows(G.survivors(p.select(F.col("bin1").alias("bin_id")), p)) == [("x",)]


def test_refined(spark):
    s = "bin_id string, cpn double, ctn double, cpn0 double, ctn0 double"
    df = spark.createDataFrame([("a", 90.0, 1.0, 85.0, 1.0), ("b", 95.0, 6.0, 85.0, 1.0), ("c", 86.0, 20.0, 85.0, 1.0), ("d", 80.0, 1.0, 85.0, 1.0)], s)
    assert rows(G.refined(df), "bin_id", "verdict") == [("a", "accept"), ("b", "deep"), ("c", "deep"), ("d", "keep")]
    assert rows(G.contig_status(df), "bin_id", "status") == [("a", "Positive")]
    assert rows(G.polished(df).where("accepted"), "bin_id") == [("a",), ("d",)]


def test_variant_choices(spark):
    v = spark.createDataFrame([("b", "x.1", 80.0, 1.0, "2", 5.0, "SPAdes"), ("b", "x.1.2", 80.0, 1.0, "1", 4.0, "IDBA")], "bin_id string, variant string, completeness double, contamination double, threshold string, n50 double, assembler string")
    assert rows(G.best_variant(v), "variant") == [("x.1.2",)]
    assert rows(G.reassembly_choice(v), "assembler") == [("SPAdes",)]
    assert rows(G.hybrid_choice(v), "assembler") == [("SPAdes",)]
    d = spark.createDataFrame([("b", 1, 80.0, 1.0), ("b", 2, 80.0, 1.0)], "bin_id string, number int, completeness double, contamination double")
    assert rows(G.deep_choice(d), "number") == [(1,)]


def test_sets(spark):
    m = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("b", 1), ("b", 1), ("c", 1)], "k string, v int")
    assert rows(H.distinct_sets(m, "k", ["v"])) == [("a",), ("c",)]
    p = spark.createDataFrame([("x", "y"), ("y", "x")], "a string, b string")
    assert rows(H.unordered(p, "a", "b")) == [("x", "y")]


def test_merge(spark):
    c = spark.createDataFrame([("q", "AAAACCCC"), ("s", "CCCCGGGA"), ("r", "TCCCGGGG")], "contig_id string, seq string")
    h = spark.createDataFrame([("q", "s", 5, 8, 1, 4), ("q", "r", 5, 8, 8, 5)], "query string, subject string, qstart int, qend int, sstart int, send int")
    assert rows(Q.merge_overlaps(h, c), "contig_id", "seq") == [("q--r", "AAAACCCCGGGA"), ("q--s", "AAAACCCCGGGA")]
    b = spark.createDataFrame([("x", "y", "AAAA", "TTTT", "+", "-", "AAAAGGCCCC", 4, 7), ("x", "z", "AAAA", "AATT", "+", "+", "AAAATT", 4, 3)], "contig1 string, contig2 string, seq1 string, seq2 string, strand1 string, strand2 string, read string, read_end1 int, read_start2 int")
    assert rows(Q.bridge(b)) == [("x--y", "AAAAGGAAAA"), ("x--z", "AAAATT")]


def test_first_component(spark):
    x = np.random.default_rng(3).normal(size=(200, 5)) * [3, 1, 1, 1, 0.5]
    df = spark.createDataFrame([("b" if i % 2 else "a", i, [float(v) for v in r]) for i, r in enumerate(x)], "bin_id string, contig_id long, vector array<double>").repartition(4)
    got = {r["contig_id"]: r["pc1"] for r in K.first_component(df).collect()}
    for rest in (0, 1):
        own = x[rest::2]
        mean = own.mean(0)
        axis = np.linalg.svd(own - mean)[2][0]
        axis = axis * np.sign(axis[np.abs(axis).argmax()])
        assert np.allclose([got[i] for i in range(rest, 200, 2)], (own - mean) @ axis)


def test_network_is_residual():
    n = K.Network(3, hidden=4, seed=1)
    for k in ("m1.2", "m2.2"):
        n.w[k] = np.zeros_like(n.w[k])
    x = np.ones((2, 3))
    e = x @ n.w["embed"]
    assert np.allclose(n.logits(x), 4 * e @ n.w["cls"])


def test_kmer_join(spark):
    q = spark.createDataFrame([(1, "ACGTACGTTTGGCCAATT")], "id long, seq string")
    s = spark.createDataFrame([(7, "NNNACGTACGTTTGGCCAATTNN"), (8, "TTTTTTTTTTTT"), (9, None)], "id long, seq string")
    assert rows(D.kmer_hits(q, s, 8, 5)) == [(1, 7, 11)]
    assert rows(D.contained(q, s, 8)) == [(1, 7)]


def test_elongation_and_paths(spark):
    o = spark.createDataFrame([("a", "b", 5), ("a", "c", 9), ("c", "d", 2), ("d", "a", 1)], "query string, subject string, length int")
    assert rows(J.elongate(spark.createDataFrame([("a",)], "contig_id string"), o)) == [("a", "a", 0), ("a", "c", 1), ("a", "d", 2)]
    h = spark.createDataFrame([("r1", "x", "s"), ("r2", "x", "s"), ("r1", "y", "e")], "read_id string, contig_id string, end string")
    assert rows(J.single_paths(h), "read_id", "contig_id") == [("r1", "y")]
    m = spark.createDataFrame([("r", "b", 50, "+", 9.0), ("r", "a", 100, "-", 9.0), ("r", "a", 3, "+", 1.0), ("q", "a", 1, "+", 1.0)], "read_id string, contig_id string, start int, strand string, score double")
    assert [x["contig_id"] for x in J.roadmap(m).first()["contigs"]] == ["b", "a"]
