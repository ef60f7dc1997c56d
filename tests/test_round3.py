"""What the reviews of round 3 found, on small tables."""

import random

import pytest

import __spark_entry__
from contigra.operators import graph as J
from contigra.operators import joins as D
from contigra.operators import ml as K
from contigra.operators import sequences as Q
from contigra.operators import similarity as M
from contigra.queries import Tables


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_overlap_of_one_base_turned_over(spark):
    c = spark.createDataFrame([("q", "AC"), ("s", "TG"), ("r", "CT")], "contig_id string, seq string")
    h = spark.createDataFrame([("q", "s", 2, 2, 2, 2, "-"), ("q", "r", 2, 2, 1, 1, "+"), ("q", "r", 2, 2, 1, 1, None)], "query string, subject string, qstart int, qend int, sstart int, send int, strand string")
    assert rows(Q.merge_overlaps(h, c), "contig_id", "seq") == [("q--r", "ACT"), ("q--r", "ACT"), ("q--s", "ACA")]


def test_short_texts_merge_again(spark, tmp_path):
    docs = [(i, "GATTACA"[:n]) for i, n in enumerate([3, 3, 4, 5, 5, 6, 7, 7, 2, 1])]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = rows(__spark_entry__.queries()["i06_merged_overlaps"](spark, str(tmp_path)), "contig_id")
    assert got == sorted((f"q{i}--s{i}",) for i, text in docs if len(text) >= 3)


def test_subsets_of_the_samples_that_a_contig_has(spark):
    depth = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, None), ("b", 1, 4.0), ("b", 3, 5.0), ("c", 2, 6.0)], "contig_id string, sample_idx int, depth double")
    got = sorted((c, tuple(s), tuple(d)) for c, s, d in K.sample_subsets(depth, 3, 2).collect())
    assert got == [("a", (1, 2), (1.0, 2.0)), ("a", (1, 3), (1.0, None)), ("a", (2, 3), (2.0, None)), ("b", (1, 3), (4.0, 5.0))]


def test_reach_carries_bins_as_bits(spark, monkeypatch):
    # a hub next to one contig of each of 100 bins (and of a bin without a name): all reach all in two steps, but no step writes a row a bin and contig
    wrote, cut = [], J.cut
    monkeypatch.setattr(J, "cut", lambda df: wrote.append(cut(df)) or wrote[-1])
    drop = []
    monkeypatch.setattr(J, "drop", lambda *frames: drop.extend(frames))
    bins = [f"b{i:03}" for i in range(100)] + [None]
    m = spark.createDataFrame([(b, i) for i, b in enumerate(bins)], "bin_id string, contig_id long")
    e = spark.createDataFrame([(i, 1000) for i in range(0, 101, 2)] + [(1000, i) for i in range(1, 101, 2)] + [(1000, 2000)], "node1 long, node2 long")
    got = sorted(((r[0] or "", r[1], r[2]) for r in J.reach(m, e, 4).collect()))
    want = {(b or "", 1000): 1 for b in bins} | {(b or "", c): 2 for b in bins for c in [*range(101), 2000]} | {(b or "", i): 0 for i, b in enumerate(bins)}
    assert got == sorted((b, c, level) for (b, c), level in want.items())
    assert max(df.count() for df in wrote) <= 210 and len(want) > 10_000


DEALT = ["a09_connections", "d03_bin_connections", "d08_hit_bins", "d11_neighbours", "d12_read_neighbours", "e02_condensed_edges", "fw5_third_largest", "j02_reach", "j03_reach_all", "j10_retrieval_all"]


@pytest.mark.parametrize("name", DEALT)
def test_many_tasks_give_the_same(spark, monkeypatch, name):
    query = __spark_entry__.queries()[name]
    plain = rows(query(spark, "/root/testdata/sf0.001"))
    monkeypatch.setattr(D, "EACH", 500)
    assert rows(query(spark, "/root/testdata/sf0.001")) == plain and plain


def test_tasks_of_pairs_grow_with_the_lines(spark, monkeypatch):
    t = Tables(spark, "/root/testdata/sf0.001")
    assert t.tasks is None
    monkeypatch.setattr(D, "EACH", 500)
    n = -(-t.lineitem.count() // 500)
    assert t.tasks == n > 4 and t.edges().rdd.getNumPartitions() == n


def test_ranges_alike_meet_once(spark, tmp_path, monkeypatch):
    # 97 * 100 * 40 parts of equal size lie in 9,700 ranges; rows of lines beside them all don't meet anything
    spark.range(400).selectExpr("id as l_orderkey", "id * 7 as l_partkey", "id * 3 as l_suppkey", "cast(id % 50 as double) as l_quantity").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(97 * 100 * 40).selectExpr("id as p_partkey", "30 as p_size").write.parquet(str(tmp_path / "part.parquet"))
    sides = []
    meet = D.overlapping
    monkeypatch.setattr(D, "overlapping", lambda a, b, *rest: sides.append(b) or meet(a, b, *rest))
    got = rows(__spark_entry__.queries()["d21_overlapping"](spark, str(tmp_path)))
    ends = [(10 * i, 10 * i + 900) for i in range(97)]
    want = []
    for i in range(400):
        lo, hi = 30 * i, 30 * i + i % 50
        shared = [min(hi, y) - max(lo, x) + 1 for x, y in ends if x <= hi and lo <= y]
        if shared:
            want.append((i, i * 7 % 100, 40 * len(shared), 40 * sum(shared)))
    assert got == sorted(want) and sides[0].count() == 9_700


def test_only_seeds_of_queries_are_dealt(spark, monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choices("ACGT", k=300)) for _ in range(40)]
    make = lambda of: spark.createDataFrame(list(enumerate(of)), "id long, seq string")
    sides, grid = [], M.join_grid
    monkeypatch.setattr(M, "join_grid", lambda a, b, on: sides.append((a, b)) or grid(a, b, on))
    got = rows(M.similar(make([texts[3]]), make(texts)), "query", "subject", "identity", "aligned")
    seeds = {r[0] for r in sides[0][0].select("hash").collect()}
    assert got == [(0, 3, 100.0, 300)] and {r[0] for r in sides[0][1].select("hash").collect()} == seeds


SHARED = ["b03_tsv", "b04_stage", "b07_bundle", "e05_symmetric", "e06_total_connections", "e14_aligned_share", "e17_supported", "j04_connected_components", "j10_retrieval"]


@pytest.mark.parametrize("name", SHARED)
def test_what_shares_the_dealt_steps(spark, monkeypatch, name):
    # equal rows, and a shuffle over a task for each 500 lines, which the fixed number of partitions (4) would not have
    query, sc = __spark_entry__.queries()[name], spark.sparkContext
    plain = rows(query(spark, "/root/testdata/sf0.001"))
    monkeypatch.setattr(D, "EACH", 500)
    n = Tables(spark, "/root/testdata/sf0.001").tasks
    sc.setJobGroup(name, name)
    try:
        assert rows(query(spark, "/root/testdata/sf0.001")) == plain
        sc._jsc.sc().listenerBus().waitUntilEmpty()
        jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup(name)]
        stages = [sc.statusTracker().getStageInfo(s) for j in jobs for s in j.stageIds]
        assert n > 4 and n in {s.numTasks for s in stages if s}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
