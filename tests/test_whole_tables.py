"""Queries over whole tables against brute force in Python."""

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
import pytest

SF = "/root/testdata/sf0.01"


def table(name, *columns):
    return pd.read_parquet(f"{SF}/{name}.parquet", columns=list(columns))


def got(spark, name, sf_dir=SF):
    import __spark_entry__

    return sorted(map(tuple, __spark_entry__.queries()[name](spark, sf_dir).collect()))


def parts(sf_dir=SF):
    """By brand: (number, completeness, contamination, n50, assembler)."""
    out = defaultdict(list)
    for k, brand, size in pd.read_parquet(f"{sf_dir}/part.parquet", columns=["p_partkey", "p_brand", "p_size"]).itertuples(index=False):
        out[brand].append((k, 2.0 * size, float(k % 7), k % 1000, ("IDBA", "SPAdes", "MEGAHIT")[k % 3]))
    return out


def reassembly(vs):
    return max(vs, key=lambda v: (v[1] - 5 * v[2] - 3 * (v[4] == "IDBA"), v[4] != "IDBA", v[3], v[4], v[0]))[0]


def hybrid(vs):
    others = [v for v in vs if v[4] != "IDBA"]
    top, n50 = max((v[1] - 5 * v[2] for v in others), default=None), max((v[3] for v in others), default=None)

    def fair(v):
        lead = None if top is None else v[1] - 5 * v[2] - top
        return v[4] != "IDBA" or top is None or lead >= 6 or (lead >= 3 and n50 and v[3] / n50 >= 0.5)

    def score(v):
        five = v[1] - 5 * v[2]
        return 1000 + five if five >= 40 else v[1] - v[2]

    return max(filter(fair, vs), key=lambda v: (score(v), v[3], v[4], v[0]))[0]


@pytest.mark.parametrize(("name", "choose"), [("g11_reassembly_choice", reassembly), ("g12_hybrid_choice", hybrid)])
def test_choice_among_all_parts(spark, name, choose):
    assert got(spark, name) == sorted((b, choose(vs)) for b, vs in parts().items())


@pytest.mark.parametrize(("name", "choose"), [("g11_reassembly_choice", reassembly), ("g12_hybrid_choice", hybrid)])
def test_choice_above_a_thousand_and_ties(spark, tmp_path, name, choose):
    # parts 21001 apart are alike in contamination, N50 and assembler: the last number is taken
    rows = [(7, "A", 20), (2506, "A", 50), (1, "B", 50), (21001, "B", 50), (42001, "B", 50), (5002, "C", 9)]
    spark.createDataFrame(rows, "p_partkey long, p_brand string, p_size long").repartition(4).write.parquet(str(tmp_path / "part.parquet"))
    want = sorted((b, choose(vs)) for b, vs in parts(tmp_path).items())
    assert want[1] == ("B", 42001) and got(spark, name, str(tmp_path)) == want


def test_changed_variants_of_all_orders(spark):
    flags = defaultdict(set)
    for s, n, a, b in table("lineitem", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus").itertuples(index=False):
        flags[s, n].add(a + b)
    by = defaultdict(list)
    for s, n in sorted(flags):
        by[s].append(n)
    want = [(s, n) for s, ns in by.items() for n, after in zip(ns, [*ns[1:], None], strict=True) if after is None or flags[s, n] != flags[s, after]]
    assert got(spark, "h07_changed_variants") == sorted(want)


def brands():
    return dict(table("part", "p_partkey", "p_brand").itertuples(index=False))


def depths():
    """By (part, sample): depth."""
    d = table("lineitem", "l_partkey", "l_returnflag", "l_quantity")
    d["sample"] = d["l_returnflag"].map({"A": 1, "N": 2}).fillna(3).astype(int)
    return d.groupby(["l_partkey", "sample"])["l_quantity"].mean().round(6).to_dict()


def connections():
    """By part: its partners and in how many orders they meet."""
    out = defaultdict(lambda: defaultdict(int))
    for _, parts_ in table("lineitem", "l_orderkey", "l_partkey").drop_duplicates().groupby("l_orderkey")["l_partkey"]:
        for a in parts_:
            for b in parts_:
                if a != b:
                    out[a][b] += 1
    return out


def fences(k):
    """By (brand, sample): the least and the greatest depth inside."""
    groups, own = defaultdict(list), brands()
    for (p, s), d in depths().items():
        groups[own[p], s].append(d)
    out = {}
    for g, x in groups.items():
        q1, q3 = np.percentile(x, [25, 75])
        out[g] = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
    return out


def test_survivors_of_all_pairs(spark):
    """Brands that lose to no brand they are connected with, by completeness less five times contamination."""
    tenth = lambda x: float(Decimal(repr(float(x))).quantize(Decimal("0.1"), ROUND_HALF_UP))
    by = {}
    for brand, g in table("part", "p_partkey", "p_brand", "p_size").groupby("p_brand"):
        by[brand] = tenth((2.0 * g["p_size"]).mean()) - 5 * tenth((g["p_partkey"] % 25).mean()), g["p_size"].sum(), g["p_size"].max()
    own = brands()
    pairs = {tuple(sorted((own[a], own[b]))) for a, bs in connections().items() for b in bs if own[a] != own[b]}
    lost = set()
    for one, two in pairs:
        if by[one][0] != by[two][0] or by[one] == by[two]:
            lost.add(one if by[one][0] < by[two][0] else two)
    assert len(pairs) > 100 and got(spark, "g04_survivors") == [(b,) for b in sorted(by) if b not in lost]


def test_reach_of_all_bins(spark):
    own, near = brands(), connections()
    strong = {a: [b for b, n in bs.items() if n >= 2] for a, bs in near.items()}
    level = {}
    for p, brand in own.items():
        one = strong.get(p, [])
        for lv, cs in ((0, [p]), (1, one), (2, [y for x in one for y in strong[x]])):
            for c in cs:
                level[brand, c] = min(lv, level.get((brand, c), 9))
    assert len({b for b, _ in level}) == 25
    assert got(spark, "j02_reach") == sorted((b, c, lv) for (b, c), lv in level.items())


def test_outliers_of_all_samples(spark):
    own, f = brands(), fences(1.5)
    want = [(own[p], p, s, not f[own[p], s][0] <= d <= f[own[p], s][1]) for (p, s), d in depths().items()]
    assert {x[2] for x in want} == {1, 2, 3} and got(spark, "k02_outliers") == sorted(want)


def test_neighbour_outliers_of_all_samples(spark):
    own, f, d = brands(), fences(1.5), depths()
    near = {(own[a], b) for a, bs in connections().items() for b in bs if own[b] != own[a]}
    want = [(g, c, s, not f[g, s][0] <= d[c, s] <= f[g, s][1]) for g, c in near for s in (1, 2, 3) if (c, s) in d and (g, s) in f]
    assert got(spark, "k04_neighbour_outliers") == sorted(want)


def test_buckets_of_all_depths(spark, tmp_path):
    rows = [(k, "A", q) for k, q in ((1, 49.0), (2, 50.0), (3, 52.0), (4, 5000.0))]
    spark.createDataFrame(rows, "l_partkey long, l_returnflag string, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    assert got(spark, "i02_coverage_buckets", str(tmp_path)) == [(1, 1, "0050", "0050"), (2, 1, "0050", "0050"), (3, 1, "0055", "0052"), (4, 1, "10000", "10000")]


def blocks():
    """Numbers of parts by blocks of 50, in which neighbours are joined; numbers need not begin at 0."""
    out = defaultdict(set)
    for p in table("part", "p_partkey")["p_partkey"]:
        out[p // 50].add(p)
    return out


def test_three_hops_from_all_parts(spark):
    numbers = {p for x in blocks().values() for p in x}
    near = defaultdict(set)
    for p in numbers:
        if p % 50 != 49:  # the edge is there even if no part has the next number
            near[p].add(p + 1)
            near[p + 1].add(p)
    want = []
    for p in numbers:
        level, front = {p: 0}, {p}
        for lv in (1, 2, 3):
            front = {y for x in front for y in near[x]} - level.keys()
            level |= dict.fromkeys(front, lv)
        want += [(p, c, lv) for c, lv in level.items()]
    assert got(spark, "j03_three_hops") == sorted(want)


def test_chains_run_to_their_end_from_all_parts(spark):
    numbers = {p for x in blocks().values() for p in x}
    want = []
    for p in numbers:
        c, step = p, 0
        while True:
            want.append((p, c, step))
            if c % 50 == 49 or c not in numbers:
                break
            c, step = c + 1, step + 1
    assert max(s for *_, s in want) >= 48 and got(spark, "j08_elongate") == sorted(want)


def chain_of(start, best):
    seen = {}
    while start is not None and start not in seen:
        seen[start] = len(seen)
        start = best.get(start)
    return seen


def test_long_chains_and_rings(spark):
    from contigra.operators.graph import elongate

    # a path of 70, a tail of 5 into a ring of 6, a ring of one and a ring of 33
    best = {i: i + 1 for i in range(70)} | {100 + i: 101 + i for i in range(10)} | {110: 105, 200: 200} | {300 + i: 300 + (i + 1) % 33 for i in range(33)}
    rows = [(a, b, 9) for a, b in best.items()] + [(a, 999, 1) for a in best]
    targets = [0, 0, 31, 70, 100, 107, 200, 305]
    out = elongate(spark.createDataFrame([(t,) for t in targets], "contig_id long"), spark.createDataFrame(rows, "query long, subject long, length int"))
    assert sorted(map(tuple, out.collect())) == sorted((t, c, s) for t in set(targets) for c, s in chain_of(t, best).items())
