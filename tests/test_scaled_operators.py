"""Operators that hold for groups and keys of any size, against plain loops."""

import itertools
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from contigra.operators import graph as J
from contigra.operators import joins as D
from contigra.operators import similarity as M
from contigra.operators import windows as W

SF = "/root/testdata/sf0.001"


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


# ---------------------------------------------------------------- similarity


def stretches(q, s, size):
    """(i, j, n) of common stretches that go no further, by comparing all characters."""
    out = []
    for d in range(-len(q), len(s)):
        i, end = max(0, -d), min(len(q), len(s) - d)
        while i < end:
            n = 0
            while i + n < end and q[i + n] == s[i + n + d]:
                n += 1
            if n >= size:
                out.append((i, i + d, n))
            i += n + 1
    return out


def differences(a, b):
    """Levenshtein distance, then the fewest columns, over the whole table."""
    t = {(x, 0): (x, x) for x in range(len(a) + 1)} | {(0, y): (y, y) for y in range(len(b) + 1)}
    for x, y in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        ways = [(t[x - 1, y - 1], a[x - 1] != b[y - 1]), (t[x - 1, y], 1), (t[x, y - 1], 1)]
        t[x, y] = min((c + more, m + 1) for (c, m), more in ways)
    return t[len(a), len(b)]


def best(q, s, size=24, band=32, gap=64):
    """(score, cost, columns, qstart, qend, sstart, send) over all tiles of diagonals."""
    found, top = stretches(q, s, size), None
    for tile in {x for i, j, _ in found for x in ((j - i) // band, (j - i) // band - 1)}:
        own = sorted(a for a in found if tile * band <= a[1] - a[0] < (tile + 2) * band)
        ways = []
        for i, j, n in own:
            way = (n, [(i, j, n)])
            for score, path in ways:
                x, y, m = path[-1]
                whole = next(a for a in own if (a[0] + a[2], a[1] + a[2]) == (x + m, y + m))
                over = max(0, x + m - i, y + m - j)
                if whole[0] < i and whole[1] < j and over < n and max(i - x - m, j - y - m) <= gap and score - over > 0 and n + score - over > way[0]:
                    way = (n + score - over, [*path, (i + over, j + over, n - over)])
            ways.append(way)
        for score, path in ways:
            rank = (-score, path[0][0], path[0][1])
            if top is None or rank < top[0]:
                top = (rank, path)
    if top is None:
        return None
    path = top[1]
    gaps = [differences(q[i + n : x], s[j + n : y]) for (i, j, n), (x, y, _) in itertools.pairwise(path)]
    cost, columns = sum(g[0] for g in gaps), sum(g[1] for g in gaps) + sum(n for _, _, n in path)
    return -top[0][0], cost, columns, path[0][0] + 1, path[-1][0] + path[-1][2], path[0][1] + 1, path[-1][1] + path[-1][2]


def wanted(queries, subjects, identity=85, least=50):
    out = []
    for (a, q), (b, s) in itertools.product(queries, subjects):
        hit = best(q, s) if q and s else None
        if hit and hit[2] >= least and round(100 * (hit[2] - hit[1]) / hit[2], 3) >= identity:
            out.append((a, b, hit[0], hit[2], *hit[3:]))
    return sorted(out)


FIELDS = ("query", "subject", "score", "aligned", "qstart", "qend", "sstart", "send")


def changed(rng, text, share):
    out = []
    for c in text:
        x = rng.random()
        out.append(rng.choice("ACGT") if x < share / 2 else "" if x < 0.75 * share else c + rng.choice("ACGT") if x < share else c)
    return "".join(out)


def test_similar_sequences_with_changes_gaps_and_repeats(spark):
    rng = random.Random(5)
    dna = lambda n: "".join(rng.choices("ACGT", k=n))
    base = [dna(400) for _ in range(4)]
    subjects = [dna(rng.choice([0, 200, 3000])) + changed(rng, b, share) + dna(150) for b in base for share in (0, 0.01, 0.03)] + ["ACACACAC" * 30, None, "", dna(20), base[0] + dna(90) + base[0], base[1][:200] + base[2][200:]]
    queries = [*base, "ACACACAC" * 12, dna(10), None, base[0][100:300] + "ACGT" * 9 + base[0][300:]]
    make = lambda x: spark.createDataFrame(list(enumerate(x)), "id long, seq string")
    got = M.similar(make(queries), make(subjects))
    assert rows(got, *FIELDS) == wanted(list(enumerate(queries)), list(enumerate(subjects)))
    back = M.similar(make([b.translate(str.maketrans("ACGT", "TGCA"))[::-1] for b in base]), make(subjects), both=True)
    assert {r["strand"] for r in back.collect()} == {"-"} and {(r["query"], r["subject"]) for r in back.collect()} >= {(0, 0), (1, 3), (2, 6), (3, 9)}
    assert rows(M.similar(make(queries).limit(0), make(subjects))) == []


def test_similar_items_and_documents(spark):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    parts = {t[i : i + 24] for _, t in items for i in range(len(t) - 23)}
    near = [(d, t) for d, t in docs if any(t[i : i + 24] in parts for i in range(len(t) - 23))]  # others share no stretch
    assert near
    from __spark_entry__ import queries

    got = queries()["d19_similar"](spark, SF)
    assert rows(got, *FIELDS) == wanted(items, near)


def test_minimizers_do_not_depend_on_blocks(monkeypatch):
    text = "".join(random.Random(1).choices("ACGT", k=500))
    whole = M.minimizers(text, 15, 10)
    monkeypatch.setattr(M, "BLOCK", 37)
    again = M.minimizers(text, 15, 10)
    assert np.array_equal(whole[0], again[0]) and np.array_equal(whole[1], again[1])
    assert len(M.minimizers("A" * 23, 15, 10)[0]) == 0 and len(M.minimizers("A" * 24, 15, 10)[0]) == 1


# ---------------------------------------------------------------- joins


def test_one_read_of_many_contigs_is_a_grid(spark):
    n = 100_000
    reads = spark.range(n).select(F.lit("hub").alias("read_id"), F.col("id").alias("contig_id")).union(spark.range(300).select(F.concat(F.lit("r"), (F.col("id") % 100).cast("string")), F.col("id")))
    own = spark.range(3).select(F.col("id").cast("string").alias("bin_id"), F.lit("hub").alias("read_id")).union(spark.createDataFrame([("b", "r1"), ("b", None)], "bin_id string, read_id string"))
    got = D.join_grid(own, reads, ["read_id"])
    assert "x_" in plan(got) and got.count() == 3 * n + 3
    cells = reads.where("read_id = 'hub'").count() // 1000
    assert got.where("read_id = 'hub'").select("bin_id", "contig_id").distinct().count() == 3 * n and cells == 100
    both = D.join_grid(reads.where("contig_id < 3000"), reads.where("contig_id < 2000").withColumnRenamed("contig_id", "other"), ["read_id"])
    assert both.count() == reads.where("contig_id < 3000").join(reads.where("contig_id < 2000").withColumnRenamed("contig_id", "other"), "read_id").count()
    m = spark.createDataFrame([("b", 0), ("b", 1), ("c", 2)], "bin_id string, contig_id long")
    support = D.read_neighbours(m, reads)
    twice = D.read_neighbours(m, reads.union(reads.where("contig_id = 7"))).where("bin_id = 'b'")
    assert support.where("bin_id = 'b' and contig_id = 7").first()["support"] * 2 == twice.where("contig_id = 7").first()["support"]
    assert support.where("bin_id = 'b'").count() == n - 2 and support.where("bin_id = 'b' and contig_id > 300").agg(F.max("support"), F.min("support")).first() == (2, 2)


def similar_by_loops(profiles, low, most):
    have = {}
    for b, s, d in profiles:
        have.setdefault(b, {})
        if d is not None:
            have[b][s] = d
    out = []
    for b, c in itertools.combinations(sorted(have), 2):
        both = have[b].keys() & have[c].keys()
        if both and all(min(x, y) <= low or 200 * abs(x - y) / (x + y) <= most for x, y in ((have[b][s], have[c][s]) for s in both)):
            out.append((b, c))
    return out


@pytest.mark.parametrize("low_share, most", [(0.0, 20), (0.3, 100), (0.7, 5), (1.0, 100)])
def test_similar_coverage_by_loops(spark, low_share, most):
    rng = random.Random(int(low_share * 10))
    depth = lambda: rng.choice([0.0, 3.0, 10.0]) if rng.random() < low_share else rng.choice([10.5, 11.0, 12.0, 30.0, 31.5, 33.0, 90.0, 1e6])
    profiles = [(f"b{i:02d}", s, rng.choice([None, x := depth(), x, x, x])) for i in range(70) for s in range(4) if rng.random() < 0.7]
    df = spark.createDataFrame(profiles, "bin_id string, sample_idx int, depth double").repartition(3)
    want = similar_by_loops(profiles, 10, most)
    assert rows(D.similar_coverage(df, 10, most)) == want and (want or most == 5)
    assert D.similar_coverage(df.where("false")).count() == 0


def test_similar_coverage_of_a_crowded_band(spark):
    """2,000 profiles of one band and 300 that are low wherever those are not: the band is a grid, and low profiles meet no one but by their samples."""
    n, m = 2000, 300
    one = spark.range(n).selectExpr("concat('a', id) as bin_id", "1 as sample_idx", "100.0 + id % 2 * 400 as depth")
    two = spark.range(m).selectExpr("concat('l', id) as bin_id", "explode(array(1, 2)) as sample_idx").withColumn("depth", F.when(F.col("sample_idx") == 1, 5.0).otherwise(50.0))
    got = D.similar_coverage(one.union(two), 10, 100).groupBy(F.substring("bin1", 1, 1).alias("x"), F.substring("bin2", 1, 1).alias("y")).agg(F.count("*"), F.count_distinct("bin1", "bin2"))
    half, low = 2 * (n // 2) * (n // 2 - 1) // 2, m * (m - 1) // 2
    assert rows(got) == [("a", "a", half, half), ("a", "l", n * m, n * m), ("l", "l", low, low)]


def test_overlapping_intervals(spark):
    rng = random.Random(2)
    make = lambda n, top: [(i, rng.choice([0, 0, 1, None]), lo := rng.choice([rng.randrange(-600, 600), 64, 127, 128, 256]), lo + rng.choice([0, 1, 63, 64, 127, top, -1])) for i in range(n)]
    a, b = [*make(150, 5000), (900, 0, None, 5)], [*make(150, 300), (901, 0, -(10**9), 10**9)]
    one, two = spark.createDataFrame(a, "a long, k long, lo1 long, hi1 long"), spark.createDataFrame(b, "b long, k long, lo2 long, hi2 long")
    got = D.overlapping(one, two, ["k"], ("lo1", "hi1"), ("lo2", "hi2"))
    want = sorted((x[0], y[0]) for x in a for y in b if x[1] is not None and x[1] == y[1] and x[2] is not None and max(x[2], y[2]) <= min(x[3], y[3]) and x[2] <= x[3] and y[2] <= y[3])
    assert rows(got, "a", "b") == want and got.columns == ["k", "a", "lo1", "hi1", "b", "lo2", "hi2"]
    assert D.overlapping(one.limit(0), two, ["k"], ("lo1", "hi1"), ("lo2", "hi2")).count() == 0


# ---------------------------------------------------------------- prefix scans and schedules


def test_running_records_of_one_group_of_all_rows(spark):
    n = 20_000
    values = np.random.default_rng(0).normal(size=n).cumsum() + 60
    df = spark.createDataFrame([("g", i, float(v)) for i, v in enumerate(values)] + [(None, 5, 70.0), (None, 6, 60.0), ("h", 1, None), ("h", 2, 51.0)], "k string, o long, v double").repartition(8)
    got = W.running_records(df, "k", "v", "o")
    top, want = -np.inf, []
    for i, v in enumerate(values):
        if v > top and v >= 50:
            want.append(i)
        top = max(top, v)
    assert rows(got.where("k = 'g'"), "o") == [(i,) for i in want] and rows(got.where("k is null or k = 'h'"), "o") == [(2,), (5,)]
    specs = re.findall(r"windowspecdefinition\(([^)]*)", plan(got))
    assert any(s.startswith("p_#") for s in specs) and not any(s.startswith("k#") and "o#" in s for s in specs)  # rows only within ranges
    assert df.repartitionByRange(4, "k", "o").groupBy(F.spark_partition_id()).count().count() > 1


def schedule(hits):
    best_, n = 0, len(hits)
    for mask in range(1 << n):
        own = sorted(h for i, h in enumerate(hits) if mask >> i & 1)
        if all(a[1] < b[0] for a, b in itertools.pairwise(own)):
            best_ = max(best_, sum(h[2] for h in own))
    return best_


def test_schedules(spark):
    rng = random.Random(4)
    hits = [(r, i, s := rng.randrange(40), s + rng.choice([0, 3, 9, 30]), float(rng.choice([1, 2, 5, 5, -3]))) for r in range(60) for i in range(rng.choice([1, 4, 9]))]
    df = spark.createDataFrame([*hits, (99, 1, None, 4, 1.0), (98, 1, 5, 2, 1.0), (97, 1, 1, 2, None)], "read_id long, contig_id long, start long, end long, score double").repartition(6)
    own = {}
    for r in J.scheduled(df).collect():
        own.setdefault(r["read_id"], []).append((r["start"], r["end"], r["score"]))
    for r in range(60):
        got = sorted(own.get(r, []))
        assert all(a[1] < b[0] for a, b in itertools.pairwise(got)) and sum(g[2] for g in got) == schedule([h[2:] for h in hits if h[0] == r])
    assert not {97, 98, 99} & set(own)
    road = J.roadmap(df.withColumn("strand", F.lit("+")))
    assert all(len(x["contigs"]) >= 2 for x in road.collect())


def test_a_read_with_very_many_hits(spark):
    n = 30_000
    df = spark.range(n).select(F.lit("r").alias("read_id"), F.col("id").alias("contig_id"), (F.col("id") * 10).alias("start"), (F.col("id") * 10 + F.when(F.col("id") % 3 == 0, 12).otherwise(5)).alias("end"), (F.col("id") % 3 + 1).alias("score"))
    got = J.scheduled(df.repartition(8))
    best_ = J.best_schedule(*(np.array(x) for x in ([i * 10 for i in range(n)], [i * 10 + (12 if i % 3 == 0 else 5) for i in range(n)], [i % 3 + 1 for i in range(n)])))
    assert got.agg(F.sum("score")).first()[0] == sum(i % 3 + 1 for i in best_)


# ---------------------------------------------------------------- elongation


def test_elongated_sequences(spark):
    rng = random.Random(8)
    text = "".join(rng.choices("ACGT", k=900))
    cuts = [0, *(50 * i + rng.randrange(20) for i in range(1, 18)), 900]
    seqs, laps = [], []
    for i, (a, b) in enumerate(itertools.pairwise(cuts)):
        lap = rng.choice([0, 7, 19])
        seqs.append((f"c{i:02}", text[a : min(b + lap, 900)]))
        if b < 900:
            laps.append((f"c{i:02}", f"c{i + 1:02}", min(lap, 900 - b)))
    seqs += [("x", "AAACC"), ("y", "CCTTT"), ("z", "TTTAA"), ("alone", "GG"), ("long", "ACG")]
    rings = [("x", "y", 2), ("y", "z", 3), ("z", "x", 2), ("long", "alone", 50), ("x", "alone", 1), ("z", "gone", 9)]
    c, o = spark.createDataFrame(seqs, "contig_id string, seq string"), spark.createDataFrame(laps + rings, "query string, subject string, length int")
    got = {r["target"]: r for r in J.elongated(c.select("contig_id").union(spark.createDataFrame([("absent",)], "contig_id string")), o, c).collect()}
    assert got["c00"]["seq"] == text and got["c00"]["length"] == 900 and got["c00"]["contigs"] == 18
    whole = dict(seqs)
    step = {q: (s, min(n, len(whole[q]), len(whole[s]))) for q, s, n in [*laps, *rings[:2], ("z", "x", 2), ("long", "alone", 50)]}
    for target in whole:
        seq, at, met = whole[target], target, {target}
        while at in step and step[at][0] not in met:
            at, n = step[at]
            met.add(at)
            seq += whole[at][n:]
        assert got[target]["seq"] == seq and got[target]["length"] == len(seq) and got[target]["contigs"] == len(met)
    assert "absent" not in got


@pytest.mark.parametrize("columns", [1, 2])
def test_islands(spark, columns):
    df = spark.createDataFrame([("r", 1, 5), ("r", 3, 4), ("r", 5, 6), ("r", 7, 9), ("s", 0, 100), ("s", 50, 60), ("s", 101, 101)][: 7 * columns], "g string, a long, b long").repartition(3)
    assert rows(W.islands(df, ["g"], "a", "b", ["b"]), "g", "a", "island") == [("r", 1, 1), ("r", 3, 1), ("r", 5, 1), ("r", 7, 7), ("s", 0, 0), ("s", 50, 0), ("s", 101, 101)]


# ---------------------------------------------------------------- exact selection


def test_ranks_in_crowded_bands(spark, monkeypatch):
    """Bands are split until few values are left: the same values as of whole sorted groups, however close they lie."""
    rng = np.random.default_rng(3)
    groups = {
        "close": rng.uniform(1000, 1010, 6000),
        "closer": 1 + rng.integers(0, 5000, 7000) * 2.0**-52,
        "mixed": np.concatenate([rng.normal(0, 1, 800), 10.0 ** rng.uniform(-300, 300, 900), -(10.0 ** rng.uniform(-300, 300, 700)), [np.inf, -np.inf] * 40, rng.uniform(1.2e308, 1.7e308, 200)]),
        "ties": rng.integers(0, 3, 2000).astype(float),
        "steps": np.repeat(rng.uniform(5, 5.001, 300), 9),
        None: rng.uniform(1000, 1001, 500),
        "few": np.array([3.0, 1.0]),
        "one": np.array([7.0]),
    }
    df = spark.createDataFrame([(g, float(v)) for g, x in groups.items() for v in x] + [("few", None), ("none", None)], "bin_id string, v double").repartition(6)
    from contigra.operators import aggregates as A

    plain = rows(A.nth_quartiles(df, ["bin_id"], "v"))
    middle = rows(A.quartiles(df.where("bin_id <> 'mixed'"), ["bin_id"], "v"))
    monkeypatch.setattr(A, "SMALL", 20)
    monkeypatch.setattr(A, "PARTS", 7)
    assert rows(A.nth_quartiles(df, ["bin_id"], "v")) == plain
    assert rows(A.quartiles(df.where("bin_id <> 'mixed'"), ["bin_id"], "v")) == middle
    got = {r[0]: r[1:] for r in plain}
    assert set(got) == set(groups)
    for g, x in groups.items():
        at = [int(len(x) * p) for p in (0.25, 0.75)]
        assert got[g] == tuple(float(np.sort(x)[i - 1]) if i else None for i in at)


def test_ranks_of_one_group_of_many_close_values(spark, monkeypatch):
    from contigra.operators import aggregates as A

    monkeypatch.setattr(A, "SMALL", 100)
    df = spark.range(30_000).select(F.lit("g").alias("bin_id"), (1000 + F.col("id") / 3000).alias("v")).union(spark.createDataFrame([("s", float(i)) for i in range(40)], "bin_id string, v double"))
    got = A.quartiles(df, ["bin_id"], "v")
    assert rows(got)[0] == ("g", pytest.approx(1000 + 29_999 / 4 / 3000), pytest.approx(1000 + 3 * 29_999 / 4 / 3000))
    assert A.nth_quartiles(df.limit(0), ["bin_id"], "v").count() == 0


# ---------------------------------------------------------------- axes in full width


def test_axes_of_small_and_large_groups(spark, monkeypatch):
    from contigra.operators import ml as K

    rng = np.random.default_rng(0)
    groups = {"a": rng.normal(size=(300, 40)) * np.linspace(4, 1, 40), "b": rng.normal(size=(7, 40)) * np.linspace(9, 1, 40), None: rng.normal(size=(45, 40)) * np.linspace(5, 1, 40), "c": rng.normal(size=(1, 40))}
    df = spark.createDataFrame([(g, i, [float(v) for v in x]) for g, xs in groups.items() for i, x in enumerate(xs)], "bin_id string, contig_id long, vector array<double>").repartition(5)
    for held in (1 << 23, 500):
        monkeypatch.setattr(K, "HELD", held)
        got = {r["bin_id"]: r for r in K.axes(df, k=2).collect()}
        assert set(got) == set(groups)
        for g, x in groups.items():
            if len(x) > 2:
                v = np.linalg.svd(x - x.mean(0))[2][:2]
                v = v * np.sign(v[np.arange(2), np.abs(v).argmax(1)])[:, None]
                assert np.allclose(got[g]["axes"], v) and np.allclose(got[g]["shifts"], v @ x.mean(0))


def test_kmer_fence_of_256_dimensions(spark):
    from __spark_entry__ import queries

    sf = "/root/testdata/sf0.01"
    docs = {d: (s, t.upper()) for d, s, t in duckdb.sql(f"SELECT doc_id, source, text FROM '{sf}/documents.parquet' WHERE length(text) >= 500").fetchall()}
    ids = {r[0] for r in duckdb.sql(f"SELECT doc_id FROM '{sf}/documents.parquet'").fetchall()}
    names, flip = ["".join(p) for p in itertools.product("ATCG", repeat=4)], str.maketrans("ACGT", "TGCA")
    vectors = {}
    for d, (_, text) in docs.items():
        seen = re.findall(r"(?=([ACGT]{4}))", text)
        if seen:
            count = {}
            for m in seen + [m.translate(flip)[::-1] for m in seen]:
                count[m] = count.get(m, 0) + 1
            vectors[d] = np.array([round(count.get(n, 0) / (2 * len(seen)), 8) for n in names])
    want = {}
    for source in {docs[d][0] for d in vectors}:
        own = [d for d in vectors if docs[d][0] == source]
        x = np.array([vectors[d] for d in own])
        axis = np.linalg.svd(x - x.mean(0))[2][0]
        axis = axis * np.sign(axis[np.abs(axis).argmax()])
        pc = (x - x.mean(0)) @ axis
        q1, q3 = np.quantile(pc, [0.25, 0.75])
        near = {n for d in own for n in (d - 1, d + 1) if n in ids | {max(ids) + 1} and (d in ids and n in vectors)} - set(own)
        for n in near:
            z = (vectors[n] - x.mean(0)) @ axis
            want[source, n] = (z - (q1 - 1.5 * (q3 - q1)), z - (q3 + 1.5 * (q3 - q1)))
    got = {(r["bin_id"], r["contig_id"]): r["outlier"] for r in queries()["k03_kmer_outliers"](spark, sf).collect()}
    assert set(got) == set(want) and any(got.values())
    for k, (low, high) in want.items():
        if min(abs(low), abs(high)) > 1e-9:
            assert got[k] == (low < 0 or high > 0)


def test_has_rows_counts_in_tasks(spark):
    df = spark.range(1000).repartition(7)
    assert W.has_rows(df, 1000) and not W.has_rows(df, 1001) and not W.has_rows(df.limit(0), 1) and W.has_rows(df, 1)


def test_scaled_features_with_components(spark):
    """Seven samples: scaled by bin, then three components over all contigs."""
    from contigra.operators import ml as K

    rng = np.random.default_rng(6)
    depths, kmers = rng.gamma(2, 3, size=(80, 7)) * np.linspace(3, 1, 7), rng.random((80, 4))
    bins = ["a" if i % 3 else "b" for i in range(79)] + [None]
    df = spark.createDataFrame([(b, i, d.tolist(), k.tolist()) for i, (b, d, k) in enumerate(zip(bins, depths, kmers, strict=True))], "bin_id string, contig_id long, depths array<double>, kmers array<double>").repartition(4)
    got = {r["contig_id"]: np.array(r["vector"]) for r in K.scaled_features(df, 7).collect()}
    plain = {r["contig_id"]: np.array(r["vector"]) for r in K.features(df, 5, 7).collect()}
    raw = np.array([plain[i] for i in range(80)])
    assert raw.shape == (80, 26)
    scaled = np.empty_like(raw)
    for b in set(bins):
        own = np.array([x == b for x in bins])
        away = np.abs(raw[own] - raw[own].mean(0))
        scaled[own] = away / (away.max(0) + 1e-8)
    x = scaled[:, :7] - scaled[:, :7].mean(0)
    axes = np.linalg.svd(x)[2][:3]
    axes = axes * np.sign(axes[np.arange(3), np.abs(axes).argmax(1)])[:, None]
    want = np.hstack([x @ axes.T, scaled[:, 7:]])
    assert np.allclose(np.array([got[i] for i in range(80)]), want, atol=1e-9)


def test_components_of_all_parts(spark):
    """The query of seven samples: scaled by brand, three components over all parts, the rest as it is."""
    from contigra.queries import QUERIES
    from contigra import sequence_queries  # noqa: F401  (it adds the query)
    from contigra.operators import ml as K

    q = duckdb.sql(f"""SELECT p_brand, p_partkey, p_size, list_transform(range(1, 8), lambda i: q[i]) FROM (SELECT l_partkey, [{', '.join(f'sum(CASE WHEN l_linenumber = {i} THEN CAST(l_quantity AS DOUBLE) ELSE 0 END)' for i in range(1, 8))}] AS q
        FROM '{SF}/lineitem.parquet' GROUP BY 1) JOIN '{SF}/part.parquet' ON l_partkey = p_partkey""").fetchall()
    brand, ids, size, depths = ([r[i] for r in q] for i in range(4))
    raw = spark.createDataFrame([(int(i), [float(v) for v in d], [s / 50]) for i, d, s in zip(ids, depths, size, strict=True)], "contig_id long, depths array<double>, kmers array<double>")
    plain = {r["contig_id"]: np.array(r["vector"]) for r in K.features(raw, 5, 7).collect()}
    x = np.array([plain[i] for i in ids])
    for b in set(brand):
        own = np.array([v == b for v in brand])
        away = np.abs(x[own] - x[own].mean(0))
        x[own] = away / (away.max(0) + 1e-8)
    low = x[:, :7] - x[:, :7].mean(0)
    axes = np.linalg.svd(low)[2][:3]
    axes = axes * np.sign(axes[np.arange(3), np.abs(axes).argmax(1)])[:, None]
    want = np.hstack([low @ axes.T, x[:, 7:]])
    got: dict = {}
    for r in QUERIES["k05_components"](spark, SF).collect():
        got.setdefault(r["contig_id"], {})[r["place"]] = r["value"]
    assert got.keys() == set(ids)
    assert np.allclose([[got[i][p] for p in range(want.shape[1])] for i in ids], want, atol=2e-6)
