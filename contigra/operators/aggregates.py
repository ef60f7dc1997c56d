"""E-1 to E-37: aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contigra.functions.scalar import any_of, covrange, dcovrange, pct_avg, pct_ref, pct_sum
from contigra.operators.joins import join_heavy, over


def edge_sums(edges: DataFrame) -> DataFrame:
    """E-1: edges summed over samples, ends as written."""
    return edges.groupBy("node1", "node2").agg(F.sum("connections").alias("connections"))


def condensed_edges(ends: DataFrame, least: int = 2, n: int | None = None) -> DataFrame:
    """E-2: end edges (ids ending in s or e) of ``least`` and more, as unordered contig edges; ``n``: tasks that end edges are dealt over."""
    strong = edge_sums(over(ends, n, "node1", "node2")).where(F.col("connections") >= least)
    a, b = (F.regexp_replace(c, "[se]$", "") for c in ("node1", "node2"))
    return strong.select(F.least(a, b).alias("node1"), F.greatest(a, b).alias("node2"), "connections").groupBy("node1", "node2").agg(F.sum("connections").alias("connections"))


def end_edges(pairs: DataFrame, long: int = 3000) -> DataFrame:
    """E-3: (node1, node2, connections) with ends in the names; a contig meets itself only if it is ``long`` and one end is its start.

    pairs: contig1, end1, contig2, end2, length1.
    """
    own = F.col("contig1") == F.col("contig2")
    ring = (F.col("length1") >= long) & ((F.col("end1") == "s").cast("int") + (F.col("end2") == "s").cast("int") == 1)
    return pairs.where(~own | ring).groupBy(F.concat("contig1", "end1").alias("node1"), F.concat("contig2", "end2").alias("node2")).agg(F.count(F.lit(1)).alias("connections"))


def hit_coverage(hits: DataFrame, lengths: DataFrame, read_length: int) -> DataFrame:
    """E-4: reads on a contig times the even read length over its length."""
    even = 2 * ((read_length + 1) // 2)
    n = hits.groupBy("contig_id").agg(F.count(F.lit(1)).alias("hits"))
    return n.join(lengths, "contig_id").select("contig_id", (F.col("hits") * even / F.col("length")).alias("coverage"))


def symmetric(pairs: DataFrame) -> DataFrame:
    """E-5: bin pairs in both directions, summed."""
    return pairs.union(pairs.select("bin2", "bin1", "connections")).groupBy("bin1", "bin2").agg(F.sum("connections").alias("connections"))


def total_connections(bins: DataFrame, matrix: DataFrame) -> DataFrame:
    """E-6: the row sum of each bin, 0 if it has none."""
    t = matrix.groupBy(F.col("bin1").alias("bin_id")).agg(F.sum("connections").alias("total"))
    return bins.select("bin_id").distinct().join(t, "bin_id", "left").select("bin_id", F.coalesce("total", F.lit(0)).alias("total"))


def coverage_matrix(depth: DataFrame, samples: int) -> DataFrame:
    """E-7: contig_id, total, average (3 decimals), and depth, coarse and fine bucket by sample."""
    wide = depth.groupBy("contig_id").pivot("sample_idx", list(range(1, samples + 1))).agg(F.first("depth"))
    total = sum((F.coalesce(F.col(f"`{i}`"), F.lit(0.0)) for i in range(1, samples + 1)), F.lit(0.0))
    columns = [c for i in range(1, samples + 1) for c in (F.col(f"`{i}`").alias(f"coverage_{i}"), covrange(f"`{i}`").alias(f"range_{i}"), dcovrange(f"`{i}`").alias(f"fine_{i}"))]
    return wide.select("contig_id", total.alias("total"), F.round(total / samples, 3).alias("average"), *columns)


def bin_coverage(members: DataFrame, depth: DataFrame) -> DataFrame:
    """E-9: (bin_id, sample_idx, depth): unweighted means."""
    return members.join(depth.select("contig_id", "sample_idx", "depth"), "contig_id").groupBy("bin_id", "sample_idx").agg(F.avg("depth").alias("depth"))


def bin_gc(members: DataFrame, contigs: DataFrame) -> DataFrame:
    """E-10: bin_id, gc (1 decimal), size, contigs; counts meet first, sequences never leave the scan."""
    counted = contigs.select("contig_id", F.length("seq").alias("n"), (F.length("seq") - F.length(F.translate("seq", "GC", ""))).alias("gc_n"))
    g = members.join(counted, "contig_id").groupBy("bin_id").agg(F.sum("gc_n").alias("g"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("contigs"))
    return g.select("bin_id", F.round(F.try_divide(100.0 * F.col("g"), F.col("size")), 1).alias("gc"), "size", "contigs")


def shared_percent(shared: DataFrame, sizes1: DataFrame, sizes2: DataFrame) -> DataFrame:
    """E-11: pct of bin1 and of bin2 that is shared, each rounded once."""
    j = shared.join(sizes1.select(F.col("bin_id").alias("bin1"), F.col("size").alias("size1")), "bin1").join(sizes2.select(F.col("bin_id").alias("bin2"), F.col("size").alias("size2")), "bin2")
    return j.select("bin1", "bin2", F.round(100.0 * F.col("shared") / F.col("size1"), 2).alias("pct1"), F.round(100.0 * F.col("shared") / F.col("size2"), 2).alias("pct2"))


def aligned_bases(hits: DataFrame) -> DataFrame:
    """E-13: whole aligned bases by contig pair."""
    return hits.groupBy("query", "subject").agg(F.sum(F.floor(F.col("length") * F.col("identity") / 100)).alias("aligned"))


def aligned_share(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """E-14: half the aligned bases over each size, since hits are seen twice."""
    s = sizes.select("bin_id", "size")
    j = pairs.join(s.toDF("bin1", "size1"), "bin1").join(s.toDF("bin2", "size2"), "bin2")
    return j.select("bin1", "bin2", F.round(50 * F.col("aligned") / F.col("size1"), 2).alias("share1"), F.round(50 * F.col("aligned") / F.col("size2"), 2).alias("share2"))


def read_contigs(hits: DataFrame, least: int = 14, contigs: int = 2) -> DataFrame:
    """E-15: (read_id, contig_id, n) with ``least`` hits, of reads that keep ``contigs`` contigs."""
    n = hits.groupBy("read_id", "contig_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    wide = n.groupBy("read_id").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= contigs).select("read_id")
    return n.join(wide, "read_id", "left_semi")


def two_contig_edges(hits: DataFrame) -> DataFrame:
    """E-16: edges of reads that reach two contigs exactly, unordered."""
    two = hits.groupBy("read_id").agg(F.min("contig_id").alias("node1"), F.max("contig_id").alias("node2"), F.countDistinct("contig_id").alias("k")).where("k = 2")
    return two.groupBy("node1", "node2").agg(F.count(F.lit(1)).alias("connections"))


def supported(df: DataFrame, column: str = "support", least: int = 3) -> DataFrame:
    """E-17."""
    return df.where(F.col(column) >= least)


#: Distinct values that one group, or one band of a group, has at most where they are put in order; parts that a crowded band is split into.
SMALL, PARTS = 250_000, 1024


def _band(value: str) -> Column:
    """A whole number that never falls as ``value`` grows: 64 bands for each doubling, so one group's values lie in many."""
    v = F.col(value).cast("double")
    deep = lambda x: F.floor(F.log2(x) * 64) + F.lit(1 << 20)
    edge = F.lit(1 << 30).cast("long")
    far = F.when(F.isnan(v), edge + 2).when(v == float("inf"), edge + 1).when(v == float("-inf"), -edge - 1).when(v > 1e308, edge).when(v < -1e308, -edge)
    return far.when(v > 0, deep(v)).when(v < 0, -deep(-v)).otherwise(F.lit(0).cast("long"))


def _same(keys: list[str], suffix: str) -> Column:
    """Equal keys, nulls included; those of the other side end in ``suffix``."""
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}{suffix}"))
    return same


def _renamed(df: DataFrame, keys: list[str], suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}{suffix}" for c in keys})


def _picked(counted: DataFrame, keys: list[str], within: list[str], ranks: dict[str, Column], base: Column) -> DataFrame:
    """By group: the values at ``ranks`` among ordered rows (v_, c_) of groups or bands ``within``, of which ``base`` rows come before."""
    to = base + F.sum("c_").over(Window.partitionBy(*within).orderBy("v_").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    near = counted.withColumn("to_", to)
    hit = lambda rank: (rank >= F.col("to_") - F.col("c_")) & (rank < F.col("to_"))
    return near.groupBy(*keys).agg(F.first("n_").alias("n_"), *[F.min(F.when(hit(rank), F.col("v_"))).alias(name) for name, rank in ranks.items()])


def _at_ranks(df: DataFrame, keys: list[str], value: str, ranks: dict[str, Column]) -> DataFrame:
    """By group: its size n_ and the values at ``ranks`` (from 0, from n_) in order.

    Equal values are counted before the shuffle, and the counts are written.  Groups of SMALL distinct values and fewer are put in order
    as they are.  In others counts by band of values tell in which band each rank lies; a band that is still crowded is split again between
    the least and the greatest of its values, until no more than SMALL are left, which takes a few rounds however close values lie.
    So the values of a group, however many and however concentrated, are never one task's work, and the results are the same.
    """
    from contigra.operators.graph import cut

    counted = cut(df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("v_")).agg(F.count(F.lit(1)).alias("c_")))
    sizes = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("d_"), F.sum("c_").alias("n_"))
    all_ = F.sum("c_").over(Window.partitionBy(*keys))
    if counted.count() <= SMALL or sizes.agg(F.max("d_")).first()[0] <= SMALL:
        return _picked(counted.withColumn("n_", all_), keys, keys, ranks, F.lit(0))

    wide = cut(_renamed(sizes.where(F.col("d_") > SMALL).drop("d_"), keys, "_w_"))
    few = counted.join(wide, _same(keys, "_w_"), "left_anti")
    many = cut(counted.join(wide, _same(keys, "_w_")).select(*keys, "v_", "c_", "n_"))
    inside = any_of([(rank >= F.col("low_")) & (rank < F.col("low_") + F.col("k_")) for rank in ranks.values()])

    def wanted(rows: DataFrame, within: list[str], band: str) -> DataFrame:
        """Bands that hold a rank: their least and greatest values, rows and distinct values, and the rows before them."""
        g = rows.groupBy(*within, band).agg(F.first("n_").alias("n_"), F.first("base_").alias("base_"), F.sum("c_").alias("k_"), F.count(F.lit(1)).alias("d_"), F.min("v_").alias("lo_"), F.max("v_").alias("hi_"))
        upto = F.sum("k_").over(Window.partitionBy(*within).orderBy(band).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return cut(g.withColumn("low_", F.col("base_") + upto - F.col("k_")).where(inside).select(*keys, "lo_", "hi_", "low_", "d_"))

    def within(bands: DataFrame) -> DataFrame:
        at = _same(keys, "_w_") & (F.col("v_") >= F.col("lo_")) & (F.col("v_") <= F.col("hi_"))
        return many.join(_renamed(bands, keys, "_w_"), at).select(*keys, "v_", "c_", "n_", "lo_", "hi_", "low_")

    bands = wanted(many.withColumns({"b_": _band("v_"), "base_": F.lit(0).cast("long")}), keys, "b_")
    done = bands.where(F.col("d_") <= SMALL)
    while not bands.where(F.col("d_") > SMALL).isEmpty():
        crowded = within(bands.where(F.col("d_") > SMALL))
        v, lo, hi = (F.col(c).cast("double") for c in ("v_", "lo_", "hi_"))
        part = F.least(F.floor((v - lo) / (hi - lo) * PARTS), F.lit(PARTS - 1))
        bands = wanted(crowded.withColumns({"b_": part, "base_": F.col("low_"), "from_": F.col("lo_")}), [*keys, "from_"], "b_")
        done = done.union(bands.where(F.col("d_") <= SMALL))
    found = _picked(within(done), keys, [*keys, "lo_"], ranks, F.col("low_"))
    found = wide.join(found.drop("n_"), _same(keys, "_w_"), "left").select(*[F.col(f"{c}_w_").alias(c) for c in keys], "n_", *ranks)
    return _picked(few.withColumn("n_", all_), keys, keys, ranks, F.lit(0)).unionByName(found)


def nth_quartiles(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """E-18: q1 and q3 as elements int(n/4) and int(3n/4), counted from 1; null where that is 0."""
    rank = lambda p: F.floor(F.col("n_") * p)
    found = _at_ranks(df, keys, value, {"a_": rank(0.25) - 1, "b_": rank(0.75) - 1})
    return found.select(*keys, F.when(rank(0.25) > 0, F.col("a_")).alias("q1"), F.when(rank(0.75) > 0, F.col("b_")).alias("q3"))


def quartiles(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """E-19: interpolated q1 and q3."""
    at = lambda p: (F.col("n_") - 1) * p
    found = _at_ranks(df, keys, value, {f"{n}{i}_": f(at(p)) for n, p in (("a", 0.25), ("b", 0.75)) for i, f in enumerate((F.floor, F.ceil))})
    between = lambda n, p: F.col(f"{n}0_") + (F.col(f"{n}1_") - F.col(f"{n}0_")) * (at(p) - F.floor(at(p)))
    return found.select(*keys, between("a", 0.25).alias("q1"), between("b", 0.75).alias("q3"))


def fenced(df: DataFrame, keys: list[str], value: str, k: float = 1.5, nth: bool = False) -> DataFrame:
    """E-20: rows with in_fence: q1 - k iqr <= value <= q3 + k iqr."""
    q = nth_quartiles(df, keys, value) if nth else quartiles(df, keys, value)
    iqr = F.col("q3") - F.col("q1")
    return df.join(q, keys).withColumn("in_fence", (F.col(value) >= F.col("q1") - k * iqr) & (F.col(value) <= F.col("q3") + k * iqr))


def core_contigs(depths: DataFrame, k: float = 1.5) -> DataFrame:
    """E-21: (bin_id, contig_id) inside the fence in every sample."""
    return fenced(depths, ["bin_id", "sample_idx"], "depth", k).groupBy("bin_id", "contig_id").agg(F.bool_and("in_fence").alias("core")).where("core").select("bin_id", "contig_id")


def core_depth(depths: DataFrame, core: DataFrame) -> DataFrame:
    """E-22: mean depth of core contigs by bin and sample; a bin without any has 0."""
    inside = depths.join(core, ["bin_id", "contig_id"], "left_semi").groupBy("bin_id", "sample_idx").agg(F.avg("depth").alias("d"))
    return depths.select("bin_id", "sample_idx").distinct().join(inside, ["bin_id", "sample_idx"], "left").select("bin_id", "sample_idx", F.coalesce("d", F.lit(0.0)).alias("depth"))


def depth_ratio(pairs: DataFrame) -> DataFrame:
    """E-23: by (bin1, bin2, sample_idx), mean depth1 over mean depth2, whose 0 counts as 1."""
    g = pairs.groupBy("bin1", "bin2", "sample_idx").agg(F.avg("depth1").alias("a"), F.avg("depth2").alias("b"))
    return g.select("bin1", "bin2", "sample_idx", (F.col("a") / F.when(F.col("b") == 0, 1.0).otherwise(F.col("b"))).alias("ratio"))


def mean_ratio(pairs: DataFrame, length: int = 1000, share: float = 0.5) -> DataFrame:
    """E-24: mean of depth1/depth2 over strong alignments, zero divisors left out, 0 without any."""
    ok = (F.col("length") >= length) & ((F.col("length") / F.col("len1") >= share) | (F.col("length") / F.col("len2") >= share)) & (F.col("depth2") != 0)
    return pairs.groupBy("bin1", "bin2", "sample_idx").agg(F.coalesce(F.avg(F.when(ok, F.try_divide("depth1", "depth2"))), F.lit(0.0)).alias("ratio"))


def vote(pairs: DataFrame, most: float = 10) -> DataFrame:
    """E-25: (bin1, bin2, alike): |d1-d2|/(d1+d2) within ``most`` per cent in every sample."""
    return pairs.groupBy("bin1", "bin2").agg(F.bool_and(pct_sum("depth1", "depth2") <= most).alias("alike"))


def veto(pairs: DataFrame, most: float = 20) -> DataFrame:
    """E-26: (bin1, bin2) without a sample that differs by more than ``most`` per cent of the mean."""
    return pairs.groupBy("bin1", "bin2").agg(F.bool_or(pct_avg("depth1", "depth2") > most).alias("off")).where("not off").select("bin1", "bin2")


def confirmed_clean(depths: DataFrame, k: float = 1.0, most: float = 30) -> DataFrame:
    """E-27: (bin_id, contig_id, clean): near the bin's mean or inside the k-fence in every sample; mean 0 passes."""
    mean = depths.groupBy("bin_id", "sample_idx").agg(F.avg("depth").alias("mean"))
    f = fenced(depths, ["bin_id", "sample_idx"], "depth", k).join(mean, ["bin_id", "sample_idx"])
    ok = (F.col("mean") == 0) | F.coalesce(pct_ref("depth", "mean") < most, F.lit(False)) | F.col("in_fence")
    return f.groupBy("bin_id", "contig_id").agg(F.bool_and(ok).alias("clean"))


def first_ratios(depth: DataFrame) -> DataFrame:
    """E-28: depth over the depth in sample 1, the depth itself where that is 0."""
    one = F.max(F.when(F.col("sample_idx") == 1, F.col("depth"))).over(Window.partitionBy("contig_id"))
    return depth.withColumn("one_", F.coalesce(one, F.lit(0.0))).select("contig_id", "sample_idx", F.when(F.col("one_") == 0, F.col("depth")).otherwise(F.try_divide("depth", "one_")).alias("ratio"))


def merged_extent(hits: DataFrame, least: float = 95) -> DataFrame:
    """E-29: (query, subject, pct, band, kept): aligned bases over the extent from first to last."""
    lo, hi = F.min(F.least("qstart", "qend")) - 1, F.max(F.greatest("qstart", "qend"))
    g = hits.groupBy("query", "subject").agg(F.sum("length").alias("n"), (hi - lo).alias("extent")).withColumn("pct", F.try_divide(100.0 * F.col("n"), F.col("extent")))
    band = F.when(F.col("pct") >= 90, "90-100").when(F.col("pct") >= 80, "80-90").when(F.col("pct") >= 70, "70-80").when(F.col("pct") >= 60, "60-70").otherwise("<60")
    return g.select("query", "subject", "pct", band.alias("band"), (F.col("pct") >= least).alias("kept"))


def end_degrees(hits: DataFrame) -> DataFrame:
    """E-30: (contig, at_start, at_end, straight) of hits (contig, end)."""
    g = hits.groupBy("contig").agg(F.count_if(F.col("end") == "s").alias("at_start"), F.count_if(F.col("end") == "e").alias("at_end"))
    return g.withColumn("straight", (F.col("at_start") == 1) & (F.col("at_end") == 1))


def sequence_classes(contigs: DataFrame) -> DataFrame:
    """E-31: (contig_id, first, copies): the smallest id of equal sequences and their number.

    Digests of 256 bits, written once, stand for sequences; those that many contigs share meet them by broadcast.
    """
    from contigra.operators.graph import cut

    own = cut(contigs.select("contig_id", F.sha2("seq", 256).alias("digest")))
    classes = own.groupBy("digest").agg(F.min("contig_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    return join_heavy(own, classes, ["digest"], "copies", own.count()).select("contig_id", "first", "copies")


def majority(votes: DataFrame, keys: list[str], models: int, mode: int = 2) -> DataFrame:
    """E-32: positive if the votes exceed models // 2 - mode."""
    return votes.groupBy(*keys).agg((F.sum("vote") > models // 2 - mode).alias("positive"))


def normalised(df: DataFrame, keys: list[str], value: str, how: str = "absmmn") -> Column | DataFrame:
    """E-34: ``mmn``: (x - min) / (max - min); ``absmmn``: |x - mean| over its maximum; by group."""
    g = df.groupBy(*keys).agg(F.min(value).alias("lo_"), F.max(value).alias("hi_"), F.avg(value).alias("mean_"))
    j = df.join(g, keys)
    if how == "mmn":
        return j.withColumn("scaled", (F.col(value) - F.col("lo_")) / (F.col("hi_") - F.col("lo_") + 1e-8)).drop("lo_", "hi_", "mean_")
    far = F.greatest(F.col("hi_") - F.col("mean_"), F.col("mean_") - F.col("lo_"))
    return j.withColumn("scaled", F.abs(F.col(value) - F.col("mean_")) / (far + 1e-8)).drop("lo_", "hi_", "mean_")


def remapped_depth(depth: DataFrame) -> DataFrame:
    """E-36: mean depth by the text before the first pipe, and sample."""
    return depth.groupBy(F.substring_index("contig_id", "|", 1).alias("bin_id"), "sample_idx").agg(F.avg("depth").alias("depth"))


def best_reads(hits: DataFrame) -> DataFrame:
    """E-37: of reads that reach the same contigs, the one of the greatest total score (then the smallest id).

    Number and sums of two hashes stand for a read's contigs, so none are collected.
    """
    h = lambda s: F.sum(F.xxhash64(F.lit(s), "contig_id").cast("decimal(38,0)"))
    r = hits.groupBy("read_id").agg(F.count(F.lit(1)).alias("n_"), h(1).alias("h1_"), h(2).alias("h2_"), F.sum("score").alias("score"))
    return r.groupBy("n_", "h1_", "h2_").agg(F.min_by("read_id", F.struct(-F.col("score"), F.col("read_id"))).alias("read_id")).select("read_id")


def bin_average(members: DataFrame, matrix: DataFrame) -> DataFrame:
    """E-8: (bin_id, average): the unweighted mean of the contigs' average depths."""
    return members.join(matrix.select("contig_id", "average"), "contig_id").groupBy("bin_id").agg(F.avg("average").alias("average"))


def reciprocal_percent(pairs: DataFrame) -> DataFrame:
    """E-12: pct2 of pairs (pct1, size1, size2): the share of bin2 that pct1 of bin1 makes."""
    return pairs.withColumn("pct2", F.round(F.col("pct1") * F.col("size1") / F.col("size2"), 2))


def grouped_sets(df: DataFrame, keys: list[str], value: str, how: str = "cube") -> DataFrame:
    """E-35: distinct values and rows by all (``cube``) or leading (``rollup``) subsets of ``keys``; ``level`` tells which."""
    grouped = df.cube(*keys) if how == "cube" else df.rollup(*keys)
    return grouped.agg(F.grouping_id().cast("long").alias("level"), F.countDistinct(value).alias("distinct"), F.count(F.lit(1)).alias("rows"))
