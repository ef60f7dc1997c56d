"""D-1 to D-22: joins.  Keys are ids; sequences stay out until the end; the planner picks the strategy."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contigra.functions.scalar import kmers, pct_avg


HEAVY = 10_000
#: Rows of the input, before they meet, that one task of a large shuffle has.
EACH = 250_000


def tasks(spark: SparkSession, rows: int) -> int | None:
    """Over how many tasks shuffles of what ``rows`` rows of input become are dealt; None: Spark's own number is enough.

    Spark merges small partitions but splits none, so with its fixed number a task's sorts and hash tables grow with the input.
    """
    n = math.ceil(rows / EACH)
    return n if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def over(df: DataFrame, n: int | None, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over ``n`` tasks; joins and groups by these keys follow without a shuffle of their own."""
    return df.repartition(n, *keys) if n else df


def join_heavy(rows: DataFrame, table: DataFrame, on: list[str], weight: str, total: int) -> DataFrame:
    """Left join of ``rows`` with ``table`` (one row a key, ``weight`` says how many rows have it), without a hot task.

    Keys of more than total / HEAVY rows are HEAVY at most, since their rows add up to ``total``: they are broadcast.  The other
    rows meet their keys in a shuffle, in which none has more than that share.
    """
    most = max(1000, total // HEAVY)
    heavy = table.where(F.col(weight) > most).withColumn("heavy_", F.lit(True))
    first = rows.join(F.broadcast(heavy), on, "left")
    light = first.where("heavy_ is null").select(*rows.columns).join(table.where(F.col(weight) <= most), on, "left")
    return first.where("heavy_").select(*light.columns).unionByName(light)


def join_grid(a: DataFrame, b: DataFrame, on: list[str], how_many: int = HEAVY, n: int | None = None) -> DataFrame:
    """Inner join of many with many in which no key is one task's work.

    A key that only ``a`` has often is split by the adaptive skew join, since each of its rows meets few.  Keys that ``b`` has more than
    rows / ``how_many`` times (1,000 at least) are ``how_many`` at most, and as many again of ``a``; these keys, with no more of their rows
    than two numbers, are broadcast.  Such a key is a grid: each row of ``a`` is in one of its rows of cells, each row of ``b`` in one of its
    columns, and every cell is a join key of its own with about that many rows of each side.  Rows are dealt by their hash, so that a task that
    is run again deals them alike; repeated rows share a cell.  ``b`` is counted first, so it should be the one that is cheaper to read.
    Cells are dealt over ``n`` tasks; without a grid, rows stay as the caller dealt them.
    """

    def wide(df: DataFrame, name: str) -> DataFrame:
        c = df.groupBy(*on).agg(F.count(F.lit(1)).alias("n_"))
        most = max(1000, (c.agg(F.sum("n_")).first()[0] or 0) // how_many)
        return c.where(F.col("n_") > most).select(*on, F.ceil(F.col("n_") / most).cast("int").alias(name))

    columns = wide(b, "columns_")
    if columns.isEmpty():
        return a.join(b, on)
    heavy = wide(a, "rows_").join(columns, on, "full_outer")
    heavy = F.broadcast(heavy.select(*on, F.coalesce("rows_", F.lit(1)).alias("rows_"), F.coalesce("columns_", F.lit(1)).alias("columns_")))
    one = F.lit(1)

    def dealt(df: DataFrame, own: str, other: str, mine: str, all_: str) -> DataFrame:
        row = F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind])
        df = df.join(heavy, on, "left").withColumn(mine, F.pmod(row, F.coalesce(own, one)).cast("int"))
        return df.withColumn(all_, F.explode(F.sequence(F.lit(0), F.coalesce(other, one) - 1))).drop("rows_", "columns_")

    cells = over(dealt(a, "rows_", "columns_", "x_", "y_"), n, *on, "x_", "y_")
    return cells.join(dealt(b, "columns_", "rows_", "y_", "x_"), [*on, "x_", "y_"]).drop("x_", "y_")


def overlapping(a: DataFrame, b: DataFrame, on: list[str], ends_a: tuple[str, str], ends_b: tuple[str, str]) -> DataFrame:
    """D-21: pairs of rows of equal ``on`` whose closed intervals of whole numbers overlap, each once, by one equi join.

    An interval of length n lies in two bins at most of the least power of two that is not below n.  Two intervals meet in bins of the
    greater of both sizes: each row stands there for its own size and for every greater one that the other side has (64 at most).  Of the bins that
    a pair shares only that of the later start counts.  Intervals that end before they start, and nulls, meet nothing.  Rows of ``a`` beside
    all that ``b`` has under their key are left out first.
    """
    span = b.where(F.col(ends_b[0]) <= F.col(ends_b[1])).groupBy(*on).agg(F.min(ends_b[0]).alias("least_"), F.max(ends_b[1]).alias("most_"))
    a = a.join(span, on).where((F.col(ends_a[0]) <= F.col("most_")) & (F.col(ends_a[1]) >= F.col("least_"))).drop("least_", "most_")
    level = lambda lo, hi: F.greatest(F.lit(0), F.ceil(F.log2(F.col(hi) - F.col(lo) + 1))).cast("int")
    a, b = (df.where(F.col(lo) <= F.col(hi)).withColumn(name, level(lo, hi)) for df, (lo, hi), name in ((a, ends_a, "la_"), (b, ends_b, "lb_")))
    sizes = sorted({r[0] for df, name in ((a, "la_"), (b, "lb_")) for r in df.select(name).distinct().collect()})  # 64 at most

    def binned(df: DataFrame, lo: str, hi: str, name: str) -> DataFrame:
        greater = F.filter(F.array(*map(F.lit, sizes)), lambda x: x >= F.col(name))
        df = df.withColumn("level_", F.explode(greater))
        at = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("level_"))).cast("long")
        return df.withColumn("bin_", F.explode(F.sequence(at(lo), at(hi))))

    pairs = binned(a, *ends_a, "la_").join(binned(b, *ends_b, "lb_"), [*on, "level_", "bin_"])
    later = F.greatest(F.col(ends_a[0]), F.col(ends_b[0]))
    both = (F.col(ends_a[0]) <= F.col(ends_b[1])) & (F.col(ends_b[0]) <= F.col(ends_a[1]))
    met = (F.col("level_") == F.greatest("la_", "lb_")) & (F.col("bin_") == F.floor(later / F.pow(F.lit(2.0), F.col("level_"))).cast("long"))
    return pairs.where(met & both).drop("la_", "lb_", "level_", "bin_")


def with_coverage(members: DataFrame, depth: DataFrame) -> DataFrame:
    """D-1: members with the depths of their contigs."""
    return members.join(depth, "contig_id")


def contig_bins(contigs: DataFrame, members: DataFrame) -> DataFrame:
    """D-2: contigs with each bin that holds them, once."""
    return contigs.join(members.select("contig_id", "bin_id").distinct(), "contig_id")


def bin_connections(edges: DataFrame, members: DataFrame, one_bin: bool = False, n: int | None = None) -> DataFrame:
    """D-3: (bin1, bin2, connections) of edges whose ends lie in different bins; ``one_bin``: a contig is in its last bin only; ``n``: see ``tasks``."""
    m = members.groupBy("contig_id").agg(F.max("bin_id").alias("bin_id")) if one_bin else members.select("contig_id", "bin_id").distinct()
    one = m.select(F.col("contig_id").alias("node1"), F.col("bin_id").alias("bin1"))
    two = m.select(F.col("contig_id").alias("node2"), F.col("bin_id").alias("bin2"))
    e = edges.groupBy("node1", "node2").agg(F.sum("connections").alias("connections"))
    both = join_grid(over(join_grid(over(e, n, "node1"), one, ["node1"], n=n), n, "node2"), two, ["node2"], n=n)
    return both.where("bin1 <> bin2").groupBy("bin1", "bin2").agg(F.sum("connections").alias("connections"))


def shared(a: DataFrame, b: DataFrame) -> DataFrame:
    """D-4: (bin1, bin2, shared) bases of contigs (bin_id, contig_id, length) in both sets, pre-aggregated by contig key."""
    one = a.select(F.col("bin_id").alias("bin1"), "contig_id", "length")
    two = b.select(F.col("bin_id").alias("bin2"), "contig_id")
    return one.join(two, "contig_id").groupBy("bin1", "bin2").agg(F.sum("length").alias("shared"))


def shared_within(members: DataFrame) -> DataFrame:
    """D-5: unordered pairs of bins of one set that share contigs."""
    return shared(members, members).where("bin1 < bin2")


def similar_coverage(profiles: DataFrame, low: float = 10, most: float = 100) -> DataFrame:
    """D-6: pairs (bin1 < bin2) of profiles (bin_id, sample_idx, depth) that agree in every sample that both have.

    Agreement is either depth at ``low`` or below, or a difference of ``most`` per cent of the mean (below 200).  Samples without a depth
    count as missing; profiles without a sample in common make no pair.

    Depths above ``low`` that agree lie in the same or neighbouring bands of a log grid, so profiles that are both above ``low`` somewhere meet by
    band in the first such sample.  Where two are nowhere both above ``low`` they agree whatever their depths are: that is found once for each two
    sets of samples, held and above ``low``, and every two profiles of such sets are a result.  No pair is met twice.
    """
    from contigra.operators.graph import cut

    one = profiles.where("depth is not null").groupBy("bin_id").agg(F.map_from_entries(F.collect_list(F.struct("sample_idx", "depth"))).alias("m"))
    above = F.map_keys(F.map_filter("m", lambda _, d: d > low))
    one = cut(one.select("bin_id", "m", F.array_sort(F.map_keys("m")).alias("held"), F.array_sort(above).alias("high")))
    first = lambda c, d: F.try_element_at(F.array_intersect(c, d), F.lit(1))  # noqa: E731  (both are sorted)

    width = math.log((200 + most) / (200 - most)) * (1 + 1e-9)
    at = one.select("bin_id", "m", "high", F.explode("high").alias("s")).withColumn("band", F.floor(F.log(F.try_element_at("m", "s")) / width))
    a = at.select(F.col("bin_id").alias("bin1"), F.col("m").alias("m1"), F.col("high").alias("high1"), "s", "band")
    near = F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1))
    b = at.select(F.col("bin_id").alias("bin2"), F.col("m").alias("m2"), F.col("high").alias("high2"), "s", near.alias("band"))
    agree = F.forall(F.array_intersect("high1", "high2"), lambda s: pct_avg(F.try_element_at("m1", s), F.try_element_at("m2", s)) <= most)
    met = join_grid(a, b, ["s", "band"]).where("bin1 < bin2").where((first("high1", "high2") == F.col("s")) & agree).select("bin1", "bin2")

    kinds = cut(one.select("held", "high").distinct())
    sample = kinds.select("held", "high", F.explode("held").alias("s")).withColumn("low_", ~F.array_contains("high", F.col("s")))
    x, y = (sample.select(F.col("held").alias(f"held{i}"), F.col("high").alias(f"high{i}"), "s", F.col("low_").alias(f"low{i}")) for i in (1, 2))
    free = (F.size(F.array_intersect("high1", "high2")) == 0) & (first("held1", "held2") == F.col("s"))
    kinds2 = join_grid(x, y, ["s"]).where("low1 or low2").where(free).select("held1", "high1", "held2", "high2")
    own = one.select(F.col("bin_id").alias("bin1"), F.col("held").alias("held1"), F.col("high").alias("high1"))
    other = one.select(F.col("bin_id").alias("bin2"), F.col("held").alias("held2"), F.col("high").alias("high2"))
    apart = join_grid(own.join(cut(kinds2), ["held1", "high1"]), other, ["held2", "high2"]).where("bin1 < bin2").select("bin1", "bin2")
    return met.union(apart)


def similar_gc(pairs: DataFrame, gc: DataFrame, most: float = 5) -> DataFrame:
    """D-7: pairs whose GC differs by ``most`` per cent of the first at most."""
    g = gc.select("bin_id", "gc")
    j = pairs.join(g.toDF("bin1", "gc1"), "bin1").join(g.toDF("bin2", "gc2"), "bin2")
    return j.where(F.try_divide(100 * F.abs(F.col("gc2") - F.col("gc1")), F.col("gc1")) <= most)


def hit_bins(hits: DataFrame, members: DataFrame, n: int | None = None) -> DataFrame:
    """D-8: (bin1 < bin2, aligned) of hits pre-aggregated by contig pair, each hit once a pair of bins; ``n``: see ``tasks``."""
    aligned = hits.select("query", "subject", (F.col("length") * F.col("identity") / 100).alias("aligned"))
    pairs = over(aligned, n, "query", "subject").groupBy("query", "subject").agg(F.sum("aligned").alias("aligned"))
    m = members.select("contig_id", "bin_id").distinct()
    j = over(over(pairs, n, "query").join(m.toDF("query", "x"), "query"), n, "subject").join(m.toDF("subject", "y"), "subject").where("x <> y")
    sides = j.select("query", "subject", "aligned", F.least("x", "y").alias("bin1"), F.greatest("x", "y").alias("bin2"))  # still dealt by subject
    return sides.dropDuplicates(["query", "subject", "bin1", "bin2"]).groupBy("bin1", "bin2").agg(F.sum("aligned").alias("aligned"))


def members_of(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """D-9 and D-22: semi join."""
    return df.join(keys, on, "left_semi")


def without(df: DataFrame, black: DataFrame, on: str | list[str]) -> DataFrame:
    """D-10: anti join against a black list."""
    return df.join(black, on, "left_anti")


def neighbours(members: DataFrame, edges: DataFrame, n: int | None = None) -> DataFrame:
    """D-11: (bin_id, contig_id, connections): contigs next to a bin's own that are not its own; ``n``: see ``tasks``."""
    n = n and 2 * n  # every edge is there in both directions
    both = edges.select("node1", "node2", "connections").union(edges.select("node2", "node1", "connections"))
    near = over(both, n, "node1").join(members.select("bin_id", F.col("contig_id").alias("node1")), "node1").select("bin_id", F.col("node2").alias("contig_id"), "connections")
    near = over(near, n, "bin_id", "contig_id").groupBy("bin_id", "contig_id").agg(F.sum("connections").alias("connections"))
    return near.join(members.select("bin_id", "contig_id"), ["bin_id", "contig_id"], "left_anti")


def read_neighbours(members: DataFrame, reads: DataFrame, n: int | None = None) -> DataFrame:
    """D-12: (bin_id, contig_id, support) of reads (read_id, contig_id) that reach a bin and a contig outside it; ``n``: see ``tasks``."""
    reads = reads.select("read_id", "contig_id")
    own = over(over(reads, n, "contig_id").join(members.select("bin_id", "contig_id"), "contig_id").select("bin_id", "read_id"), n, "read_id").groupBy("bin_id", "read_id").agg(F.count(F.lit(1)).alias("w"))
    hits = over(reads, n, "read_id").groupBy("read_id", "contig_id").agg(F.count(F.lit(1)).alias("times"))  # repeated rows would share a cell
    far = join_grid(own, hits, ["read_id"], n=n).select("bin_id", "contig_id", "w", "times")
    far = over(far, n and 2 * n, "bin_id", "contig_id").groupBy("bin_id", "contig_id").agg(F.sum(F.col("w") * F.col("times")).alias("support"))
    return far.join(members.select("bin_id", "contig_id"), ["bin_id", "contig_id"], "left_anti")


def paired(reads: DataFrame) -> DataFrame:
    """D-13: rows (bin_id, read_id, mate) of reads of which both mates lie in the bin."""
    both = reads.groupBy("bin_id", "read_id").agg(F.countDistinct("mate").alias("n")).where("n = 2").select("bin_id", "read_id")
    return reads.join(both, ["bin_id", "read_id"], "left_semi")


def mate_edges(ends: DataFrame) -> DataFrame:
    """D-14: (node1, node2) of the first two ends (read_id, ordinal, contig_id) of each read; tasks send two rows a read at most."""
    first = ends.withColumn("r_", F.row_number().over(Window.partitionBy("read_id").orderBy("ordinal", "contig_id"))).where("r_ <= 2")
    return first.groupBy("read_id").agg(F.min_by("contig_id", "r_").alias("node1"), F.max_by("contig_id", "r_").alias("node2"), F.count(F.lit(1)).alias("n")).where("n = 2").select("node1", "node2")


def evidence_levels(short: DataFrame, long: DataFrame) -> DataFrame:
    """D-15: (bin_id, contig_id, level): 1 both kinds of reads, 2 short only, 3 long only; bins of one kind keep 1."""
    s, n = short.select("bin_id", "contig_id", F.lit(True).alias("s")).distinct(), long.select("bin_id", "contig_id", F.lit(True).alias("l")).distinct()
    both = short.select("bin_id").distinct().join(long.select("bin_id").distinct(), "bin_id").withColumn("two", F.lit(True))
    level = F.when(F.col("two").isNull() | (F.col("s") & F.col("l")), 1).when(F.col("s"), 2).otherwise(3)
    return s.join(n, ["bin_id", "contig_id"], "full_outer").join(both, "bin_id", "left").select("bin_id", "contig_id", level.alias("level"))


def overridden(first: DataFrame, later: DataFrame, key: str) -> DataFrame:
    """D-16: the union in which rows of ``later`` win by key."""
    return later.unionByName(first.join(later.select(key), key, "left_anti"))


def pair_quality(pairs: DataFrame, quality: DataFrame) -> DataFrame:
    """D-17: pairs (bin1, bin2) with the quality of both."""
    q = quality.select("bin_id", "completeness", "contamination", "genome_size", "n50")
    return pairs.join(q.toDF("bin1", "cpn1", "ctn1", "size1", "n50_1"), "bin1").join(q.toDF("bin2", "cpn2", "ctn2", "size2", "n50_2"), "bin2")


def with_original(new: DataFrame, old: DataFrame) -> DataFrame:
    """D-18: new quality beside that of the bin it came from, told by its name."""
    origin = F.regexp_replace("bin_id", r"(\.retrieved|_deep_|_RT-D).*$", "")
    o = old.select(F.col("bin_id").alias("origin"), F.col("completeness").alias("cpn0"), F.col("contamination").alias("ctn0"))
    return new.withColumn("origin", origin).join(o, "origin")


def kmer_hits(queries: DataFrame, subjects: DataFrame, k: int = 21, least: int = 5) -> DataFrame:
    """D-19: (query, subject, seeds): sequences (id, seq) that share ``least`` distinct k-mers, by an equi join on their hashes.

    An approximation of a similarity join; k-mers of a sequence are distinct, so no pair is counted twice.
    """

    def seeds(df: DataFrame, name: str) -> DataFrame:
        found = F.transform(kmers("seq", k, "."), lambda x: F.xxhash64(x))
        return df.select(F.col("id").alias(name), F.explode(F.array_distinct(found)).alias("kmer"))

    return seeds(queries, "query").join(seeds(subjects, "subject"), "kmer").groupBy("query", "subject").agg(F.count(F.lit(1)).alias("seeds")).where(F.col("seeds") >= least)


def contained(queries: DataFrame, subjects: DataFrame, k: int = 21) -> DataFrame:
    """D-19: exact containment: candidates share the query's first k-mer, then ``contains`` decides."""
    q = queries.where(F.length("seq") >= k).select(F.col("id").alias("query"), F.col("seq").alias("qseq"), F.xxhash64(F.substring("seq", 1, k)).alias("kmer"))
    s = subjects.withColumn("kmer", F.explode(F.array_distinct(F.transform(kmers("seq", k, "."), lambda x: F.xxhash64(x)))))
    return q.join(s.select(F.col("id").alias("subject"), F.col("seq").alias("sseq"), "kmer"), "kmer").where(F.col("sseq").contains(F.col("qseq"))).select("query", "subject")
