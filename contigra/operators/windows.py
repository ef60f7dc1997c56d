"""F-w1 to F-w12: rankings.  Groups with an argmax aggregate before they shuffle; windows are left to what needs order."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_hits(scores: DataFrame) -> DataFrame:
    """F-w1: the best bin2 of each bin1 by pct1, then name: an aggregate, so each task sends one row a bin."""
    best = F.min(F.struct(-F.col("pct1"), F.col("bin2"), F.col("pct2"))).alias("b")
    return scores.groupBy("bin1").agg(best).select("bin1", F.col("b.bin2").alias("bin2"), (-F.col("b.col1")).alias("pct1"), F.col("b.pct2").alias("pct2"))


def accepted(best: DataFrame) -> DataFrame:
    """F-w2."""
    return best.where((F.col("pct1") + F.col("pct2") >= 100) | (F.col("pct1") >= 50) | (F.col("pct2") >= 50))


def numbered(df: DataFrame, order: list[Column], name: str = "n") -> DataFrame:
    """F-w3: a gapless number in a total order: rows are sorted by range, and each partition starts where those before it end."""
    from contigra.operators.graph import cut

    held = cut(df.repartitionByRange(*order).withColumn("p_", F.spark_partition_id()))
    before, starts = 0, []
    for r in sorted(held.groupBy("p_").count().collect()):  # one row a partition
        starts.append((r["p_"], before))
        before += r["count"]
    own = F.row_number().over(Window.partitionBy("p_").orderBy(*order))
    small = F.broadcast(df.sparkSession.createDataFrame(starts, "p_ int, before_ long"))
    return held.withColumn("n_", own).join(small, "p_").select(*df.columns, (F.col("n_") + F.col("before_")).alias(name))


def numbered_within(df: DataFrame, group: list[str], order: list[str], name: str = "n", deal: list[str] | None = None) -> DataFrame:
    """Gapless numbers by group in the order of ``order``, however many rows one group has.

    Rows are dealt by range of group and order, numbered within each range, and moved on by the rows that the group has in the
    ranges before.  ``deal``: columns that rise with the order, to deal by where those of the order are long.
    """
    from contigra.operators.graph import cut

    held = cut(df.repartitionByRange(*group, *(deal or order)).withColumn("p_", F.spark_partition_id()))
    rows = held.groupBy("p_", *group).agg(F.count(F.lit(1)).alias("rows_"))
    before = F.sum("rows_").over(Window.partitionBy(*group).orderBy("p_").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.select(F.col("p_").alias("q_"), *[F.col(c).alias(f"{c}_") for c in group], F.coalesce(before, F.lit(0)).alias("before_"))
    own = held.withColumn("n_", F.row_number().over(Window.partitionBy("p_", *group).orderBy(*order)))
    same = F.col("p_") == F.col("q_")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_"))
    return own.join(rows, same).select(*df.columns, (F.col("n_") + F.col("before_")).alias(name))


def prefix_max(df: DataFrame, group: list[str], order: list[str], value: str, name: str = "before") -> DataFrame:
    """``df`` with the greatest ``value`` of the rows before each in its group (null for the first), however many rows one group has.

    Rows are dealt by range of group and order; each range has the greatest of its own earlier rows, and of the ranges before it one
    number a range is carried in.
    """
    from contigra.operators.graph import cut

    held = cut(df.repartitionByRange(*group, *order).withColumn("p_", F.spark_partition_id()))
    most = held.groupBy("p_", *group).agg(F.max(value).alias("m_"))
    upto = Window.partitionBy(*group).orderBy("p_").rowsBetween(Window.unboundedPreceding, -1)
    carried = most.select(F.col("p_").alias("q_"), *[F.col(c).alias(f"{c}_of_") for c in group], F.max("m_").over(upto).alias("carried_"))
    within = Window.partitionBy("p_", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("p_") == F.col("q_")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_of_"))
    return held.withColumn("own_", F.max(value).over(within)).join(carried, same).select(*df.columns, F.greatest("own_", "carried_").alias(name))


def islands(df: DataFrame, group: list[str], start: str, end: str, order: list[str], name: str = "island") -> DataFrame:
    """``df`` with the start of the run of overlapping intervals that each lies in; no interval of one run meets one of another."""
    far = prefix_max(df, group, [start, *order], end, "reach_")
    begins = F.when(F.col("reach_").isNull() | (F.col(start) > F.col("reach_")), F.col(start))
    near = prefix_max(far.withColumn("begins_", begins), group, [start, *order], "begins_", "last_")
    return near.select(*df.columns, F.greatest("begins_", "last_").alias(name))


def _held(df: DataFrame) -> DataFrame:
    from contigra.operators.graph import cut

    return cut(df)


def _sized(rows: DataFrame, all_: DataFrame) -> DataFrame:
    """``rows`` with k_, the rows that their bin has in ``all_``."""
    sizes = all_.groupBy(F.col("bin_id").alias("b_")).agg(F.count(F.lit(1)).alias("k_"))
    return rows.join(sizes, F.col("bin_id").eqNullSafe(F.col("b_")))


def top_neighbours(near: DataFrame, most: int = 20) -> DataFrame:
    """F-w4: all of ``most`` or fewer; else those of the ``most`` - 1 highest values, ties included.

    A group of ``most`` rows has no rank beyond that, so ranks are cut there first, which tasks do before they shuffle.  What is ranked is
    written once, since the sizes of all groups are counted beside it.
    """
    near = _held(near)
    ranked = near.withColumn("r_", F.rank().over(Window.partitionBy("bin_id").orderBy(F.desc("connections")))).where(F.col("r_") <= most)
    return _sized(ranked, near).where((F.col("k_") <= most) | (F.col("r_") <= most - 1)).select(*near.columns)


def third_largest(near: DataFrame, value: str = "support", n: int = 8) -> DataFrame:
    """F-w5: in groups of ``n`` and more, rows not below the third value; three rows a group and task meet to find it."""
    near = _held(near)
    top = near.select(F.col("bin_id").alias("c_"), F.col(value).alias("t_"))
    third = top.withColumn("r_", F.row_number().over(Window.partitionBy("c_").orderBy(F.desc("t_")))).where("r_ <= 3").where("r_ = 3")
    found = _sized(near, near).join(third, F.col("bin_id").eqNullSafe(F.col("c_")), "left")
    return found.where((F.col("k_") < n) | (F.col(value) >= F.col("t_"))).select(*near.columns)


def running_records(df: DataFrame, key: str, value: str, order: str, least: float = 50) -> DataFrame:
    """F-w6 and F-w7: rows of ``least`` and more that exceed all earlier ones of their group (by ``prefix_max``)."""
    seen = prefix_max(df, [key], [order], value, "b_")
    return seen.where((F.col(value) >= least) & (F.col("b_").isNull() | (F.col(value) > F.col("b_")))).drop("b_")


def best_by(df: DataFrame, keys: list[str], score: str, order: str) -> DataFrame:
    """F-w8: the row of the greatest score, the first of equal ones, by group."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(F.col(score), -F.col(order))).alias("r_")).select(*keys, "r_.*")


def first_row(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """F-w9: the first row of each group in file order."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("r_")).select(*keys, "r_.*")


def last_by(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """F-w10: ``columns`` of the last row, by ``order``, of each group (of all rows without keys)."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("r_")).select(*keys, "r_.*")


def ordered(df: DataFrame, *order: Column | str) -> DataFrame:
    """F-w11."""
    return df.orderBy(*order)


def has_rows(df: DataFrame, k: int) -> bool:
    """F-w12: whether there are ``k`` rows; each task stops reading at ``k``, and sends a number."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            n += batch.num_rows
            if n >= k:
                break
        yield pa.RecordBatch.from_arrays([pa.array([n])], names=["n"])

    return (df.select(F.lit(1).alias("one")).mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0) >= k
