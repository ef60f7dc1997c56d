"""H-1 to H-7: set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union(*parts: DataFrame) -> DataFrame:
    """H-1 and H-6."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def excepted(df: DataFrame, other: DataFrame, on: str | list[str]) -> DataFrame:
    """H-2."""
    return df.join(other, on, "left_anti")


def in_both(df: DataFrame, other: DataFrame, on: str | list[str]) -> DataFrame:
    """H-3."""
    return df.join(other, on, "left_semi")


def unordered(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """H-4: one row a pair, smaller end first."""
    return pairs.select(F.least(a, b).alias(a), F.greatest(a, b).alias(b)).distinct()


def _signature(members: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Number and sum of two hashes of the distinct members: sets meet without being collected."""
    m = members.select(key, *values).distinct()
    h = lambda s: F.sum(F.xxhash64(F.lit(s), *values).cast("decimal(38,0)"))
    return m.groupBy(key).agg(F.count(F.lit(1)).alias("n_"), h(1).alias("h1_"), h(2).alias("h2_"))


def distinct_sets(members: DataFrame, key: str, values: list[str]) -> DataFrame:
    """H-5: the first key (by name) of each distinct member set."""
    return _signature(members, key, values).groupBy("n_", "h1_", "h2_").agg(F.min(key).alias(key)).select(key)


def changed_variants(members: DataFrame, values: list[str]) -> DataFrame:
    """H-7: (bin_id, variant) that differ from the variant after them; members have bin_id, variant."""
    from pyspark.sql import Window

    m = members.withColumn("k_", F.struct("bin_id", "variant"))
    s = _signature(m, "k_", values).select("k_.*", F.struct("n_", "h1_", "h2_").alias("s_"))
    after = F.lead("s_").over(Window.partitionBy("bin_id").orderBy("variant"))
    return s.withColumn("a_", after).where(~F.col("s_").eqNullSafe(F.col("a_"))).select("bin_id", "variant")
