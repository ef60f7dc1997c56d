"""Every dealt operator on awkward rows, an empty table and clashing columns."""

import pytest
from pyspark.sql import functions as F

from contigra.llm import edit_counts, lattice, licenses, packing, quality, ranking, secret_scan, setsketch, sharding, telephony, tiling, toxicity


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 0, 0), (6, 0, 1), (None, 1, 1), (10, 1, None), (99, 1, 1), (2, 1, 1)], "doc_id long, quality int, toxic int")


def benchmark(spark):
    return spark.createDataFrame([(1, "cat sat on the mat and looked"), (2, None), (3, ""), (None, "cat sat on the mat"), (4, "tie tie"), (4, "tie tie")], "item_id long, text string")


OPERATORS = {
    "op1": lambda s, d: tiling.contamination(d, benchmark(s)),
    "op2": lambda s, d: sharding.shard(d),
    "op3": lambda s, d: toxicity.severity(d, labels(s)),
    "op4": lambda s, d: packing.pack(d),
    "op5": lambda s, d: quality.quality(d, labels(s)),
    "op6": lambda s, d: edit_counts.edited_counts(d),
    "op7": lambda s, d: secret_scan.scan(d),
    "op8": lambda s, d: lattice.score(d),
    "op9": lambda s, d: setsketch.near_duplicates(d, k=2),
    "op10": lambda s, d: telephony.media_features(d),
    "op11": lambda s, d: ranking.rank(d, benchmark(s)),
    "op12": lambda s, d: licenses.scan(d),
    "drop_rejected": lambda s, d: quality.drop_rejected(d, labels(s)),
    "drop_near": lambda s, d: setsketch.drop_near_duplicates(d),
    "drop_contaminated": lambda s, d: tiling.drop_contaminated(d, benchmark(s)),
    "redact": lambda s, d: secret_scan.redact(d),
}
PER_ROW = ["op2", "op3", "op5", "op6", "op7", "op8", "op9", "op10", "op12", "redact"]


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows(spark, awkward, name):
    rows = OPERATORS[name](spark, awkward).collect()
    if name in PER_ROW:
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in awkward.collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, empty, name):
    assert OPERATORS[name](spark, empty).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns(spark, clashing, awkward, name):
    got = OPERATORS[name](spark, clashing)
    want = OPERATORS[name](spark, awkward)
    if got.columns == want.columns:
        assert got.count() == want.count()
    else:  # whole rows: all columns pass through
        assert got.columns == clashing.columns and got.count() == want.count()


def test_empty_companions(spark, awkward):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["severity"] for r in toxicity.severity(awkward, none).collect()} == {0}
    assert quality.drop_rejected(awkward, none).count() == awkward.count()
    assert tiling.contamination(awkward, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_short_item_is_its_own_seed(spark, awkward):
    rows = tiling.contamination(awkward, benchmark(spark)).where("item_id = 4").collect()
    assert sorted(r["doc_id"] for r in rows) == [10, 10, 11, 11]


def test_null_id_stays(spark, awkward):
    r = setsketch.near_duplicates(awkward, k=2).where(F.col("doc_id").isNull()).first()
    assert r["component_id"] is None and r["kept"]


def test_labelled_rows_are_bounded_whatever_the_ids(spark):
    """One id on 10^5 rows is one labelled row, and a null text stays null."""
    from contigra.llm import models

    docs = spark.range(100_000).select(F.lit(5).alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 3).cast("string")).alias("text")).union(spark.createDataFrame([(6, None), (7, "x"), (None, "y")], "doc_id long, text string"))
    own = spark.createDataFrame([(5, 1), (6, 0), (7, None), (8, 1), (None, 1)], "doc_id long, quality int")
    assert sorted(tuple(r) for r in models.labelled(docs, own, "quality", 10).collect()) == [(5, "t0", 1.0), (6, None, 0.0)]
    assert models.labelled(docs, own, "quality", 1).count() <= 1
