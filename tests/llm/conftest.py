import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
AWKWARD = [
    (1, "The cat sat on the mat and looked at the other cat", "en", "a", 50),
    (1, "The cat sat on the mat and looked at the other cat", "en", "a", 50),  # a repeated row
    (2, "the CAT sat on the mat and looked at the other cat", None, None, None),
    (3, "", "en", "a", 0),
    (4, None, "en", "a", None),
    (5, "   \n\t ", "de", "b", 6),
    (None, "a row without an id holds some words too", "en", "b", 40),
    (6, "one", "en", "a", 3),
    (7, "Ünïcödé wörds — and 😀 more; İstanbul é  x", "tr", "c", 40),
    (8, "long " * 30_000, "en", "c", 150_000),
    (9, "x" * 40_000, "en", "c", 40_000),
    (10, "tie tie tie", "en", "a", 11),
    (11, "tie tie tie", "en", "a", 11),
]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(awkward):
    """Extra columns with names that operators use inside."""
    from pyspark.sql import functions as F

    names = ["node", "n", "regs", "key", "part_", "length", "evidence_", "shard", "word", "media", "p_", "id_", "y_", "site_", "host_", "gone_", "row_key_", "in_text", "in_0", "in_1", "path_", "heavy_", "hi", "lo", "component_id", "kept", "good_", "ps_", "row_", "block_", "size_", "rank_", "doc", "batch"]
    return awkward.select("*", *[F.lit(1).alias(n) for n in names])
