"""What the operators of this subpackage share: the shared folder, words, hashes, batches."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import weakref
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from xxhash import xxh3_64_intdigest

from contigra.operators.joins import join_heavy  # noqa: F401  (shared with the operators here)

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    It is ``spark.checkpoint.dir`` of the session.  Only where that is unset and all runs in one process
    (``local``, as in tests) a temporary folder is made and set for the context; a cluster must name its folder.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="contigra-"))
    return sc.getCheckpointDir().rstrip("/")


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000


def batched(df: DataFrame) -> DataFrame:
    """``df``; Arrow batches of texts hold BATCH_ROWS rows, unless the session has a number of its own.

    Spark's default of 10,000 rows is made for numbers: with whole texts it takes some 100 MB a task on either side.  The
    setting belongs to the session and is read when a query runs, so it stays for what runs later.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH) == "10000":
        conf.set(BATCH, str(BATCH_ROWS))
    return df


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a reader of the files: lineage ends here."""
    spark = batched(df).sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _written[id(out)] = (weakref.ref(out), path)
    return out


_written: dict[int, tuple[weakref.ref, str]] = {}


def forget(*written: DataFrame) -> None:
    """Delete what ``write_shared`` wrote, once all that reads it has been written itself."""
    for df in written:
        held, path = _written.pop(id(df), (None, None))
        if held is not None and held() is df:
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def fresh(name: str, columns: list[str]) -> str:
    """``name``, made longer until no column has it (names are compared without regard to case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batched(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes after A-Z became a-z.

    ``bytes.lower`` touches ASCII letters only and ``bytes.split`` splits at exactly
    these six bytes, none of which occurs inside a longer UTF-8 sequence.
    """
    return text.lower().split() if text else []


_TERM = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()


def terms(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of anything beyond ASCII, after A-Z became a-z."""
    return text.translate(_TERM).split() if text else []


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, tokens), np.uint64, len(tokens))


_M1, _M2, _M3 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_S33 = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3, over an array."""
    x = (x ^ (x >> _S33)) * _M1
    x = (x ^ (x >> _S33)) * _M2
    return x ^ (x >> _S33)


def shingles(tokens: list[bytes], k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``k``-word shingles; with fewer words, of the whole sequence."""
    n = len(tokens)
    if not n:
        return np.empty(0, np.uint64)
    h = word_hashes(tokens)
    size = min(k, n)
    acc = mix(h[: n - size + 1] + np.uint64(size << 32))
    for j in range(1, size):
        acc = mix(acc * _M3 + h[j : n - size + 1 + j])
    return np.unique(acc)


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes, one per row."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def release() -> None:
    """Give memory that a task has used back to the system: workers are reused and would hold it."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], name: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose column ``name`` holds about ``limit`` bytes, a row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
        size = np.cumsum(np.nan_to_num(np.asarray(pa.compute.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.float64)))
        start = 0
        while start < batch.num_rows:
            base = size[start - 1] if start else 0.0
            stop = max(start + 1, int(np.searchsorted(size, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    release()


def shingle_blocks(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) such that offsets[b] - offsets[a] is about ``most``, a row at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
        yield a, b
        a = b
