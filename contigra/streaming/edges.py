"""E-1, E-2, D-13 and D-14 over streams of alignments: edges counted, and mates paired, as rows arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def edge_counts(pairs: DataFrame) -> DataFrame:
    """Unordered pairs (node1, node2) counted, for update or complete mode; state has one row an edge."""
    return pairs.groupBy(F.least("node1", "node2").alias("node1"), F.greatest("node1", "node2").alias("node2")).agg(F.count(F.lit(1)).alias("connections"))


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts by tumbling window and key; rows later than ``late`` are left out, so state is bounded."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")


def mate_pairs(reads: DataFrame, time: str, within: str = "1 hour") -> DataFrame:
    """D-13 and D-14: (read_id, node1, node2, at) of reads (read_id, mate, contig_id, ``time``) whose mates 1 and 2 arrive no further apart than ``within``.

    State is keyed by read.  A mate waits until the watermark, ``within`` behind the latest row, shows that its partner can't come any more, so
    state holds about twice that time's reads, never the stream.  Over a table the same function is the batch query.
    """
    own = reads.withWatermark(time, within) if reads.isStreaming else reads
    one = own.where("mate = 1").select(F.col("read_id").alias("r1"), F.col("contig_id").alias("node1"), F.col(time).alias("t1"))
    two = own.where("mate = 2").select(F.col("read_id").alias("r2"), F.col("contig_id").alias("node2"), F.col(time).alias("t2"))
    near = F.expr(f"r1 = r2 AND t2 >= t1 - INTERVAL {within} AND t2 <= t1 + INTERVAL {within}")
    return one.join(two, near).select(F.col("r1").alias("read_id"), "node1", "node2", F.greatest("t1", "t2").alias("at"))


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Write what is there to Parquet and stop; the checkpoint makes it exactly once."""
    q = stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    q.awaitTermination()
