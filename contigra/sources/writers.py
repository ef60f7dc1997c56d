"""B-1 to B-7: sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_bins(df: DataFrame, path: str) -> None:
    """B-1: Parquet by bin."""
    df.write.mode("overwrite").partitionBy("bin_id").parquet(path)


def write_fasta(df: DataFrame, path: str) -> None:
    """B-1: FASTA text by bin."""
    df.select("bin_id", F.concat(F.lit(">"), "contig_id", F.lit("\n"), "seq").alias("value")).write.mode("overwrite").partitionBy("bin_id").text(path)


def write_fastq(df: DataFrame, path: str) -> None:
    """B-2: FASTQ text by bin and mate."""
    line = F.concat(F.lit("@"), "read_id", F.lit("\n"), "seq", F.lit("\n+\n"), "qual")
    df.select("bin_id", "mate", line.alias("value")).write.mode("append").partitionBy("bin_id", "mate").text(path)


def write_tsv(df: DataFrame, path: str) -> None:
    """B-3."""
    df.write.mode("overwrite").csv(path, sep="\t", header=True)


class StageManifest:
    """B-4: stages that are done, appended to a table; a stage is overwritten as a whole, so it can run again."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def last(self) -> int:
        """F-w10: the last finished step, 0 if none."""
        try:
            rows = self.spark.read.schema("step int, name string").json(self.path)
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return 0
            raise
        return int(rows.agg(F.coalesce(F.max("step"), F.lit(0))).first()[0])

    def run(self, step: int, name: str, make, out: str) -> DataFrame:
        """The stage's table: made and recorded if it isn't there yet."""
        if self.last() < step:
            make().write.mode("overwrite").parquet(out)
            self.spark.createDataFrame([(step, name)], "step int, name string").write.mode("append").json(self.path)
        return self.spark.read.parquet(out)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """B-5: row count and column nulls as metrics of the run itself."""
    o = Observation(name)
    return df.observe(o, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns]), o


def write_report(quality: DataFrame, path: str) -> DataFrame:
    """B-6: final names ``bin<n>`` in order of falling quality, as a report."""
    from contigra.operators.windows import numbered

    out = numbered(quality, [F.desc(F.col("completeness") - 5 * F.col("contamination")), F.asc("bin_id")], "n").withColumn("final_name", F.concat(F.lit("bin"), "n"))
    write_tsv(out, path)
    return out


def write_bundle(connections: DataFrame, contigs: DataFrame, coverage: DataFrame, path: str) -> None:
    """B-7: the three tables that external bins need."""
    for name, df in (("connections", connections), ("contigs", contigs), ("coverage", coverage)):
        df.write.mode("overwrite").parquet(f"{path}/{name}")
