"""Structured Streaming over the transition log: an extension, no part of the batch behaviour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_transitions(stream: DataFrame, keys: list[str], ts: str, late: str = "1 day") -> DataFrame:
    """Each transition once; copies that come later than the watermark allows aren't recognised any more."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def counts_per_window(stream: DataFrame, ts: str, window: str, by: list[str], late: str = "1 day") -> DataFrame:
    return stream.withWatermark(ts, late).groupBy(F.window(ts, window), *by).agg(F.count("*").alias("n"))


def keep_latest(path: str, by: list[str], state: str, ts: str, seq: str):
    """A foreachBatch function that keeps the last state per entity in a versioned table: each batch writes a new version from
    the one before, named by the batch's number, so a batch that is run again gives the same version."""
    def exists(batch: DataFrame, path: str) -> bool:
        spark = batch.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)

    def write(batch: DataFrame, number: int) -> None:
        old = f"{path}/v={number - 1}"
        new = batch.groupBy(*by).agg(F.max_by(state, F.struct(ts, seq)).alias(state), F.max(F.struct(ts, seq)).alias("__at")).select(*by, state, F.col(f"__at.{ts}").alias(ts), F.col(f"__at.{seq}").alias(seq))
        if exists(batch, old):
            new = new.unionByName(batch.sparkSession.read.parquet(old).select(new.columns))
            new = new.groupBy(*by).agg(F.max_by(state, F.struct(ts, seq)).alias(state), F.max(F.struct(ts, seq)).alias("__at")).select(*by, state, F.col(f"__at.{ts}").alias(ts), F.col(f"__at.{seq}").alias(seq))
        new.write.mode("overwrite").parquet(f"{path}/v={number}")

    return write
