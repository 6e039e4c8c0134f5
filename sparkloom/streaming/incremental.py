"""Structured Streaming forms of the incremental operators, for corpora that arrive as a stream of file rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_seen(files: DataFrame, delay: str = "1 day") -> DataFrame:
    """The first row of each content of a scope within the watermark: in-scope dedup on a stream.

    files: scope_id, content_sha256, discovered_at and more. State is kept for
    ``delay`` only, so it is bounded by the arrival rate.
    """
    return files.withWatermark("discovered_at", delay).dropDuplicatesWithinWatermark(["scope_id", "content_sha256"])


def counts_by_hour(files: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Files per scope and hour with late rows up to ``delay``."""
    return files.withWatermark("discovered_at", delay).groupBy(F.window("discovered_at", "1 hour"), "scope_id").agg(F.count(F.lit(1)).alias("n_files"))


def append_batches(files: DataFrame, path: str, checkpoint: str):
    """Write a stream to Parquet by scope, exactly once, and stop when what is there has been taken."""
    return files.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("scope_id").trigger(availableNow=True).start()
