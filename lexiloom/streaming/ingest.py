"""Incremental ingest: new rows once, checkpointed, deduplicated across runs and rescans."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexiloom.functions.text import digest


def signature(settings: dict) -> str:
    """A run's settings as a folder name: other settings start from other checkpoints. (STR-04)"""
    return hashlib.md5(json.dumps(settings, sort_keys=True).encode()).hexdigest()[:16]


def first_seen(stream: DataFrame, time: str | None = None, late: str = "1 day") -> DataFrame:
    """Each text once. With an event time, state older than ``late`` is let go; without, it is kept for good. (STR-03, WIN-03)"""
    keyed = stream.withColumn("_digest", digest(F.col("text")))
    once = keyed.withWatermark(time, late).dropDuplicatesWithinWatermark(["_digest"]) if time else keyed.dropDuplicates(["_digest"])
    return once.drop("_digest")


def ingest(stream: DataFrame, out: str, checkpoints: str, settings: dict, rows: int = 500_000) -> StreamingQuery:
    """Append what is available now to Parquet shards, and stop. (STR-01, STR-04, STR-05)"""
    writer = stream.writeStream.format("parquet").option("path", out).option("maxRecordsPerFile", rows)
    return writer.option("checkpointLocation", f"{checkpoints}/{signature(settings)}").trigger(availableNow=True).start()


def rescan(stream: DataFrame, out: str, checkpoints: str, settings: dict, every: str = "60 seconds") -> StreamingQuery:
    """As ``ingest``, over and over at an interval. (STR-02)"""
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{checkpoints}/{signature(settings)}")
    return writer.trigger(processingTime=every).start()
