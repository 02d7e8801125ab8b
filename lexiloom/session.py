"""What every query needs from its session."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

HOME = str(Path(__file__).resolve().parents[1])


def workers_import_package(spark: SparkSession) -> None:
    """Let Python workers import the package from the folder that the driver imported it from."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if HOME not in paths:
        env["PYTHONPATH"] = os.pathsep.join([HOME, *filter(None, paths)])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables, by any path that Spark's readers open."""
    workers_import_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write what several branches of a query read to a new shared folder, and read it back: it is worked out once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: within ``spark.checkpoint.dir``, or local for a local session."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="lexiloom-")
    return f"{named}/{name}-{uuid.uuid4().hex}"
