"""Shared plumbing of the llm operators: shared storage and batch sizes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is what ``spark.checkpoint.dir`` names. Where that is unset, a local
    session gets a folder of its own; on a cluster the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        named = spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="lexiloom-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Lineage ends at the files, so lost executors cost a re-read, not a re-run.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    if _scopes:
        _scopes[-1].append(out)
    return out


_scopes: list[list[DataFrame]] = []


@contextmanager
def temporary(*, keep_last: bool = False):
    """Remove what ``stored`` writes within, at the end: for tables that only lead to one that is written or checkpointed there.

    With ``keep_last`` the table written last stays, and belongs to the scope around.
    """
    _scopes.append([])
    try:
        yield
    finally:
        written = _scopes.pop()
        if keep_last and written:
            last = written.pop()
            if _scopes:
                _scopes[-1].append(last)
        discard(*written)


def discard(*frames: DataFrame) -> None:
    """Remove what ``stored`` wrote, once nothing reads it any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of texts that a worker takes in one Arrow batch; a longer text is a batch of its own.
BATCH_BYTES = "1m"


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of Python workers by bytes, as one text may be long.

    Operators are lazy and the setting is read when they run, so it stays for the
    session; it changes how rows are batched, and no result.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def sorted_runs(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """Rows sorted by ``key`` in frames that hold whole groups; a group may go on over batches."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        if whole := int((batch[key] != batch[key].iloc[-1]).any(axis=1).sum()):
            yield pd.concat([*held, batch.iloc[:whole]])
            held = []
        held.append(batch.iloc[whole:])
    if held:
        yield pd.concat(held)


def sorted_groups(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of rows sorted by ``key``, one frame each."""
    for rows in sorted_runs(batches, key):
        for _, group in rows.groupby(key, sort=False):
            yield group


def with_fields(df: DataFrame, found: Column, fields: dict[str, str]) -> DataFrame:
    """Add fields of the struct ``found`` under the names that ``fields`` maps to them; columns of these names are replaced, all others pass through."""
    held = "_found"
    while held.lower() in (c.lower() for c in df.columns):
        held += "_"
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in (n.lower() for n in fields)]
    return df.withColumn(held, found).select(*kept, *(F.col(f"{held}.{field}").alias(name) for name, field in fields.items()))
