"""The folder that the driver and all executors see, and what a worker process keeps between tasks."""

from __future__ import annotations

import re
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a local session may fall back to a folder of this machine."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        given = spark.conf.get("spark.checkpoint.dir", None)
        if given is None:
            if not re.match(r"local(\[|$)", context.master):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            given = tempfile.mkdtemp(prefix="netstats-llm-")
        context.setCheckpointDir(given)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The same rows, kept in the shared folder; a lost executor takes nothing with it."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """The same rows as a Parquet table in the shared folder: smaller than `cut`, for rows of many."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job wrote in the shared one and needs no more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def pieces_of(batches: Iterator[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most so many rows, so that a task holds few texts as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def kept_in_worker(name: str, make: Callable[[], Any]) -> Any:
    """What `make` returned the first time, for as long as the worker process lives."""
    held = sys.modules.setdefault("_netstats_llm_held", types.ModuleType("_netstats_llm_held"))
    if not hasattr(held, name):
        setattr(held, name, make())
    return getattr(held, name)
