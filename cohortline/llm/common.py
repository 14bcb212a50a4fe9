"""Helpers shared by the operators: tables in the shared folder, state of a reused Python worker, sums of arrays."""

from __future__ import annotations

import os
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.session import ensure_checkpoint_dir

#: Vocabularies and models are broadcast whole, so their size is checked against this.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the cluster's shared folder (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back, so that a lost executor
    never replays what came before."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_small_file(path: str) -> bytes:
    """A model file that is about to be broadcast, refused above the proven bound."""
    size = os.path.getsize(path)
    if size > MAX_BROADCAST_BYTES:
        raise ValueError(f"{path}: {size} bytes is more than {MAX_BROADCAST_BYTES} for a broadcast")
    with open(path, "rb") as file:
        return file.read()


def worker_state(owner: str) -> dict:
    """A dict that lives on in the Python worker, so that tasks which reuse the worker also
    reuse its tokenizer and its cache of words. Functions travel by value, hence their own
    module globals start empty in every task. Only one operator's state is kept: the next
    one to ask drops it, so that the caches of a pipeline's stages do not add up."""
    name = "cohortline_worker_state"
    module = sys.modules.get(name)
    if module is None or module.owner != owner:
        module = sys.modules[name] = types.ModuleType(name)
        module.owner, module.values = owner, {}
    return module.values


def sum_arrays(partials: DataFrame, parts: int, dtype: str, fan_in: int = 64) -> np.ndarray | None:
    """Sum of equally long arrays, one a row of ``partials`` (part, data: their bytes); None without rows.

    Rows are added up in levels of ``fan_in``, so that neither a task nor the driver reads more than
    about ``fan_in`` arrays, however many partitions (``parts``) made them."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for data in batch.column(1).to_pylist():
                total = np.frombuffer(data, dtype) if total is None else total + np.frombuffer(data, dtype)
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "data"])

    partials = partials.select("part", "data")
    while parts > fan_in:
        parts = -(-parts // fan_in)
        partials = partials.repartition(parts, F.floor(F.col("part") / fan_in)).mapInArrow(add, "part int, data binary")
    total = None
    for row in partials.toLocalIterator():
        total = np.frombuffer(row["data"], dtype) if total is None else total + np.frombuffer(row["data"], dtype)
    return total


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, computed once: the optimizer moves a column's expression into a lambda
    that refers to it, where it would be computed for every element."""
    return F.transform(F.array(value), body)[0]
