"""Python work on Arrow batches inside tasks."""

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[2])
Batches = Iterator[pa.RecordBatch]


def find_package(spark: SparkSession) -> None:
    """Let Python workers look for this package where the driver found it, after their own path."""
    settings = spark.sparkContext.environment
    path = settings.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in path:
        settings["PYTHONPATH"] = os.pathsep.join([p for p in path if p] + [ROOT])


def map_batches(df: DataFrame, run: Callable[[Batches], Batches], schema: str) -> DataFrame:
    find_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def by_size(batch: pa.RecordBatch, column: str, most: int) -> Batches:
    """A batch in slices of at most so many bytes of text, or of one row where that alone has more."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + most, side="right")))
        yield batch.slice(at, end - at)
        at = end
