"""Intermediate tables that are deleted when the last reader is done."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from storelake.session import scratch_path
from storelake.sinks.files import delete_folder, stored


class Scratch:
    """Tables written to the shared scratch folder in the course of one operator."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def table(self, df: DataFrame) -> DataFrame:
        self.paths.append(scratch_path(self.spark, "work"))
        return stored(df, self.paths[-1])

    def clear(self) -> None:
        for path in self.paths:
            delete_folder(self.spark, path)
        self.paths = []


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that is run here are deleted as it ends, not when the driver happens to collect its garbage.

    Spark below 4.1 does not know the option. A frame that is made here should not be read afterwards but for stored ones.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
