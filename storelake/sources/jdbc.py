"""Relational sources over JDBC."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Partitioning:
    """Parallel read: ``partitions`` ranges of a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    partitions: int


def read_options(
    connection: dict[str, str],
    table: str | None = None,
    query: str | None = None,
    partitioning: Partitioning | None = None,
    fetch_rows: int = 10000,
    one_task: bool = False,
) -> dict[str, str]:
    """``connection`` holds url, user, password and driver.

    Name a partitioning; a table small enough for a single task has to be read with ``one_task``. A query is passed as a derived table, since Spark partitions reads of tables only.
    """
    if (table is None) == (query is None):
        raise ValueError("name either a table or a query")
    if (partitioning is None) != one_task:
        raise ValueError("name a partitioning, or read in one_task")
    options = {**connection, "dbtable": table or f"({query}) extracted", "fetchsize": str(fetch_rows)}
    if partitioning:
        options.update(
            partitionColumn=partitioning.column,
            lowerBound=partitioning.lower,
            upperBound=partitioning.upper,
            numPartitions=str(partitioning.partitions),
        )
    return options


def read_jdbc(
    spark: SparkSession,
    connection: dict[str, str],
    table: str | None = None,
    query: str | None = None,
    partitioning: Partitioning | None = None,
    one_task: bool = False,
) -> DataFrame:
    options = read_options(connection, table, query, partitioning, one_task=one_task)
    return spark.read.format("jdbc").options(**options).load()
