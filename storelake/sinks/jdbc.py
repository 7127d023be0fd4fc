"""Warehouse load over JDBC."""

from pyspark.sql import DataFrame

# Fixed value: rows per JDBC batch.
BATCH_ROWS = 10000


def reload_options(
    connection: dict[str, str], table: str, batch_rows: int = BATCH_ROWS, max_connections: int | None = None
) -> dict[str, str]:
    """``connection`` holds url, user, password and driver."""
    options = {**connection, "dbtable": table, "batchsize": str(batch_rows), "truncate": "true"}
    if max_connections:
        options["numPartitions"] = str(max_connections)
    return options


def reload_table(
    df: DataFrame,
    connection: dict[str, str],
    table: str,
    batch_rows: int = BATCH_ROWS,
    max_connections: int | None = None,
) -> None:
    """Empty a warehouse table and load it again. Not atomic: run it again after a failure.

    Spark truncates where it knows the dialect of the URL (PostgreSQL, MySQL, Oracle and others)
    and recreates the table where it does not. Reach a warehouse through a URL of a known dialect
    to keep its definition.
    """
    options = reload_options(connection, table, batch_rows, max_connections)
    df.write.format("jdbc").options(**options).mode("overwrite").save()
