"""High watermarks kept beside a stored table, so that no run has to scan it for them."""

from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storelake.operators.incremental import above, high_watermark, key_rank
from storelake.schemas import LONG, TEXT, columns
from storelake.session import scratch_path
from storelake.sinks.files import append, delete_folder, folder_exists, folder_size, observed, overwrite, stored

# The mark, and what the table's folder held when it was written: it counts only while that is still so.
MARK = columns(watermark=TEXT, files=LONG, bytes=LONG)


def mark_path(table_path: str, key: str, order: str) -> str:
    return f"{table_path.rstrip('/')}-watermarks/{key}-{order}"


def read_mark(spark: SparkSession, table_path: str, key: str, order: str):
    """The mark kept for a table in a list of one; an empty list where there is none that fits the table."""
    path = mark_path(table_path, key, order)
    row = spark.read.schema(MARK).parquet(path).first() if folder_exists(spark, path) else None
    if row is None or (row["files"], row["bytes"]) != folder_size(spark, table_path):
        return []
    text = row["watermark"]
    return [Decimal(text) if order == "numeric" and text is not None else text]


def write_mark(spark: SparkSession, table_path: str, key: str, order: str, watermark) -> None:
    text = None if watermark is None else str(watermark)
    row = spark.createDataFrame([(text, *folder_size(spark, table_path))], MARK)
    overwrite(row.coalesce(1), mark_path(table_path, key, order))


def table_watermark(existing: DataFrame, table_path: str, key: str, order: str = "lexicographic"):
    """The high watermark of a stored table: the mark kept for it, or else found in its data."""
    kept = read_mark(existing.sparkSession, table_path, key, order)
    return kept[0] if kept else high_watermark(existing, key, order)


def append_newer(
    df: DataFrame, existing: DataFrame, table_path: str, key: str, order: str = "lexicographic"
) -> int:
    """Append the rows above the table's watermark, keep the new watermark, and return the number of rows.

    The mark is written after the rows: an append that fails leaves the old one, and where rows were written
    without it, the folder no longer fits the mark, so that the next run looks into the data.
    """
    spark = df.sparkSession
    before = table_watermark(existing, table_path, key, order)
    counter, staging = Observation(), scratch_path(spark, "delta")
    measures = {"rows": F.count(F.lit(1)), "highest": F.max(key_rank(key, order))}
    delta = above(df, key, before, order).observe(counter, *[c.alias(n) for n, c in measures.items()])
    staged = stored(delta, staging)
    found = observed(counter, lambda: staged.agg(*[c.alias(n) for n, c in measures.items()]).first().asDict())
    if found["rows"]:
        append(staged, table_path)
    delete_folder(spark, staging)
    if found["rows"] or not read_mark(spark, table_path, key, order):
        marks = [m for m in (before, found["highest"]) if m is not None]
        write_mark(spark, table_path, key, order, max(marks, default=None))
    return found["rows"]
