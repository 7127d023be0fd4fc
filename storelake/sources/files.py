"""File readers."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header, bound to the schema by position; a malformed cell becomes null.

    ``multi_line`` reads line breaks inside quotes, at the price of one task per file.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
