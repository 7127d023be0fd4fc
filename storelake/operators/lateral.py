"""Expensive columns that later filters must not repeat."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row.

    A filter on a plain column moves below it and takes a second copy of the expression along,
    which doubles the work when that expression parses JSON. As the output of a lateral
    one-element ``inline`` the columns are fixed before any later filter or projection.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))
