"""Row cleaning, casting and key deduplication."""

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, StringType, StructField, StructType

from storelake.sinks.files import stored_counted

CORRUPT = "_corrupt_record"  # Spark's own name for it
MANY = 100_000  # hashes of repeated rows, up to which the others are told from them by a join
HASH_BITS = 48  # of a row's hash: fewer bytes to shuffle; different rows that share one, 83 pairs of 216 million, are grouped too


def normalize_names(df: DataFrame) -> DataFrame:
    """Trim and lower-case the column names and join their words with underscores."""
    names = [re.sub(r"\W+", "_", name.strip().lower()) for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"columns {df.columns} fall together as {clashes}")
    return df.toDF(*names)


def complete(df: DataFrame) -> DataFrame:
    """Keep the rows without a null or NaN.

    Spelt per column, so that the null checks reach the Parquet scan.
    """

    return df.filter(reduce(Column.__and__, map(_present, df.schema)))


def _present(field: StructField) -> Column:
    filled = F.col(field.name).isNotNull()
    if isinstance(field.dataType, (FloatType, DoubleType)):
        filled = filled & ~F.isnan(field.name)
    return filled


def with_corrupt(schema: StructType) -> StructType:
    """A file schema with the column that holds a line which does not fit it."""
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])


def drop_counts(schema: StructType) -> dict[str, Column]:
    """Counters over rows read ``with_corrupt``: all rows, and those that ``complete`` drops, by reason."""
    full = reduce(Column.__and__, map(_present, schema))
    malformed = F.col(CORRUPT).isNotNull()
    return {
        "rows": F.count(F.lit(1)),
        "malformed": F.count_if(~full & malformed),
        "nulls": F.count_if(~full & ~malformed),
    }


def clean(df: DataFrame) -> DataFrame:
    """Distinct complete rows under normalised names. Filtering first keeps bad rows out of the shuffle."""
    return complete(normalize_names(df)).distinct()


def distinct_rows(df: DataFrame, first_pass: DataFrame | None = None) -> DataFrame:
    """``distinct`` for a frame read from files, of which few rows repeat: the rows themselves are not shuffled.

    A first pass shuffles the hashes of the rows alone. Only rows whose hash comes twice or more are then grouped; where there
    are more than ``MANY`` such hashes, all are. ``first_pass`` is the same frame for that pass, such as one that is observed.
    """
    floats = [f.name for f in df.schema if isinstance(f.dataType, (FloatType, DoubleType))]
    own = "row_hash"
    while own in df.columns:
        own += "_"

    def hashed(rows: DataFrame) -> DataFrame:
        no_minus = {name: F.col(name) + F.lit(0).cast(rows.schema[name].dataType) for name in floats}  # -0.0 is 0.0
        rows = rows.withColumns(no_minus) if floats else rows
        return rows.withColumn(own, F.xxhash64(*df.columns).bitwiseAND(F.lit((1 << HASH_BITS) - 1)))

    counted = hashed(df if first_pass is None else first_pass).groupBy(own).agg(F.count(F.lit(1)).alias("n"))
    repeated, many = stored_counted(counted.filter("n > 1").select(own))
    rows = hashed(df)
    if many > MANY:
        return rows.drop(own).distinct()
    if not many:
        return rows.drop(own)
    once = rows.join(repeated, own, "left_anti").drop(own)
    return once.union(rows.join(repeated, own, "left_semi").drop(own).distinct())


def cast_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Project onto a schema; a value that does not convert becomes null.

    Text becomes a whole number by way of a number, so ``3.0`` is 3 and a fraction is cut off.
    """

    def cast(field) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, IntegerType) and isinstance(df.schema[field.name].dataType, StringType):
            column = column.try_cast("double")
        return column.try_cast(field.dataType).alias(field.name)

    return df.select([cast(f) for f in schema])


def dedup_by_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the one whose remaining columns are smallest, the same in every run.

    The minimum is combined before the shuffle, so copies of a hot key do not travel.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    survivor = F.min(F.struct(*rest)).alias("survivor")
    return df.groupBy(*keys).agg(survivor).select(*keys, "survivor.*").select(*df.columns)
