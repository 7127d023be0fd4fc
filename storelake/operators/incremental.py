"""Deltas against a stored table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.sinks.files import stored

BITS = 1 << 26  # of a bitmap of keys: 8 MB


def key_rank(key: str, order: str) -> Column:
    if order == "lexicographic":
        return F.col(key)
    if order == "numeric":
        return F.regexp_extract(key, r"(\d+)$", 1).try_cast("decimal(38,0)")
    raise ValueError(f"order is lexicographic or numeric, not {order}")


def high_watermark(existing: DataFrame, key: str, order: str = "lexicographic"):
    """Highest stored key: a single value, null for an empty table.

    A table that holds rows but no key to compare by is an error, not an empty table.
    """
    found = existing.agg(F.max(key_rank(key, order)).alias("watermark"), F.count(F.lit(1)).alias("rows")).first()
    if found["rows"] and found["watermark"] is None:
        raise ValueError(f"no value of {key} can be compared in {order} order")
    return found["watermark"]


def newer_than(df: DataFrame, existing: DataFrame, key: str, order: str = "lexicographic") -> DataFrame:
    """Rows above the stored high watermark; all rows while nothing is stored.

    Text order puts C9 above C10. ``numeric`` compares the digits at the end of the key; an incoming
    key that has none fails the query. Either way late rows with a lower key, and changed rows, are not
    seen. The watermark enters the filter as a literal, so in text order it is pushed into a Parquet
    or JDBC scan.
    """
    return above(df, key, high_watermark(existing, key, order), order)


def above(df: DataFrame, key: str, watermark, order: str = "lexicographic") -> DataFrame:
    """Rows above a known watermark, as ``newer_than`` has them; all rows where it is None."""
    if watermark is None:
        return df
    rank = key_rank(key, order)
    if order == "numeric":
        unranked = F.col(key).isNotNull() & rank.isNull()
        told = F.raise_error(F.concat(F.lit(f"{key} without digits at its end: "), F.col(key))).cast("decimal(38,0)")
        rank = F.when(unranked, told).otherwise(rank)
    return df.filter(rank > F.lit(watermark))


def not_in(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not stored yet; copies within ``df`` and null keys stay.

    A bitmap of the hashes of the stored keys settles most rows: where the bit of a key is not set, the row is new. The others
    meet the stored keys, and of these only such as a bitmap of the doubtful rows lets through; they are distinct and written, so
    that a hot key of ``df`` can be split in the join. Both bitmaps are broadcast and hold ``BITS`` bits at most.
    ``df`` is read once and staged. Both keys have to be of one type, since their hashes are compared.
    """
    kinds = df.schema[key].dataType, existing.schema[key].dataType
    if kinds[0] != kinds[1]:
        raise ValueError(f"{key} is of type {kinds[0].simpleString()} here and {kinds[1].simpleString()} there")
    mark = "maybe_stored"
    while mark in df.columns:
        mark += "_"
    flagged = stored(with_mark(df, key, key_bits(existing, key), mark))
    doubtful = flagged.filter(mark)
    wanted = with_mark(existing.select(key), key, key_bits(doubtful, key), mark).filter(mark)
    known = stored(wanted.select(key).distinct())
    checked = doubtful.join(known, key, "left_anti").select(df.columns)
    return flagged.filter(~F.col(mark)).select(df.columns).union(checked)


def _place(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS))


def key_bits(df: DataFrame, key: str) -> DataFrame:
    """Bitmap of the hashes of all keys: ``part`` and ``bits``, an array of 64-bit words, of at most ``BITS`` bits in all.

    Every task combines its keys into one bitmap before the shuffle, so repeated keys cost nothing.
    """
    place = _place(key) + 1
    made = F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("made")
    parts = df.filter(F.col(key).isNotNull()).groupBy(F.bitmap_bucket_number(place).alias("part")).agg(made)
    word = "transform(sequence(0, 511), i -> cast(conv(hex(substring(made, 8 * i + 1, 8)), 16, -10) as bigint))"
    return parts.select("part", F.expr(word).alias("bits"))


def with_mark(df: DataFrame, key: str, bits: DataFrame, mark: str) -> DataFrame:
    """The frame with a column that tells whether the bit of the key is set; false for a null key."""
    own = bits.select(F.col("part").alias(f"{mark}_part"), F.col("bits").alias(f"{mark}_bits"))
    place = _place(key)
    word = F.get(f"{mark}_bits", F.shiftright(place, 6).bitwiseAND(511).cast("int"))
    byte = F.shiftright(place, 3).bitwiseAND(7)  # counted from the high end of the word
    is_set = F.getbit(word, ((F.lit(7) - byte) * 8 + place.bitwiseAND(7)).cast("int")) == 1
    met = df.join(F.broadcast(own), F.bitmap_bucket_number(place + 1) == F.col(f"{mark}_part"), "left")
    return met.select(*df.columns, F.coalesce(is_set & F.col(key).isNotNull(), F.lit(False)).alias(mark))
