"""Surrogate keys, dates and lineage."""

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(natural_key: str) -> Column:
    """Stateless key: the same natural key hashes alike in every run."""
    return F.sha2(F.col(natural_key), 256)


def date_key(date: Column) -> Column:
    """yyyyMMdd as an int."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def lineage(load_type: str, run_ts: datetime) -> dict[str, Column]:
    """Lineage columns with one literal timestamp per run, so that retries and repeated writes agree."""
    return {"load_type": F.lit(load_type), "ingested_at": F.lit(run_ts)}


def utc(ts: Column) -> Column:
    """The instant as a local timestamp in UTC, computed from its microseconds: no session time zone is involved."""
    seconds = (F.unix_micros(ts).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.expr("timestamp_ntz '1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)


def utc_date(ts: Column) -> Column:
    """yyyy-MM-dd in UTC."""
    return utc(ts).cast("date").cast("string")


def _digits(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def iso_timestamp(ts: Column) -> Column:
    at = utc(ts)
    clock = F.concat_ws(":", *[_digits(part(at), 2) for part in (F.hour, F.minute, F.second)])
    micros = _digits(F.pmod(F.unix_micros(ts), F.lit(1_000_000)), 6)
    return F.concat(at.cast("date").cast("string"), F.lit("T"), clock, F.lit("."), micros)


def hour_parts(ts: Column) -> dict[str, Column]:
    """Zero-padded folder names of an hour in UTC."""
    at = utc(ts)
    widths = {"year": (F.year, 4), "month": (F.month, 2), "day": (F.dayofmonth, 2), "hour": (F.hour, 2)}
    return {name: _digits(part(at), width) for name, (part, width) in widths.items()}
