"""Change feed of the keyed store, landed as CSV by hour."""

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from storelake.functions.keys import hour_parts
from storelake.functions.text import to_number
from storelake.schemas import LANDED, STREAM_TXN
from storelake.sinks.files import folder_size, subfolders, write_whole
from storelake.sources.files import read_csv

# The change types that carry a new row.
NEW_ROW_CHANGES = ["INSERT", "MODIFY"]

LANDED_COUNTER = "landed"

HOUR = ("year", "month", "day", "hour")
FILE_BYTES = 128 << 20  # of a merged file

CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "lineSep": "\n",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def with_new_row(changes: DataFrame) -> DataFrame:
    """Keep inserts and modifications that bring a non-empty image."""
    return changes.filter(F.col("eventName").isin(NEW_ROW_CHANGES) & (F.size("dynamodb.NewImage") > 0))


def number_text(text: Column) -> Column:
    """A number as it is written again: whole without a point, else a double. Other text stays as it is."""
    whole = text.try_cast("decimal(38,0)").cast("string")
    return F.coalesce(F.when(text.contains("."), text.try_cast("double").cast("string")).otherwise(whole), text)


def attribute_text(image: Column, name: str) -> Column:
    """Text of a tagged attribute: that of tag S, else N, else BOOL; null when tagged NULL or absent.

    Whatever else the attribute holds (lists, maps, sets, binary) becomes its JSON text.
    """
    tagged = image[name]

    def under(tag: str) -> Column:
        return F.try_variant_get(tagged, f"$.{tag}", "string")

    def has(tag: str) -> Column:
        return F.try_variant_get(tagged, f"$.{tag}", "variant").isNotNull()

    return (
        F.when(has("S"), under("S"))
        .when(has("N"), number_text(under("N")))
        .when(has("BOOL"), under("BOOL"))
        .when(~has("NULL"), F.to_json(tagged))
    )


def attribute(image: Column, name: str, data_type: str) -> Column:
    text = attribute_text(image, name)
    if data_type == "string":
        return text
    return to_number(text).try_cast(data_type)


def decode_changes(changes: DataFrame) -> DataFrame:
    """The ten transaction columns of each new row; other attributes are left out."""
    image = F.col("dynamodb.NewImage")
    return with_new_row(changes).select(
        [attribute(image, f.name, f.dataType.simpleString()).alias(f.name) for f in STREAM_TXN]
    )


def by_hour(rows: DataFrame, landed_at: Column) -> DataFrame:
    return rows.withColumns(hour_parts(landed_at))


def start_landing(
    changes: DataFrame, path: str, checkpoint: str, landed_at: Column | None = None, **trigger
) -> StreamingQuery:
    """Land each micro-batch under the hour it is processed in. The file sink commits every batch once.

    The rows of each batch are counted as they are written; see ``landed_counts``.
    """
    landed_at = F.current_timestamp() if landed_at is None else landed_at
    rows = by_hour(decode_changes(changes), landed_at).observe(LANDED_COUNTER, F.count(F.lit(1)).alias("rows"))
    writer = hourly(rows.writeStream.format("csv")).option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def hourly(writer):
    """The layout of landed rows, for the writer of a batch or of a stream."""
    return writer.options(**CSV_OPTIONS).partitionBy(*HOUR)


def land(changes: DataFrame, path: str, landed_at: Column) -> None:
    """Land one batch of changes under one hour."""
    hourly(by_hour(decode_changes(changes), landed_at).write).csv(path)


def landed_counts(running: StreamingQuery) -> dict[int, int]:
    """Rows landed by each of the query's recent batches."""
    seen = ((p.batchId, p.observedMetrics.get(LANDED_COUNTER)) for p in running.recentProgress)
    return {batch: row["rows"] for batch, row in seen if row is not None}


def landed_hours(spark: SparkSession, path: str) -> list[tuple[str, ...]]:
    """The hours, as (year, month, day, hour), for which there are folders. A listing of names alone."""
    found: list[tuple[str, ...]] = [()]
    for name in HOUR:
        found = [(*h, v) for h in found for v in subfolders(spark, hour_folder(path, h), name)]
    return sorted(found)


def hour_folder(path: str, hour: tuple[str, ...]) -> str:
    return "/".join([path.rstrip("/"), *[f"{name}={value}" for name, value in zip(HOUR, hour)]])


def merge_hours(
    spark: SparkSession, path: str, merged: str, now: datetime, file_bytes: int = FILE_BYTES, multi_line: bool = False
) -> list[tuple[str, ...]]:
    """Fold the many small files of each closed hour into few, in a folder of their own. Returns the hours folded.

    Closed are the hours before that of ``now`` (UTC); let ``now`` lag behind the clock by the longest batch, since a batch lands under
    the hour in which it began. A merged hour appears whole and is not merged again. The landing folder stays as it is, for the
    stream's own record of its files.
    """
    current = tuple(now.astimezone(timezone.utc).strftime("%Y %m %d %H").split())
    done, folded = set(landed_hours(spark, merged)), []
    for hour in landed_hours(spark, path):
        if hour in done or hour >= current:
            continue
        _, size = folder_size(spark, hour_folder(path, hour))
        own = [F.col(name) == value for name, value in zip(HOUR, hour)]
        rows = read_landed(spark, path, multi_line).filter(reduce(Column.__and__, own)).drop(*HOUR)
        write_whole(rows.coalesce(max(1, -(-size // file_bytes))), hour_folder(merged, hour), _csv)
        folded.append(hour)
    return folded


def read_merged(spark: SparkSession, path: str, merged: str, multi_line: bool = False) -> DataFrame:
    """Landed rows: merged hours from their few files, the others from where they landed."""
    done = landed_hours(spark, merged)
    if not done:
        return read_landed(spark, path, multi_line)
    known = F.concat_ws("-", *HOUR).isin(["-".join(hour) for hour in done])
    return read_landed(spark, path, multi_line).filter(~known).union(read_landed(spark, merged, multi_line))


def _csv(writer: DataFrameWriter, path: str) -> None:
    writer.options(**CSV_OPTIONS).csv(path)


def read_landed(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Landed rows with the hour they arrived in. With line breaks in the text, ``multi_line`` reads each file as a whole."""
    return read_csv(spark, path, LANDED, multi_line)
