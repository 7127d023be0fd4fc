"""Keyed store of the latest item per transaction, with high-value alerts, fed by a stream.

The store is a log of micro-batches. Each batch appears whole as its own ``batch_id`` folder, so a
replayed batch changes nothing, and the stream itself never shuffles. The current items are the
latest per key over the log, by batch and position in the stream. Folding moves older batches into a base
with one row for each key, bucket by bucket, while the stream runs.
"""

import logging
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, IntegerType, StructField, StructType

from storelake.functions.keys import iso_timestamp
from storelake.operators.lateral import computed_once
from storelake.schemas import ALERT, ITEM_LOG, STORE_ITEM, STREAM_RECORD
from storelake.sinks.files import delete_folder, folder_exists, make_folder, subfolders, write_whole

log = logging.getLogger(__name__)

# Alert bound (strict) and the default of a missing text.
ALERT_THRESHOLD = 990
UNKNOWN = "UNKNOWN"

ITEM_KEY = "transaction_id"
BASE_BATCH = -1
BUCKETS = 8  # of keys; fixed for a log


def decode_records(keyed: DataFrame) -> DataFrame:
    """Decode base64 ``data`` into text fields. An unreadable record fails the batch, which then replays."""
    text = F.decode(F.unbase64("data"), "UTF-8")
    parsed = F.from_json(text, STREAM_RECORD, {"mode": "FAILFAST"})
    record = F.coalesce(parsed, F.raise_error(F.lit("stream record without a JSON object")))
    return computed_once(keyed, record=record).select("seq", "record.*")


def store_items(records: DataFrame, ingested_at: Column) -> DataFrame:
    """Items as stored: text with defaults, two ints and the ingestion time."""
    computed = {
        "order_value": F.coalesce("order_value", F.lit("0")),
        "discount_applied": F.coalesce("discount_applied", F.lit("0")),
        "shipping_delay_days": whole_or_zero("shipping_delay_days"),
        "high_value_flag": whole_or_zero("high_value_flag"),
        "ingested_at": iso_timestamp(ingested_at),
    }
    texts = {name: F.coalesce(name, F.lit(UNKNOWN)) for name in STORE_ITEM.names if name not in computed}
    items = {**texts, **computed}
    return records.select("seq", *[items[name].alias(name) for name in STORE_ITEM.names])


def whole_or_zero(name: str) -> Column:
    """Int of a numeric text, 0 if it is missing; other text raises."""
    return F.coalesce(F.col(name).cast("double").cast("int"), F.lit(0))


def alerts(items: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Alert messages of the items above the threshold, with null for what the record lacked. NaN is not above."""
    value = F.col("order_value").cast("double")
    high = items.filter(~F.isnan(value) & (value > threshold))
    known = [F.nullif(F.col(name), F.lit(UNKNOWN)).cast(to).alias(name) for name, to in typed(ALERT)]
    return high.select(known)


def typed(schema: StructType) -> list[tuple[str, DataType]]:
    return [(f.name, f.dataType) for f in schema]


def latest_per_key(items: DataFrame, order: list[str]) -> DataFrame:
    """Last item per key. Items are combined before the shuffle, so a hot key stays small."""
    rest = [c for c in items.columns if c != ITEM_KEY]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("last")
    return items.groupBy(ITEM_KEY).agg(last).select(ITEM_KEY, "last.*")


def bucket_of(key: Column) -> Column:
    return F.pmod(F.hash(key), F.lit(BUCKETS)).alias("bucket")


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    return _log_rows(spark, log_path).select(ITEM_LOG.names)


def _log_rows(spark: SparkSession, log_path: str) -> DataFrame:
    schema = StructType([*ITEM_LOG.fields, StructField("bucket", IntegerType())])
    return spark.read.schema(schema).parquet(log_path)


def read_alerts(spark: SparkSession, alerts_path: str) -> DataFrame:
    return spark.read.schema(ALERT).json(alerts_path).select(ALERT.names)


def base_path(log_path: str, bucket: int) -> str:
    """Folder of the folded items of a bucket, beside the log: one subfolder for each fold that is still kept."""
    return f"{log_path.rstrip('/')}-base/bucket={bucket}"


def folded_up_to(spark: SparkSession, log_path: str) -> list[int]:
    """The last batch folded into the base, by bucket; one below the first where none is."""
    found = (subfolders(spark, base_path(log_path, b), "upto") for b in range(BUCKETS))
    return [max(map(int, upto), default=BASE_BATCH - 1) for upto in found]


def _read_base(spark: SparkSession, log_path: str, folded: list[int], buckets: Iterable[int]) -> DataFrame | None:
    paths = [f"{base_path(log_path, b)}/upto={folded[b]}" for b in buckets if folded[b] >= BASE_BATCH]
    return spark.read.schema(ITEM_LOG).parquet(*paths) if paths else None


def current_items(spark: SparkSession, log_path: str) -> DataFrame:
    """The latest item of each key: of the folded base, and of the batches that a bucket's base does not hold yet."""
    folded = folded_up_to(spark, log_path)
    own = F.element_at(F.array(*map(F.lit, folded)), F.col("bucket") + 1)
    rows = _log_rows(spark, log_path).filter((F.col("batch_id") > min(folded)) & (F.col("batch_id") > own))
    rows, base = rows.select(ITEM_LOG.names), _read_base(spark, log_path, folded, range(BUCKETS))
    return latest_per_key(rows if base is None else rows.union(base), ["batch_id", "seq"]).select(STORE_ITEM.names)


def fold_items(spark: SparkSession, log_path: str, buckets: Iterable[int] = range(BUCKETS)) -> int:
    """Fold the batches of a log into its base, a bucket at a time, while the stream goes on. Returns the last batch folded.

    A batch that can be seen is whole and is never written again, so all batches seen at the start are folded. Each
    bucket gets a new folder, which appears whole; readers take the newest. The folder before it and the batches that the
    fold before had reached stay until the next fold, for readers that have just listed them. A fold that fails is run again.
    """
    before = folded_up_to(spark, log_path)
    last = max(map(int, subfolders(spark, log_path, "batch_id")), default=min(before))
    for b in buckets:
        if before[b] >= last:
            continue
        fresh = _log_rows(spark, log_path).filter(
            (F.col("bucket") == b) & (F.col("batch_id") > before[b]) & (F.col("batch_id") <= last)
        )
        base = _read_base(spark, log_path, before, [b])
        rows = fresh.select(ITEM_LOG.names)
        folded = latest_per_key(rows if base is None else rows.union(base), ["batch_id", "seq"])
        write_whole(folded.select(ITEM_LOG.names), f"{base_path(log_path, b)}/upto={last}", _parquet, keep_empty=True)
        for upto in subfolders(spark, base_path(log_path, b), "upto"):
            if int(upto) < before[b]:
                delete_folder(spark, f"{base_path(log_path, b)}/upto={upto}")
    for batch in subfolders(spark, log_path, "batch_id"):
        if int(batch) <= min(before):
            delete_folder(spark, f"{log_path}/batch_id={batch}")
    return last


def _parquet(writer: DataFrameWriter, path: str) -> None:
    writer.parquet(path)


def _by_bucket(writer: DataFrameWriter, path: str) -> None:
    writer.partitionBy("bucket").parquet(path)


def _json(writer: DataFrameWriter, path: str) -> None:
    writer.option("ignoreNullFields", False).json(path)


def compact_items(spark: SparkSession, log_path: str, new_log_path: str) -> None:
    """Fold a log, with its base, into a new log with a single base batch.

    Run it while the stream is stopped, then restart the stream on the new log with its old checkpoint.
    """
    folded = current_items(spark, log_path).withColumns({"seq": F.lit(0).cast("long"), "bucket": bucket_of(F.col(ITEM_KEY))})
    folded.write.mode("errorifexists").partitionBy("bucket").parquet(f"{new_log_path}/batch_id={BASE_BATCH}")


def batch_writer(
    log_path: str,
    alerts_path: str,
    ingested_at: Column | None = None,
    threshold: float = ALERT_THRESHOLD,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function with two outputs: the items, then the alerts among the written items.

    The input is read and decoded once, and nothing is cached. Each output appears whole, under the batch's number, or not at
    all; without rows there is none. A replayed batch only adds what is missing. Items are laid out by the hash of their key.
    """

    def write(keyed: DataFrame, batch_id: int) -> None:
        spark = keyed.sparkSession
        make_folder(spark, log_path)
        if batch_id <= min(folded_up_to(spark, log_path)):
            return
        now = F.current_timestamp() if ingested_at is None else ingested_at
        own = f"{log_path}/batch_id={batch_id}"
        rows = store_items(decode_records(keyed), now).withColumn("bucket", bucket_of(F.col(ITEM_KEY)))
        written = write_whole(rows, own, _by_bucket)
        if not folder_exists(spark, own):
            return
        make_folder(spark, alerts_path)
        items = spark.read.schema(STORE_ITEM).parquet(own)
        alerted = write_whole(alerts(items, threshold), f"{alerts_path}/batch_id={batch_id}", _json)
        log.info("batch %s: %s written, %s alerted", batch_id, written, alerted)

    return write


def start_upsert(
    keyed: DataFrame,
    log_path: str,
    alerts_path: str,
    checkpoint: str,
    ingested_at: Column | None = None,
    threshold: float = ALERT_THRESHOLD,
    **trigger,
) -> StreamingQuery:
    """Start the stream from a keyed frame. Bound the batches at the source (files or offsets per trigger)."""
    writer = keyed.writeStream.foreachBatch(batch_writer(log_path, alerts_path, ingested_at, threshold))
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
