"""Requests to keyed stream messages, and messages to the records of the store."""

import logging
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType

from storelake.operators import ingest
from storelake.operators.validation import MAX_REQUEST_SIZE, PAYMENT_METHODS
from storelake.schemas import INT, LONG, TEXT, columns
from storelake.sinks.files import folder_exists, make_folder, write_whole
from storelake.sources.requests import decode_requests

log = logging.getLogger(__name__)

OFFSET_BITS = 44  # of a sequence number; the partition takes those above

# Request ids are ascending numbers; with the place in the request they order the records of a key.
MESSAGE = columns(request_id=LONG, index=INT, key=TEXT, value=TEXT)
REJECTION = columns(
    request_id=LONG, error=TEXT, errors=ArrayType(columns(index=INT, messages=ArrayType(TEXT))), batch_id=LONG
)


def messages(
    requests: DataFrame,
    now: Column,
    methods: list[str] = PAYMENT_METHODS,
    flag_threshold: float = ingest.FLAG_THRESHOLD,
    hex_digits: int | None = None,
) -> DataFrame:
    """Keyed messages of the requests that pass every rule. The same for a batch and a stream."""
    checked = ingest.check(decode_requests(requests), methods)
    return keyed_messages(checked, now, flag_threshold, hex_digits)


def keyed_messages(
    checked: DataFrame, now: Column, flag_threshold: float = ingest.FLAG_THRESHOLD, hex_digits: int | None = None
) -> DataFrame:
    built = ingest.build(ingest.accepted(checked), now, flag_threshold, hex_digits, keep=["request_id", "index"])
    record = [c for c in built.columns if c not in ("request_id", "index")]
    return ingest.to_keyed_json(built, record, keep=["request_id", "index"])


def batch_writer(
    path: str,
    now: Column | None = None,
    methods: list[str] = PAYMENT_METHODS,
    flag_threshold: float = ingest.FLAG_THRESHOLD,
    hex_digits: int | None = None,
    on_counted: Callable[[int, dict[str, int]], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function with two outputs: messages, and rejected requests with their reasons.

    Both appear whole as the batch's own folder, or not at all; without rows there is none, and a replayed batch only adds what is
    missing. Requests, rejected and sent are counted by the tasks that write the messages; they are logged, and
    handed to ``on_counted``, except for messages that were there already.
    """

    def write(requests: DataFrame, batch_id: int) -> None:
        spark = requests.sparkSession
        sent_path, rejected_path = (f"{path}/{kind}/batch_id={batch_id}" for kind in ("messages", "rejections"))
        make_folder(spark, f"{path}/messages")
        make_folder(spark, f"{path}/rejections")
        counter, known = Observation(), folder_exists(spark, sent_path)
        checked = ingest.check(decode_requests(requests), methods)
        counted = checked.observe(counter, *[c.alias(n) for n, c in ingest.request_metrics(checked).items()])
        today = F.current_timestamp() if now is None else now
        sent = keyed_messages(counted, today, flag_threshold, hex_digits)
        write_whole(sent, sent_path, lambda writer, target: writer.json(target))
        write_whole(ingest.rejections(checked), rejected_path, lambda writer, target: writer.json(target))
        if known:
            return
        try:
            counts = counter.get
        except Py4JJavaError:  # Spark drops the observation along with an input that it finds empty
            counts = {}
        counts = {name: counts.get(name) or 0 for name in ("requests", "rejected", "sent")}
        log.info("batch %s: %s", batch_id, counts)
        if on_counted:
            on_counted(batch_id, counts)

    return write


def start_publish(
    requests: DataFrame, path: str, checkpoint: str, now: Column | None = None, trigger: dict | None = None, **options
) -> StreamingQuery:
    """Publish a stream of requests as messages and rejections; ``options`` are those of ``batch_writer``."""
    writer = requests.writeStream.foreachBatch(batch_writer(path, now, **options))
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_published(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE).json(f"{path}/messages").select(MESSAGE.names)


def read_rejections(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REJECTION).json(f"{path}/rejections")


def to_records(published: DataFrame) -> DataFrame:
    """Records for the store: ``key``, ``seq`` and base64 ``data``. ``seq`` orders all records by request and place."""
    seq = F.col("request_id") * MAX_REQUEST_SIZE + F.col("index")
    return published.select("key", seq.alias("seq"), F.base64(F.col("value").cast("binary")).alias("data"))


def from_kafka(frame: DataFrame) -> DataFrame:
    """Records for the store from a Kafka frame, whose ``seq`` orders them by partition, then offset.

    A key has one partition, so this is the order of its records. Offsets of two partitions tell nothing about each other. Where a
    topic gets more partitions a key may move: let the stream catch up before, since a later batch always goes first.
    """
    seq = F.col("partition").cast("long") * (1 << OFFSET_BITS) + F.col("offset")
    return frame.select(F.col("key").cast("string").alias("key"), seq.alias("seq"), F.base64("value").alias("data"))
