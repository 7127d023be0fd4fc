"""Token files: Parquet list columns in document order that can be read selectively."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storelake.llm.encoding import encoder, vocabulary
from storelake.llm.workers import Batches, by_size, map_batches
from storelake.session import scratch_path
from storelake.sinks.files import stored

SLICE = 256  # documents handed back at a time
MOST = 4 << 20  # bytes of text encoded at a time (a longer text alone), which bounds a worker's memory

# Ids are dictionary-encoded (a vocabulary fits one dictionary page); ascending numbers are delta-encoded. Row groups and
# pages are small enough to skip, and the writer adds the page index (smallest and largest value of each page).
LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#first": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
}


def write_tokens(docs: DataFrame, path: str, name: str = "word_bpe_49k.json", kind: str = "word", end_id: int = 2) -> None:
    """Encode every whole text and write its ids in ascending order of ``doc_id``, null first.

    A row holds doc_id, ``part`` (its file), ``first`` (ids before it in that file), ``n_tokens`` and ``ids``; null and
    empty texts have the end id alone. Rows that repeat a doc_id are written next to each other, ordered by the hash of
    their text. Columns other than ``doc_id`` and ``text`` are not written. An empty table writes no rows.
    """

    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        own, part, before = encoder(vocabulary(name), kind), TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in by_size(whole, "text", MOST):
                ids, starts = own.encode(batch.column("text"), end_id)
                sizes = np.diff(starts)
                rows = pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(np.full(len(sizes), part, dtype=np.int32)),
                        pa.array(before + starts[:-1]),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids)),
                    ],
                    names=["doc_id", "part", "first", "n_tokens", "ids"],
                )
                yield from (rows.slice(at, SLICE) for at in range(0, rows.num_rows, SLICE))
                before += int(starts[-1])

    # Rows that repeat an id can be dealt over several ranges; equal ones are told apart by a number of their own.
    place = (F.col("doc_id").asc_nulls_first(), F.col("h").asc(), F.col("salt").asc())
    source = docs.select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("salt"))
    ordered = source.repartitionByRange(*place).sortWithinPartitions(*place)
    schema = "doc_id long, part int, first long, n_tokens long, ids array<int>"
    map_batches(ordered.select("doc_id", "text"), run, schema).write.options(**LAYOUT).parquet(path)


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Documents with their ids, of doc_ids from ``first`` to ``last``; row groups and pages outside are not read."""
    rows = spark.read.parquet(path)
    rows = rows if first is None else rows.filter(F.col("doc_id") >= first)
    return rows if last is None else rows.filter(F.col("doc_id") <= last)


def read_starts(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, ``start`` (ids of all documents before it) and n_tokens, without reading any ids.

    A file keeps count within itself; the sums of the files, one row each, are added up in their order.
    """
    rows = spark.read.parquet(path).select("doc_id", "part", "first", "n_tokens")
    return rows.join(_ids_before(rows), "part").select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens")


def _ids_before(rows: DataFrame) -> DataFrame:
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return stored(sums.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))


def checksums(rows: DataFrame) -> DataFrame:
    """The frame with ``ids_crc32`` (unsigned, of the ids as little-endian 32-bit integers) in place of ``ids``."""
    kept = [c for c in rows.columns if c != "ids"]
    fields = ", ".join(f"`{name}` {kind}" for name, kind in rows.select(*kept).dtypes)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            lists = batch.column("ids")
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
            data = lists.flatten().to_numpy().astype("<i4", copy=False)
            sums = [zlib.crc32(data[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(sums, type=pa.int64())], names=[*kept, "ids_crc32"]
            )

    return map_batches(rows.select(*kept, "ids"), run, f"{fields}, ids_crc32 long")


def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    path = scratch_path(spark, "tokens")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    rows = read_tokens(spark, path)
    before = _ids_before(rows.select("part", "n_tokens"))
    return checksums(rows).join(before, "part").select(
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )
