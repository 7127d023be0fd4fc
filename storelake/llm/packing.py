"""Best-fit packing of documents into sequences, in rounds over as many partitions as the leftovers need."""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.llm.encoding import encoder, vocabulary
from storelake.llm.workers import Batches, map_batches
from storelake.sinks.files import stored, stored_counted

CAPACITY = 2048
SLACK = 4  # a sequence with so few places left is emitted before the last round
ROWS = 32_768  # items packed by one task
LEAST = 32  # a round that joins less than one in so many of its items is the last, which bounds the rounds
SLICE = 256

MEMBER = "struct<doc_id: bigint, piece: int, start: bigint, length: bigint, ids_crc32: bigint, offset: bigint>"


def pieces(
    docs: DataFrame, capacity: int = CAPACITY, name: str = "byte_bpe_50k.json", kind: str = "byte", end_id: int = 0
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every whole text, which is closed by ``end_id``.

    Only longer documents are cut, the first piece being the short one. Null and empty texts are one piece of the
    end id alone.
    """

    def run(batches: Batches) -> Batches:
        own = encoder(vocabulary(name), kind)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                ids, starts = own.encode(batch.column("text"), end_id)
                sizes = np.diff(starts)
                cuts = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), cuts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                short = sizes - (cuts - 1) * capacity
                begin = np.where(piece == 0, 0, short[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, short[row], capacity)
                first = starts[row] + begin
                data = ids.astype("<i4", copy=False)
                sums = [zlib.crc32(data[a:b]) for a, b in zip(first, first + length)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(row)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(begin),
                        pa.array(length),
                        pa.array(sums, type=pa.int64()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """A bin for each item and the number of bins: largest first, each where least room is left over.

    Bins are kept by the room they have left; the set of rooms in use is one large integer, whose lowest bit from an
    item's size on is the best fit.
    """
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, bins = 0, 0
    found = np.empty(len(sizes), dtype=np.int64)
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        above = used >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            own = rooms[room].pop()
            if not rooms[room]:
                used &= ~(1 << room)
        else:
            room, own = capacity, bins
            bins += 1
        found[item] = own
        left = room - size
        if left:
            rooms[left].append(own)
            used |= 1 << left
    return found, bins


def _round(capacity: int, number: int):
    """Pack the rows (members and their joint length) of one partition; each bin becomes a row."""

    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        whole = [batch for batch in batches if batch.num_rows]
        if not whole:
            return
        table = pa.Table.from_batches(whole).combine_chunks()
        members, sizes = table.column("members").chunk(0), table.column("fill").to_numpy()
        own, bins = best_fit(sizes, capacity)
        order = np.argsort(own, kind="stable")
        taken = members.take(pa.array(order))
        per_bin = np.bincount(own, weights=members.value_lengths().to_numpy(), minlength=bins).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(per_bin)])
        flat = taken.flatten()
        lengths = pc.struct_field(flat, "length").to_numpy()
        before = np.cumsum(lengths) - lengths
        offset = before - np.repeat(before[ends[:-1]], per_bin)
        fields = [pc.struct_field(flat, k) for k in ("doc_id", "piece", "start", "length", "ids_crc32")]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "offset"]
        packed = pa.StructArray.from_arrays([*fields, pa.array(offset)], names=names)
        fill = np.bincount(own, weights=sizes, minlength=bins).astype(np.int64)
        first = (number << 54) + (TaskContext.get().partitionId() << 32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(first + np.arange(bins)),
                pa.array(fill),
                pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), packed),
            ],
            names=["sequence_id", "fill", "members"],
        )

    return run


def pack(items: DataFrame, capacity: int = CAPACITY, slack: int = SLACK, rows: int = ROWS) -> DataFrame:
    """``sequence_id`` and ``offset`` for pieces (doc_id, piece, start, length, ids_crc32), gapless from offset 0.

    Each partition is packed by best fit, largest piece first. Sequences with at most ``slack`` places left are done, and
    so are those with less room than the smallest leftover fills; the others become the items of the next round, over one
    partition for each ``rows`` of them. Once there is one partition, or a round has joined less than one in 32 of its items, all
    are done. A round is written before it is divided, so that a repeated task cannot pack a piece
    twice. Lengths must lie between 1 and the capacity. Repeated rows are packed each; an empty table gives no rows.
    """
    item, total = stored_counted(items)
    member = F.struct(*[c for c in item.columns], F.lit(0).cast("long").alias("offset"))
    left = item.select(F.col("length").alias("fill"), F.array(member).alias("members"))
    done, number, parts, before = [], 0, max(1, -(-total // rows)), total
    while True:
        schema = f"sequence_id long, fill long, members array<{MEMBER}>"
        packed = stored(map_batches(left.repartition(parts), _round(capacity, number), schema))
        if parts == 1:
            done.append(packed)
            break
        # The smallest sequence with room decides which of them anything can still be put into.
        open_ones = packed.filter(F.col("fill") < capacity - slack)
        smallest = open_ones.agg(F.min("fill")).first()[0]
        most = -1 if smallest is None else min(capacity - slack - 1, capacity - smallest)
        count = packed.agg(F.count(F.when(F.col("fill") <= most, 1)), F.count(F.lit(1))).first()
        if count[0] < 2 or before - count[1] < before / LEAST:
            done.append(packed)
            break
        done.append(packed.filter(F.col("fill") > most))
        left = packed.filter(F.col("fill") <= most).select("fill", "members")
        number, parts, before = number + 1, -(-count[0] // rows), count[0]
    whole = done[0]
    for more in done[1:]:
        whole = whole.union(more)
    return whole.select("sequence_id", F.inline("members")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack(pieces(spark.read.parquet(f"{sf_dir}/documents.parquet")))
