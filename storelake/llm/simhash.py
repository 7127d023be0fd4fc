"""SimHash near-duplicates: fingerprints compared exactly, tile against tile."""

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.llm.components import components, spanning_links
from storelake.llm.text import bit_counts, majority_bits
from storelake.llm.workers import Batches, map_batches
from storelake.sinks.files import stored

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
TILE_ROWS = 512
WORD_BITS = 16  # a fingerprint is four words of sixteen bits, whose population counts name its tile
BLOCK_ROWS = 4096


def _fingerprints(texts: list[bytes | None], width: int) -> np.ndarray:
    hashes, sizes = [], []
    for text in texts:
        words = (text or b"").lower().split()  # bytes: A-Z only, and the six ASCII white-space characters
        joined = b" ".join(words)
        if len(words) <= width:
            own = [xxhash.xxh64_intdigest(joined, SEED)] if words else []
        else:
            lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            ends = np.cumsum(lengths + 1) - 1
            starts = (ends - lengths)[: len(words) - width + 1].tolist()
            own = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())]
        hashes.append(np.array(own, dtype=np.uint64))
        sizes.append(len(own))
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    flat = np.concatenate(hashes) if hashes else np.array([], dtype=np.uint64)
    return majority_bits(bit_counts(flat, starts), np.array(sizes))


def fingerprints(docs: DataFrame, text: str = "text", width: int = SHINGLE_WORDS, out: str = "fp") -> DataFrame:
    """The frame without its text, with the 64-bit fingerprint of each whole text as a signed long.

    Null texts and texts without a word have fingerprint zero. Other columns pass through.
    """
    kept = [c for c in docs.columns if c not in (text, out)]
    fields = ", ".join(f"`{name}` {kind}" for name, kind in docs.select(*kept).dtypes)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = _fingerprints(batch.column("__text").to_pylist(), width).view(np.int64)
            columns = [batch.column(name) for name in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found)], names=[*kept, out])

    source = docs.select(*kept, F.col(text).cast("binary").alias("__text"))
    return map_batches(source, run, ", ".join(x for x in (fields, f"`{out}` long") if x))


def _word_counts(fp: Column) -> Column:
    mask = F.lit((1 << WORD_BITS) - 1)
    return F.array(*[F.bit_count(F.shiftrightunsigned(fp, WORD_BITS * k).bitwiseAND(mask)) for k in range(64 // WORD_BITS)])


def _neighbours(radius: int) -> list[tuple[int, ...]]:
    """Differences of population counts, word by word, that can hide a distance within the radius; one of each pair of signs."""
    span = range(-radius, radius + 1)
    near = [x for x in product(span, repeat=64 // WORD_BITS) if sum(map(abs, x)) <= radius]
    return [x for x in near if x >= tuple([0] * len(x))]


def _hits(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of two sets of fingerprints as few as needed to join what lies within the radius."""
    found_a, found_b = [], []
    for at in range(0, len(left), BLOCK_ROWS):
        block = left[at : at + BLOCK_ROWS]
        differ = (block[:, None] ^ right[None, :]).view(np.uint64)  # bits of a signed number are counted without its sign
        i, j = np.nonzero((np.bitwise_count(differ) <= radius) & (differ != 0))
        if len(i):
            both = np.concatenate([block, right])
            a, b = spanning_links(i, j + len(block), len(both))
            found_a.append(both[a])
            found_b.append(both[b])
    none = np.array([], dtype=np.int64)
    return (np.concatenate(found_a), np.concatenate(found_b)) if found_a else (none, none)


def near_links(codes: DataFrame, radius: int = MAX_BITS) -> DataFrame:
    """Links ``a``, ``b`` between distinct longs of column ``fp`` that join all those within ``radius`` bits.

    Fingerprints are sorted into tiles by the population counts of their four 16-bit words. The
    distance of two fingerprints is at least the sum of the differences of these counts, so a tile
    meets only tiles whose counts differ by no more than the radius; every such pair of tiles is
    compared in full. Large tiles are cut by hash, so that none exceeds a bounded number of rows. Of the
    pairs found in a block only a spanning set is given, which joins the same fingerprints.
    """
    counted = codes.select("fp", _word_counts(F.col("fp")).alias("key"))
    per_key = counted.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / TILE_ROWS).alias("parts"))
    cut = counted.join(per_key, "key").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")))
    tiles = stored(cut.groupBy("key", "part").agg(F.collect_list("fp").alias("fps")))
    shifts = F.array(*[F.array(*[F.lit(v) for v in shift]) for shift in _neighbours(radius)])
    left = tiles.select(
        F.col("fps").alias("left"),
        F.col("key").alias("left_key"),
        F.col("part").alias("left_part"),
        F.explode(F.transform(shifts, lambda s: F.zip_with("key", s, lambda x, y: x + y))).alias("key"),
    )
    pairs = left.join(tiles, "key").filter((F.col("left_key") != F.col("key")) | (F.col("left_part") <= F.col("part")))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            lefts, rights = batch.column("left"), batch.column("fps")
            ends = np.concatenate([[0], np.cumsum(lefts.value_lengths().to_numpy())])
            flat = lefts.flatten().to_numpy()
            tile = batch.column("tile").to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1], [True]]))
            found = [
                _hits(flat[ends[a] : ends[b]], rights[int(a)].values.to_numpy(), radius)
                for a, b in zip(edges[:-1], edges[1:])
            ]
            if found:
                columns = [pa.array(np.concatenate([x[k] for x in found])) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    sent = pairs.select("left", "fps", F.xxhash64("key", "part").alias("tile"))
    return map_batches(sent, run, "a long, b long")


def classes(codes: DataFrame, radius: int = MAX_BITS) -> DataFrame:
    """``fp`` and ``class`` for distinct longs ``fp``: equal classes reach each other by links within the radius."""
    linked = components(near_links(codes, radius))
    return codes.join(linked, codes["fp"] == linked["node"], "left").select(
        "fp", F.coalesce("component", "fp").alias("class")
    )


def _classified(docs: DataFrame, text: str, width: int, radius: int, identity: str) -> DataFrame:
    rows = stored(fingerprints(docs, text, width))
    codes = stored(rows.groupBy("fp").agg(F.min(identity).alias("least")))
    labelled = stored(classes(codes.select("fp"), radius))
    named = codes.join(labelled, "fp")
    least = stored(named.groupBy("class").agg(F.min("least").alias("component_id")))
    by_code = stored(labelled.join(least, "class").select("fp", "class", "component_id"))
    return rows.join(by_code, "fp").select(*rows.columns, "class", "component_id")


def near_duplicates(
    docs: DataFrame, text: str = "text", width: int = SHINGLE_WORDS, radius: int = MAX_BITS, identity: str = "doc_id"
) -> DataFrame:
    """All rows without their text, with ``fp`` and ``component_id``, the smallest identity that links reach.

    Rows of one fingerprint are always linked; null and empty texts share fingerprint zero, which is
    linked like any other. Rows whose identity is null take part and are never the smallest; a group of
    such rows alone has a null component. Repeated rows are kept. Input columns named ``fp``, ``class`` or
    ``component_id`` are replaced. An empty table gives an empty table.
    """
    return _classified(docs.drop("class", "component_id"), text, width, radius, identity).drop("class")


def one_of_each(
    docs: DataFrame, text: str = "text", width: int = SHINGLE_WORDS, radius: int = MAX_BITS, identity: str = "doc_id"
) -> DataFrame:
    """One whole row of each near-duplicate group: smallest identity (null last), then smallest hash of the row.

    Rows equal in every column come back once at most. Null and empty texts are one group, with whatever lies near to it.
    """
    columns = docs.columns
    key = {"__h": F.xxhash64(*columns), "__i": F.coalesce(F.col(identity), F.lit((1 << 63) - 1))}
    rows = docs.withColumns(key)
    found = _classified(rows.select(identity, text, "__h", "__i"), text, width, radius, identity)
    place = F.struct("__i", "__h")
    best = stored(found.groupBy("class").agg(F.min(place).alias("best")).select("best.__h", "best.__i"))
    kept = rows.join(best, ["__h", "__i"], "left_semi")
    one = F.first(F.struct(*columns)).alias("__row")  # of equal rows, combined before the shuffle
    return kept.groupBy("__h", "__i").agg(one).select("__row.*")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of each document."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
