"""Approximate nearest neighbours: multi-index hashing over learned rotated binary codes, reranked on the vectors."""

from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storelake.llm.workers import Batches, find_package, map_batches
from storelake.sinks.files import stored, stored_counted

SAMPLE = 4096  # vectors that rotations and radius are fitted on, those of the smallest hashes
ROTATIONS = 4
ITERATIONS = 20
COVER = 0.985  # share of true neighbours within the sample that the radius must reach
SHARD = 2048  # vectors of one part of the index
BLOCK = 1024  # queries sent to a part at once
AT_ONCE = 128  # queries that probe together


@dataclass(frozen=True)
class Coder:
    mean: np.ndarray
    rotation: np.ndarray
    radius: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """One row of bytes for each vector: the signs of its rotated coordinates."""
        return np.packbits((vectors - self.mean) @ self.rotation > 0, axis=1)


def fit(sample: np.ndarray, k: int = 10, rotations: int = ROTATIONS, cover: float = COVER) -> Coder:
    """Rotations whose signs lose least, each found from a random start by alternating with a Procrustes step.

    The radius is the code distance within which the given share of the sample's own k nearest neighbours lies. In a
    larger table neighbours are nearer than in the sample, so the share reached there is larger.
    """
    mean = sample.mean(axis=0)
    centred = sample - mean
    found = []
    for seed in range(rotations):
        turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(sample.shape[1],) * 2))[0]
        for _ in range(ITERATIONS):
            u, _, v = np.linalg.svd(centred.T @ np.sign(centred @ turn))
            turn = u @ v
        found.append(turn)
    coder = Coder(mean, np.hstack(found), 0)
    codes = coder.codes(sample)
    asked = np.arange(0, len(sample), max(1, len(sample) // 512))
    reach = []
    for q in asked:
        far = ((sample - sample[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        near = np.argsort(far)[: min(k, len(sample) - 1)]
        reach += np.bitwise_count(codes[near] ^ codes[q]).sum(axis=1).tolist()
    radius = int(np.ceil(np.quantile(reach, cover))) if reach else 8 * codes.shape[1]
    return Coder(mean, coder.rotation, radius)


class SubstringTables:
    """Codes with a table for each substring of 16 bits: the values that occur, in order, and the codes that hold each."""

    def __init__(self, codes: np.ndarray):
        self.codes = _columns(codes, "<u8")
        self.tables = []
        for values in _columns(codes, "<u2").T:
            order = np.argsort(values, kind="stable")
            present, starts = np.unique(values[order], return_index=True)
            self.tables.append((present, np.append(starts, len(order)), order))

    def _probe(self, table: int, asked: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Queries and codes whose substrings differ in ``least`` to ``most`` bits, from one table.

        Where there are fewer values so near than values in the table, each is looked up; else the table's values are gone through.
        """
        present, starts, order = self.tables[table]
        flips = _flips(least, most)
        if len(flips) < len(present):
            probes = asked[:, None] ^ flips
            at = np.minimum(np.searchsorted(present, probes), len(present) - 1)
            query, hit = np.nonzero(present[at] == probes)
            value = at[query, hit]
        else:
            differ = np.bitwise_count(asked[:, None] ^ present)
            query, value = np.nonzero((differ >= least) & (differ <= most))
        sizes = starts[value + 1] - starts[value]
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return np.repeat(query, sizes), order[np.repeat(starts[value], sizes) + inside]

    def within(self, queries: np.ndarray, radius: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Which codes lie within which queries' radius, and how many codes each query met in the tables.

        Two codes within ``radius`` bits agree up to ``radius // m`` bits in one of the first ``radius % m + 1`` of m
        substrings, or up to one bit less in one of the others. A query that finds fewer than ``least`` codes goes on:
        its radius is widened bit by bit, and each bit probes one table for the values that have come within reach.
        """
        asked, whole, m = _columns(queries, "<u2"), _columns(queries, "<u8"), len(self.tables)
        met = np.zeros((len(queries), len(self.codes)), dtype=bool)
        least = min(least, len(self.codes))
        share, rest = divmod(radius, m)
        for table in range(m):
            bits = share if table <= rest else share - 1
            if bits >= 0:
                met[self._probe(table, asked[:, table], 0, bits)] = True
        distance = np.full(met.shape, 16 * m + 1, dtype=np.int32)
        query, code = np.nonzero(met)
        distance[query, code] = _distances(whole, self.codes, query, code)
        found = distance <= radius
        short = np.flatnonzero(found.sum(axis=1) < least)
        while short.size:
            radius += 1
            share, table = divmod(radius, m)
            query, code = self._probe(table, asked[short, table], share, share)
            new = ~met[short[query], code]
            query, code = short[query[new]], code[new]
            met[query, code] = True
            distance[query, code] = _distances(whole, self.codes, query, code)
            found[short] = distance[short] <= radius
            short = short[found[short].sum(axis=1) < least]
        return found, met.sum(axis=1)


def _columns(codes: np.ndarray, kind: str) -> np.ndarray:
    """Codes as columns of whole numbers, the last filled up with zeros."""
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.pad(codes, ((0, 0), (0, -codes.shape[1] % width)))).view(kind)


@cache
def _flips(least: int, most: int) -> np.ndarray:
    """All values of 16 bits with so many bits set."""
    values = np.arange(1 << 16, dtype=np.uint16)
    bits = np.bitwise_count(values)
    return values[(bits >= least) & (bits <= most)]


def _distances(queries: np.ndarray, codes: np.ndarray, query: np.ndarray, code: np.ndarray) -> np.ndarray:
    out = np.empty(len(query), dtype=np.int32)
    for at in range(0, len(query), 1 << 16):
        part = slice(at, at + (1 << 16))
        out[part] = np.bitwise_count(queries[query[part]] ^ codes[code[part]]).sum(axis=1)
    return out


def _usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fit_for_use = F.col(id_column).isNotNull() & v.isNotNull() & ~odd & F.exists(v, lambda x: x != 0)
    return vectors.filter(fit_for_use).select(F.col(id_column).cast("long").alias("id"), v.cast("array<double>").alias("vector"))


def build_index(rows: DataFrame, k: int, seed_rows: int = SAMPLE) -> tuple[DataFrame, int, Coder | None]:
    """Distinct vectors with their codes and smallest ``k + 1`` ids (no query needs more), their number, and the coder.

    Equal vectors are gathered in two steps, dealt over parts by id first, so that no task meets a large group whole.
    """
    few = F.slice(F.array_sort(F.collect_set("id")), 1, k + 1)
    parts = rows.groupBy("vector", F.pmod(F.xxhash64("id"), F.lit(64)).alias("part")).agg(few.alias("ids"))
    merged = parts.groupBy("vector").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids"))
    distinct, total = stored_counted(merged)
    drawn = distinct.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(seed_rows).toPandas()["vector"]
    if not total:
        return distinct, 0, None
    coder = fit(np.stack(drawn.to_numpy()), k)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows:
                flat = batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, -1)
                codes = pa.array([row.tobytes() for row in coder.codes(flat)], type=pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vector"), batch.column("ids"), codes], names=["vector", "ids", "code"]
                )

    return stored(map_batches(distinct, run, "vector array<double>, ids array<long>, code binary")), total, coder


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id`` and ``score`` (Euclidean distance) of the k nearest found for each query.

    Queries are rows of the same form as ``vectors`` and do not find their own id. Each meets the vectors of its own
    length; there is one index for each length that queries have. Null, zero and non-finite vectors and vectors without
    an id take no part. Ties go to smaller ids; rows that repeat id and vector count once. No queries or no vectors: no rows.
    """
    usable = _usable(vectors, id_column, vector).withColumn("length", F.size("vector"))
    asked = stored(_usable(queries, id_column, vector).distinct().withColumn("length", F.size("vector")))
    lengths = sorted((row["length"], row["n"]) for row in asked.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect())
    found = vectors.sparkSession.createDataFrame([], "query_id long, rank int, id long, score double")
    for length, n in lengths:
        own = [df.filter(F.col("length") == length).drop("length") for df in (usable, asked)]
        found = found.union(_search(*own, n, k))
    return found


def _search(usable: DataFrame, asked: DataFrame, n_queries: int, k: int) -> DataFrame:
    """The search among vectors of one length.

    The index is cut into parts of a bounded number of vectors. Every block of queries goes to every part, which probes
    its substring tables, reranks what lies within the radius, and gives at most k for each query; where fewer lie
    within it the radius is widened.
    """
    index, total, coder = build_index(usable, k)
    if not total:
        return usable.sparkSession.createDataFrame([], "query_id long, rank int, id long, score double")
    shards, blocks = max(1, -(-total // SHARD)), max(1, -(-n_queries // BLOCK))
    parts = index.select(
        "*", F.pmod(F.xxhash64("vector"), F.lit(shards)).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    )
    every_part = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard")
    sent = asked.select("id", "vector", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), every_part)

    def near(part: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if part.empty or block.empty:
            return pd.DataFrame({"query_id": [], "id": [], "score": []})
        own, asking = np.stack(part["vector"].to_numpy()), np.stack(block["vector"].to_numpy())
        tables = SubstringTables(np.frombuffer(b"".join(part["code"]), dtype=np.uint8).reshape(len(part), -1))
        marks, ids, names, out = coder.codes(asking), part["ids"].to_numpy(), block["id"].to_numpy(), []
        for first in range(0, len(block), AT_ONCE):
            found, _ = tables.within(marks[first : first + AT_ONCE], coder.radius, k + 1)
            for row, hits in enumerate(found, first):
                at = np.flatnonzero(hits)
                score = np.sqrt(((own[at] - asking[row]) ** 2).sum(axis=1))
                last = np.partition(score, min(k, len(score) - 1))[min(k, len(score) - 1)]
                pairs = sorted((s, int(i)) for p, s in zip(at[score <= last], score[score <= last]) for i in ids[p] if i != names[row])
                out += [(names[row], i, s) for s, i in pairs[:k]]
        return pd.DataFrame(out, columns=["query_id", "id", "score"])

    find_package(usable.sparkSession)
    both = parts.groupBy("shard", "block").cogroup(sent.groupBy("shard", "block"))
    local = both.applyInPandas(near, "query_id long, id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "id")
    ranked = local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found for each vector whose id is divisible by 100."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = search(rows, rows.filter(F.col("vec_id") % 100 == 0))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
