"""Hard negatives by inner product: length buckets with sorted coordinate lists, pruned before exact verification."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storelake.llm.workers import find_package
from storelake.sinks.files import stored

BUCKET = 4096  # vectors of one bucket
BLOCK = 1024  # anchors sent to a bucket at once
FOCUS = 4  # coordinates whose feasible ranges are intersected
LEVELS = 4  # length classes to a doubling of the length

SLACK = 1e-6  # far beyond what rounding moves a cosine
LOW, HIGH = -(1 << 62), 1 << 62

SCHEMA = "anchor bigint, wish int, row bigint, id bigint, score bigint"


def _vectors(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy().reshape(len(flat), -1)


def _products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers; in doubles where these hold every sum exactly."""
    largest = np.abs(vectors).max(initial=0).astype(float) * np.abs(query).max(initial=0) * max(1, len(query))
    if largest < 2.0**52:
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    if largest >= 2.0**62:
        raise OverflowError("an inner product does not fit a long")
    return vectors @ query


class Bucket:
    """Vectors of similar length with one sorted list of each coordinate of their directions."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        self.longest = lengths.max(initial=0.0)
        directions = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        self.order = np.argsort(directions, axis=0)
        self.sorted = np.take_along_axis(directions, self.order, axis=0)

    def candidates(self, query: np.ndarray, least: float, focus: int) -> np.ndarray:
        """Places of all vectors whose inner product with the query may be ``least`` or more.

        With a the angle that has the query's coordinate as cosine and g the largest angle to a vector that is good enough,
        the vector's coordinate is a cosine of an angle between a - g and a + g. A vector must be in the range of every
        focus coordinate, the query's largest ones.
        """
        length = float(np.sqrt((query.astype(np.float64) ** 2).sum()))
        reach = length * self.longest
        every = np.arange(len(self.vectors))
        if least <= 0 or reach == 0:
            return every if least <= 0 else every[:0]
        cosine = least / reach * (1 - 1e-9)
        if cosine > 1:
            return every[:0]
        direction = query / length
        chosen = np.argsort(-np.abs(direction), kind="stable")[:focus]
        angle, wide = np.arccos(np.clip(direction[chosen], -1, 1)), np.arccos(cosine)
        low = np.cos(np.minimum(np.pi, angle + wide)) - SLACK
        high = np.cos(np.maximum(0, angle - wide)) + SLACK
        spans = []
        for k, f in enumerate(chosen.tolist()):
            values = self.sorted[:, f]
            spans.append((np.searchsorted(values, low[k]), np.searchsorted(values, high[k], side="right"), f))
        spans.sort(key=lambda s: s[1] - s[0])
        hits = np.zeros(len(self.vectors), dtype=np.int8)
        for a, b, f in spans:
            hits[self.order[a:b, f]] += 1
        return np.flatnonzero(hits == len(spans))


def _best(bucket: Bucket, part: dict, asked: dict, same: bool, k: int, focus: int) -> list[tuple]:
    """At most k rows of the bucket for each wish of each anchor: highest scores first, then smaller ids."""
    out = []
    for n, query in enumerate(asked["vector"]):
        lows, highs = asked["lows"][n], asked["highs"][n]
        if not lows:
            continue
        at = bucket.candidates(query, float(min(lows)), focus)
        alike = part["label"][at] == asked["label"][n]
        at = at[(alike & (part["row"][at] != asked["row"][n])) if same else ~alike]
        scores = _products(bucket.vectors[at], query)
        order = np.lexsort((part["row"][at], part["id"][at], -scores))
        at, scores = at[order], scores[order]
        for wish, (low, high) in enumerate(zip(lows, highs)):
            begin = int(np.searchsorted(-scores, -high))
            end = min(int(np.searchsorted(-scores, -low, side="right")), begin + k)
            out += [
                (asked["row"][n], wish, part["row"][i], part["id"][i], s)
                for i, s in zip(at[begin:end], scores[begin:end].tolist())
            ]
    return out


def _meet(buckets: DataFrame, wishes: DataFrame, keys: list[str], same: bool, k: int, focus: int) -> DataFrame:
    """The best of each bucket for the anchors sent to it."""

    def best(part: pa.Table, asked: pa.Table) -> pa.Table:
        rows = []
        if part.num_rows and asked.num_rows:
            own = {c: part.column(c).to_numpy() for c in ("row", "id", "label")}
            asks = {c: asked.column(c).to_numpy() for c in ("row", "label")}
            asks |= {"vector": _vectors(asked.column("vector"))}
            asks |= {c: asked.column(c).to_pylist() for c in ("lows", "highs")}
            rows = _best(Bucket(_vectors(part.column("vector"))), own, asks, same, k, focus)
        columns = list(zip(*rows)) if rows else [[]] * 5
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["anchor", "wish", "row", "id", "score"]
        return pa.Table.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds)], names=names)

    find_package(buckets.sparkSession)
    return buckets.groupBy(*keys).cogroup(wishes.groupBy(*keys)).applyInArrow(best, SCHEMA)


def _length_class(length: Column) -> Column:
    return F.when(length > 0, F.floor(F.log2(length) * LEVELS)).otherwise(-1).cast("int")


def build_index(rows: DataFrame, bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """Rows (row, id, label, vector) with dim, class and part, and the number of parts of each dim and class.

    A class holds vectors whose lengths differ by less than a quarter of a doubling; there are at most 250. It is cut by hash into
    parts, its buckets. Vectors of another number of components are in other classes.
    """
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    sized = stored(rows.withColumns({"dim": F.size("vector"), "class": _length_class(length), "norm": length}))
    parts = stored(
        sized.groupBy("dim", "class").agg(
            F.ceil(F.count(F.lit(1)) / bucket).alias("parts"), F.max("norm").alias("longest")
        )
    )
    return stored(sized.join(parts, ["dim", "class"]).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))), parts


def _top(
    index: DataFrame, parts: DataFrame, wishes: DataFrame, same: bool, k: int, blocks: int, focus: int
) -> DataFrame:
    """The k best rows for each wish (a range of scores) of each anchor, over all buckets.

    Every anchor meets one bucket first, a long one; the k-th score found there is a lower bound that prunes all others. A
    bucket whose longest vector cannot reach the bound is not visited.
    """
    keys = ["dim", "class", "part", "block"]
    asked = stored(wishes.withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int")))
    numbered = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    longest = parts.groupBy("dim").agg(F.max_by(F.struct("class", "parts"), "class").alias("top"))
    first = asked.join(longest, "dim").select(
        *asked.columns, F.col("top.class").alias("class"), F.pmod(F.xxhash64("row"), F.col("top.parts")).alias("part")
    )
    seen = stored(_meet(numbered, first, keys, same, k, focus))
    full = seen.groupBy("anchor", "wish").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    bounds = full.filter(F.col("n") == k).groupBy("anchor").agg(
        F.map_from_entries(F.collect_list(F.struct("wish", "least"))).alias("bounds")
    )
    raised = F.transform("lows", lambda low, n: F.greatest(low, F.coalesce(F.try_element_at("bounds", n), low)))
    tight = asked.join(bounds, asked["row"] == bounds["anchor"], "left").select(
        *[c for c in asked.columns if c != "lows"], raised.alias("lows")
    )
    everywhere = tight.join(parts, "dim").filter(
        (F.array_min("lows") <= 0) | (F.col("norm") * F.col("longest") * (1 + 1e-9) >= F.array_min("lows"))
    )
    sent = everywhere.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    found = _meet(numbered, sent, keys, same, k, focus)
    order = Window.partitionBy("anchor", "wish").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    anchors: Column,
    n_positives: int = 5,
    n_negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    id_column: str = "vec_id",
    vector: str = "vector",
    label: str = "label",
    bucket: int = BUCKET,
    block: int = BLOCK,
    focus: int = FOCUS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score over vectors of whole numbers.

    A score is the inner product with the anchor; higher ones come first, then smaller ids. Positives are the first rows of the
    anchor's label other than itself. Negatives are the first rows of another label whose score is between
    the given percentages of the positive's; a positive without one gives no row, so one of negative score gives
    none either. Rows with a null id, label, vector or component take no part. Repeated rows count each on its own, also as
    anchors; ties of score and id go by an arbitrary fixed order. Vectors meet vectors of the same
    number of components only; empty ones take no part. A product beyond a long is an error. Other columns are not read. No anchors or
    no rows: no result.

    The result is exact: pruning leaves out only vectors whose direction shows that their score is below a bound
    that enough others reach.
    """
    whole = F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull())
    usable = rows.filter(F.col(id_column).isNotNull() & F.col(label).isNotNull() & whole).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<bigint>").alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("asks"),
    )
    index, parts = build_index(usable, bucket)
    asking = stored(index.filter("asks").select("row", "id", "label", "vector", "dim", "norm"))
    blocks = max(1, -(-asking.count() // block))
    index = index.select("row", "id", "label", "vector", "dim", "class", "part")
    anything = asking.drop("id").withColumns(
        {"lows": F.array(F.lit(LOW).cast("long")), "highs": F.array(F.lit(HIGH).cast("long"))}
    )
    positives = stored(
        _top(index, parts, anything, True, n_positives, blocks, focus).select(
            "anchor", F.col("rank").alias("nth"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
        )
    )
    score = F.col("positive_score").cast("decimal(38,0)")
    wanted = positives.select(
        "anchor",
        F.struct(
            "nth",
            F.ceil(score * low_percent / 100).cast("long").alias("low"),
            F.floor(score * high_percent / 100).cast("long").alias("high"),
        ).alias("wish"),
    ).filter(F.col("wish.low") <= F.col("wish.high"))
    listed = wanted.groupBy("anchor").agg(F.array_sort(F.collect_list("wish")).alias("wishes"))
    ranged = asking.drop("id").join(listed, asking["row"] == listed["anchor"]).select(
        *[c for c in asking.columns if c != "id"],
        F.transform("wishes", lambda w: w["low"]).alias("lows"),
        F.transform("wishes", lambda w: w["high"]).alias("highs"),
        F.transform("wishes", lambda w: w["nth"]).alias("nths"),
    )
    asked = stored(ranged)
    negatives = _top(index, parts, asked.drop("nths"), False, n_negatives, blocks, focus)
    numbered = asked.select(F.col("row").alias("anchor"), F.posexplode("nths").alias("wish", "nth"))
    return (
        negatives.select("anchor", "wish", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(numbered, ["anchor", "wish"])
        .join(positives, ["anchor", "nth"])
        .join(asking.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def whole_vectors(rows: DataFrame, vector: str = "embedding") -> Column:
    """floor(256 * x) of each component, null for a vector that holds a null or non-finite one."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~odd, F.transform(v, lambda x: F.floor(x.cast("double") * 256)))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of each vector whose id is divisible by 100, with some labels moved on by one."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    given = rows.select("vec_id", label.alias("label"), whole_vectors(rows).alias("vector"))
    return mine(given, F.col("vec_id") % 100 == 0)


ORACLE = """
with v as (
    select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
    from embeddings
    where label is not null and embedding is not null and vec_id is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scores as (
    select a.r as a, a.vec_id as anchor_id, a.label as own, b.r as b, b.vec_id as vec_id, b.label as label,
           cast(list_dot_product(a.v, b.v) as bigint) as score
    from v a join v b on a.vec_id % 100 = 0 and len(a.v) = len(b.v)
), positives as (
    select a, anchor_id, own, vec_id as positive_id, score as positive_score, b
    from scores where label = own and a <> b
    qualify row_number() over (partition by a order by score desc, vec_id, b) <= 5
)
select p.anchor_id, positive_id,
       cast(row_number() over (partition by p.a, p.b order by score desc, vec_id, n.b) as int) as rank,
       vec_id as negative_id, positive_score, score as negative_score
from positives p join scores n on n.a = p.a and n.label <> p.own
 and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by p.a, p.b order by score desc, vec_id, n.b) <= 10
"""
