"""Benchmark decontamination: suffix arrays of the training texts, searched for every suffix of the test items."""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.llm.suffixes import Suffixes
from storelake.llm.words import PLAIN, hashed_words, slices
from storelake.llm.workers import Batches, map_batches

WINDOW = 10  # words of an item that count as a hit
BLOCK_WORDS = 1 << 20  # words of the items searched for in one pass over the documents, at least one item

SPAN = "array<struct<start: bigint, end: bigint>>"


@dataclass
class Block:
    """Some items: the hashes of their words, the suffixes to search for, and the windows among them."""

    ids: list[str | None]  # of the items
    words: np.ndarray
    begin: np.ndarray  # where an item's words begin in ``words``, one more entry than there are items
    item: np.ndarray = field(init=False)  # of each suffix long enough to hold a window
    at: np.ndarray = field(init=False)  # its place in ``words``
    size: np.ndarray = field(init=False)  # words that make up its window
    rest: np.ndarray = field(init=False)  # words up to the end of its item
    window: np.ndarray = field(init=False)  # equal windows have one number

    def cut(self, width: int) -> "Block":
        n = np.diff(self.begin)
        size = np.minimum(n, width)
        count = np.where(n > 0, n - size + 1, 0)
        self.item = np.repeat(np.arange(len(n)), count)
        self.at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + self.begin[self.item]
        self.size = size[self.item]
        self.rest = self.begin[self.item + 1] - self.at
        known: dict[bytes, int] = {}
        spans = zip(self.at.tolist(), self.size.tolist())
        self.window = np.array([known.setdefault(self.words[a : a + s].tobytes(), len(known)) for a, s in spans], dtype=np.int64)
        return self


def blocks(items: DataFrame, item_id: str, text: str, width: int, most: int) -> Iterator[Block]:
    """The items in blocks of at most ``most`` words or of one item; the driver holds one block and one partition."""
    ids, found, words = [], [], 0
    for row in items.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text")).toLocalIterator():
        own, _ = hashed_words(pa.array([row["text"]], type=pa.string()), PLAIN)
        if not len(own):
            continue
        if ids and words + len(own) > most:
            yield Block(ids, np.concatenate(found), np.cumsum([0, *map(len, found)])).cut(width)
            ids, found, words = [], [], 0
        ids.append(row["id"])
        found.append(own)
        words += len(own)
    if ids:
        yield Block(ids, np.concatenate(found), np.cumsum([0, *map(len, found)])).cut(width)


class Shard:
    """The suffix array of some texts. Texts end with symbol 0, so that no match runs from one into the next."""

    def __init__(self, texts: pa.Array, depth: int):
        hashes, starts = hashed_words(texts, PLAIN)
        self.sizes = np.diff(starts)
        coded = pa.array(hashes.view(np.int64)).dictionary_encode()
        self.dictionary = coded.dictionary
        self.begin = starts[:-1] + np.arange(len(self.sizes))
        symbols = np.zeros(len(hashes) + len(self.sizes), dtype=np.int64)
        of = np.repeat(np.arange(len(self.sizes)), self.sizes)
        symbols[np.arange(len(hashes)) + of] = coded.indices.to_numpy() + 1
        self.suffixes = Suffixes(symbols, depth)

    def symbols(self, words: np.ndarray) -> np.ndarray:
        """Symbols of other words; -1 for words that do not occur."""
        found = pc.index_in(pa.array(words.view(np.int64)), value_set=self.dictionary)
        return pc.fill_null(pc.add(found.cast(pa.int64()), 1), -1).to_numpy(zero_copy_only=False)

    def text_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, places, side="right") - 1


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of some ranges, with the range that each comes from."""
    count = high - low
    source = np.repeat(np.arange(len(low)), count)
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[source], source


def _occurrences(shard: Shard, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Places at which a window of the block occurs, with the number of one of the suffixes that have it."""
    symbols = shard.symbols(block.words)
    _, first = np.unique(block.window, return_index=True)
    unknown = np.concatenate([[0], np.cumsum(symbols < 0)])
    first = first[unknown[block.at[first] + block.size[first]] == unknown[block.at[first]]]
    low, high = shard.suffixes.find(symbols, block.at[first], block.size[first])
    slots, source = _spread(low, high)
    return shard.suffixes.order[slots], first[source]


def _ranges(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def _lists(of: np.ndarray, count: int, values: pa.Array) -> pa.Array:
    """A list for each of ``count`` rows from values sorted by their row."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(count + 1)).astype(np.int32)), values)


def _search(texts: pa.Array, spans: pa.Array, named: pa.Array, block: Block, width: int) -> list[pa.Array]:
    """Words, hit ranges and items of some texts, added to those of earlier blocks."""
    shard = Shard(texts, width)
    n, total = len(shard.sizes), len(shard.suffixes.symbols)
    places, suffix = _occurrences(shard, block)
    change = np.bincount(places, minlength=total + 1) - np.bincount(places + block.size[suffix], minlength=total + 1)
    old = spans.flatten()
    of_old = np.repeat(np.arange(n), spans.value_lengths().fill_null(0).to_numpy())
    if len(old):
        change[: total + 1] += np.bincount(old.field("start").to_numpy() + shard.begin[of_old], minlength=total + 1)
        change[: total + 1] -= np.bincount(old.field("end").to_numpy() + shard.begin[of_old], minlength=total + 1)
    starts, ends = _ranges(np.cumsum(change)[:total] > 0)
    of = shard.text_of(starts)
    ranges = pa.StructArray.from_arrays(
        [pa.array(starts - shard.begin[of]), pa.array(ends - shard.begin[of])], names=["start", "end"]
    )
    # Items of the windows: one pair for each text and window, then one for each text and item.
    windows = int(block.window.max()) + 1
    pairs = np.unique(shard.text_of(places) * windows + block.window[suffix])
    by_window = np.argsort(block.window, kind="stable")
    edges = np.searchsorted(block.window[by_window], np.arange(windows + 1))
    slots, source = _spread(edges[pairs % windows], edges[pairs % windows + 1])
    both = np.unique((pairs // windows)[source] * len(block.ids) + block.item[by_window[slots]])
    rows = [set(x or ()) for x in named.to_pylist()]
    for row, item in zip((both // len(block.ids)).tolist(), (both % len(block.ids)).tolist()):
        if block.ids[item] is not None:
            rows[row].add(block.ids[item])
    return [
        pa.array(shard.sizes),
        _lists(of, n, ranges),
        pa.array([sorted(x) for x in rows], type=pa.list_(pa.string())),
    ]


def hits(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """All documents without their text, with ``n_words``, ``spans`` and ``items``: what of the items they hold.

    Words are runs of digits, letters A-Z in lower case and characters beyond ASCII. A window is ``width`` consecutive
    words of an item, or all words of a shorter one. ``spans`` are the ranges of words (from, up to) inside any occurrence of
    a window, ``items`` the ids, as text in ascending order, of the items with such a window; items without an id
    count in ``spans`` alone. Every suffix of an item that holds a window is searched for, by binary search, in the suffix
    array of each shard of texts; a shard is a few megabytes of text, or one longer text.

    Items are broadcast in blocks of at most ``block_words`` words (or one item) of eight bytes, each in its own pass. Null and empty
    texts have no words; items without words are nothing. Repeated rows are kept, each on its own. Other columns
    pass through, but for the three named here, which are replaced. An empty table gives an empty table.
    """
    kept = [c for c in docs.columns if c not in (text, "n_words", "spans", "items")]
    fields = "".join(f"`{name}` {kind}, " for name, kind in docs.select(*kept).dtypes)
    result = f"{fields}n_words bigint, spans {SPAN}, items array<string>"
    found = docs.select(
        *kept,
        F.lit(0).cast("long").alias("n_words"),
        F.expr(f"cast(array() as {SPAN})").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"),
        F.col(text).alias(_free("text", kept)),
    )
    given = found.columns[-1]
    shared: list[Broadcast] = []
    for block in blocks(items, item_id, item_text, width, block_words):
        shared.append(docs.sparkSession.sparkContext.broadcast(block))
    shared = shared or [docs.sparkSession.sparkContext.broadcast(None)]
    for number, block in enumerate(shared):
        last = number == len(shared) - 1

        def run(batches: Batches, block=block, last=last) -> Batches:
            for whole in batches:
                for start, end in slices(whole.column(given)):
                    batch = whole.slice(start, end - start)
                    if block.value is None:  # no item has a word
                        counted = pa.array(np.diff(hashed_words(batch.column(given), PLAIN)[1]))
                        new = [counted, batch.column("spans"), batch.column("items")]
                    else:
                        texts, spans, named = (batch.column(c) for c in (given, "spans", "items"))
                        new = _search(texts, spans, named, block.value, width)
                    columns = [*[batch.column(c) for c in kept], *new, *([] if last else [batch.column(given)])]
                    names = [*kept, "n_words", "spans", "items", *([] if last else [given])]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

        found = map_batches(found, run, result if last else f"{result}, `{given}` string")
    return found


def _free(name: str, taken: list[str]) -> str:
    """A name like this one that no column has."""
    while name.lower() in {c.lower() for c in taken} | {"n_words", "spans", "items"}:
        name += "_"
    return name


def n_hit(spans: str = "spans"):
    """Number of words in ranges that do not overlap."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])


def remove_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents, unchanged, in which no window of any item occurs; ``options`` are those of ``hits``.

    The text travels through the search beside itself, so no join is needed and repeated rows stay apart. Column names that
    ``hits`` uses are safe: all columns travel as one struct.
    """
    whole = F.struct(*[F.col(c).alias(f"c{n}") for n, c in enumerate(docs.columns)])
    found = hits(docs.select(whole.alias("row"), F.col(text).alias("text")), items, "text", **options)
    clean = found.filter(F.size("spans") == 0)
    return clean.select(*[F.col(f"row.c{n}").alias(c) for n, c in enumerate(docs.columns)])


def longest_matches(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The longest verbatim match of each suffix of each item: item, item_word, length, doc_id and doc_word.

    Only matches of a whole window or more are given. Of equally long ones, the match in the smallest document id (null first) and
    then at the smallest word is kept; within a shard, one of the two suffixes next to the asked one is taken. Each shard
    sends a row for each suffix it matches, and these are reduced before the shuffle.
    """
    parts = []
    for block in blocks(items, item_id, item_text, width, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Batches, shared=shared) -> Batches:
            own = shared.value
            for whole in batches:
                for start, end in slices(whole.column("text")):
                    batch = whole.slice(start, end - start)
                    shard = Shard(batch.column("text"), int(own.rest.max()))
                    symbols = shard.symbols(own.words)
                    length, where = shard.suffixes.longest(symbols, own.at, own.rest)
                    long = np.flatnonzero(length >= own.size)
                    of = shard.text_of(where[long])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([own.ids[i] for i in own.item[long].tolist()], type=pa.string()),
                            pa.array(own.at[long] - own.begin[own.item[long]]),
                            pa.array(length[long]),
                            batch.column("id").take(pa.array(of)),
                            pa.array(where[long] - shard.begin[of]),
                        ],
                        names=["item", "item_word", "length", "doc_id", "doc_word"],
                    )

        kind = docs.select(doc_id).dtypes[0][1]
        schema = f"item string, item_word bigint, length bigint, doc_id {kind}, doc_word bigint"
        parts.append(map_batches(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")), run, schema))
    if not parts:
        kind = docs.select(doc_id).dtypes[0][1]
        return docs.sparkSession.createDataFrame([], f"item string, item_word bigint, length bigint, doc_id {kind}, doc_word bigint")
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    best = F.min(F.struct((-F.col("length")).alias("less"), "doc_id", "doc_word")).alias("best")
    return every.groupBy("item", "item_word").agg(best).select(
        "item", "item_word", (-F.col("best.less")).alias("length"), "best.doc_id", "best.doc_word"
    )


def op13_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of all benchmark items in each document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = n_hit()
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


ORACLE = r"""
with words as (
    select doc_id, row_number() over () as r,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
), items as (
    select cast(item_id as varchar) as item,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark
), windows as (
    select distinct item, least(len(w), 10) as size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as gram
    from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from items where len(w) > 0)
), sizes as (
    select distinct size from windows
), grams as (
    select r, i, size, array_to_string(w[i : i + size - 1], ' ') as gram
    from (select r, w, size, unnest(range(1, len(w) - size + 2)) as i from words, sizes where len(w) >= size)
), found as (
    select r, i, size, item from grams join windows using (size, gram)
), covered as (
    select r, count(distinct k) as n_hit from (select r, unnest(range(i, i + size)) as k from found) group by r
), named as (
    select r, count(*) as n_items, string_agg(item, ',' order by item) as names
    from (select distinct r, item from found where item is not null) group by r
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join covered using (r) left join named using (r)
"""
