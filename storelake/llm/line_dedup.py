"""Fuzzy line deduplication: SimHashes of normal forms, pigeonhole blocks, verified edit similarity, one line per group."""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.llm.components import components, spanning_forest
from storelake.llm.scratch import Scratch, shuffles_deleted
from storelake.llm.text import bit_counts, majority_bits
from storelake.llm.workers import Batches, by_size, map_batches

MIN_LETTERS = 16  # of a normal form; shorter lines stay
SIMILARITY = 0.8
GRAM = 5  # letters
WORDS, PER_WORD, BLOCK_BITS = 4, 5, 12  # a SimHash is four words of 64 bits, each with five blocks of twelve
# Largest share of differing bits that is worth a verification: longer lines have more in common by chance.
RADII = ((175, 0.28), (250, 0.26), (400, 0.24), (700, 0.20), (None, 0.16))  # (up to this many letters, share)
ROOM = 0.03  # more than that share may differ in the two words after that of a block
TILE = 2048  # lines of one bucket compared with each other at once; more where buckets grow with the table
STRIP, AREA = 512, 1 << 15  # lines, and pairs, looked at in one step: about what fits a processor's cache
DEALT = 1 << 22  # entries of buckets shuffled at once, or those of one block where they are more
LINKS = 1 << 16  # pairs that a task gathers before it hands them on
SLICE = 1 << 18  # bytes of text cut into lines at a time; a longer text alone

CODES = [f"k{n}" for n in range(WORDS)]


def normal_forms(lines: pa.Array) -> pa.Array:
    """Lower case, with every run of anything but letters, marks and digits as one space, none at the ends."""
    return pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(lines), r"[^\pL\pM\pN]+", " "), characters=" ")


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def simhashes(forms: list[str]) -> np.ndarray:
    """A SimHash of each form, over its runs of ``GRAM`` letters: one row of ``WORDS`` unsigned words.

    Every letter begins a run; behind the last letter a run is filled up.
    """
    sizes = np.array([len(f) for f in forms], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    letters = np.frombuffer("".join(forms).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    place = np.repeat(starts[1:], sizes) - np.arange(len(letters))  # letters left in the form
    grams = np.zeros(len(letters), dtype=np.uint64)
    for k in range(GRAM):
        grams = grams * np.uint64(0x9E3779B97F4A7C15)
        grams[: len(letters) - k] += np.where(place[: len(letters) - k] > k, letters[k:] + np.uint64(1), np.uint64(0))
    seeds = np.random.default_rng(7).integers(0, 1 << 63, WORDS, dtype=np.uint64)
    words = [majority_bits(bit_counts(_mixed(grams + seed), starts), sizes) for seed in seeds]
    return np.column_stack(words)


def line_hashes(docs: DataFrame, min_letters: int = MIN_LETTERS) -> DataFrame:
    """A row for each line of at least ``min_letters`` letters: id, h, line_no, 128-bit hash (h1, h2), letters and SimHash."""

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in by_size(whole, "text", SLICE):
                split = [(text or "").split("\n") for text in batch.column("text").to_pylist()]
                row = np.repeat(np.arange(len(split)), [len(x) for x in split])
                number = np.concatenate([np.arange(len(x)) for x in split]) if split else np.empty(0)
                forms = normal_forms(pa.array([line for x in split for line in x], type=pa.large_string()))
                sizes = pc.utf8_length(forms).to_numpy(zero_copy_only=False)
                keep = np.flatnonzero(sizes >= min_letters)
                coded = forms.take(pa.array(keep)).dictionary_encode()
                distinct, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
                codes = simhashes(distinct)[index]
                digests = b"".join(xxhash.xxh3_128_digest(form) for form in distinct)
                halves = np.frombuffer(digests, dtype="<i8").reshape(-1, 2)[index]
                of = pa.array(row[keep])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(of),
                        batch.column("h").take(of),
                        pa.array(number[keep].astype(np.int32)),
                        pa.array(halves[:, 0]),
                        pa.array(halves[:, 1]),
                        pa.array(sizes[keep].astype(np.int32)),
                        *[pa.array(codes[:, n].view(np.int64)) for n in range(WORDS)],
                    ],
                    names=["id", "h", "line_no", "h1", "h2", "size", *CODES],
                )

    more = "".join(f", {k} long" for k in CODES)
    return map_batches(docs, run, f"id long, h long, line_no int, h1 long, h2 long, size int{more}")


def _buckets(blocks: range) -> Column:
    """A bucket for each of these blocks: its number and bits."""
    entries = []
    for number in blocks:
        word, place = divmod(number, PER_WORD)
        bits = F.shiftrightunsigned(CODES[word], place * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
        entries.append((F.lit(number << BLOCK_BITS) + bits).cast("long"))
    return F.array(*entries)


def _block(bucket: Column) -> Column:
    """The number of a bucket's block; that of two tiles is negative and carries it in its low bits."""
    return F.when(bucket < 0, (-1 - bucket).bitwiseAND(31)).otherwise(F.shiftright(bucket, BLOCK_BITS))


def _blocks(buckets: np.ndarray) -> np.ndarray:
    return np.where(buckets < 0, (-1 - buckets) & 31, buckets >> BLOCK_BITS)


def _grouped(batches: Batches, key: str) -> Iterator[pa.RecordBatch]:
    """Batches of rows sorted by a key, cut so that no bucket is divided."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut == 0 and rest and rest[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(rest).combine_chunks().to_batches()[0]
            rest = [batch]
            continue
        if cut:
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)]).combine_chunks().to_batches()[0]
            rest = []
        rest.append(batch.slice(cut))
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks().to_batches()[0]


def radius(size: np.ndarray) -> np.ndarray:
    """Differing bits of two words (128 bits) that are worth a look at all four, by the letters of the longer line."""
    bounds = [up_to for up_to, _ in RADII[:-1]]
    return np.array([int(128 * (share + ROOM)) for _, share in RADII])[np.searchsorted(bounds, size, side="left")]


def whole_radius(size: np.ndarray) -> np.ndarray:
    """Differing bits of all four words that are worth a verification, by the letters of the longer line."""
    bounds = [up_to for up_to, _ in RADII[:-1]]
    return np.array([int(64 * WORDS * share) for _, share in RADII])[np.searchsorted(bounds, size, side="left")]


_FIRST = int(64 * (RADII[0][1] + 4 * ROOM))  # bits of one word alone: a first look at most of the pairs of a bucket
_SECOND = int(128 * (RADII[0][1] + ROOM))  # bits of two words, whatever the letters


def _differing(words: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    differ = np.zeros(np.broadcast(left, right).shape, dtype=np.int16)
    for word in words:
        differ += np.bitwise_count((word[left] ^ word[right]).view(np.uint64))
    return differ


class _Bucket:
    """Lines that agree in one block, by number of letters; close are those whose two next words and all four words are."""

    def __init__(self, batch: pa.RecordBatch):
        self.sizes = batch.column("size").to_numpy().astype(np.int64)
        self.codes = [batch.column(c).to_numpy() for c in CODES]
        word, row = _blocks(batch.column("bucket").to_numpy()) // PER_WORD, np.arange(batch.num_rows)
        self.one, self.two = (np.stack(self.codes)[(word + n) % WORDS, row] for n in (1, 2))

    def near(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Which rows (as places) are close; similar lines differ little in length."""
        longer, shorter = np.maximum(self.sizes[left], self.sizes[right]), np.minimum(self.sizes[left], self.sizes[right])
        close = (shorter >= SIMILARITY * longer - 1e-9) & (_differing([self.one, self.two], left, right) <= radius(longer))
        at = np.flatnonzero(close)
        close[at] = _differing(self.codes, left[at], right[at]) <= whole_radius(longer[at])
        return close

    def met_before(self, block: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Which pairs (close by all four words) a block of a lower number hands on as well."""
        differ = np.column_stack([_differing([word], left, right) for word in self.codes])
        most = radius(np.maximum(self.sizes[left], self.sizes[right]))
        found = np.zeros(len(left), dtype=bool)
        for word in range((block + PER_WORD - 1) // PER_WORD):
            one, two = differ[:, (word + 1) % WORDS], differ[:, (word + 2) % WORDS]
            bits = (self.codes[word][left] ^ self.codes[word][right]).view(np.uint64)
            mask = np.uint64((1 << BLOCK_BITS) - 1)
            places = range(min(PER_WORD, block - word * PER_WORD))
            agree = [bits >> np.uint64(place * BLOCK_BITS) & mask == 0 for place in places]
            found |= (one <= _FIRST) & (one + two <= most) & np.any(agree, axis=0)
        return found

    def pairs(self, first: int, last: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Close rows i before j of a range, some at a time."""
        if last - first == 2:
            if self.near(np.array([first]), np.array([first + 1]))[0]:
                yield np.array([first]), np.array([first + 1])
            return
        order = first + np.argsort(self.sizes[first:last], kind="stable")
        # Sorted by length: what is too long for a line is too long for all before it.
        ends = np.searchsorted(self.sizes[order], self.sizes[order] / SIMILARITY + 1e-6, side="right")
        one, two = (word[order].view(np.uint64) for word in (self.one, self.two))
        at = 0
        while at < len(order) - 1:
            upto = ends[at : at + STRIP]
            stop = at + max(8, int(np.searchsorted(np.arange(1, len(upto) + 1) * (upto - at), AREA, side="right")))
            stop = min(stop, len(order))
            differ = np.bitwise_count(one[at:stop, None] ^ one[None, at : ends[stop - 1]])
            i, j = np.nonzero(differ <= _FIRST)
            i, j = i[i < j], j[i < j]
            seen = differ[i, j] + np.bitwise_count(two[at + i] ^ two[at + j]) <= _SECOND
            i, j = order[at + i[seen]], order[at + j[seen]]
            close = self.near(i, j)
            if close.any():
                yield i[close], j[close]
            at = stop


def _edges(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))


def _members(batches: Batches) -> Batches:
    """Rows of buckets with a close neighbour."""
    for batch in _grouped(batches, "bucket"):
        bucket, edges = _Bucket(batch), _edges(batch.column("bucket").to_numpy())
        sizes = np.diff(edges)
        keep = np.zeros(batch.num_rows, dtype=bool)
        two = edges[:-1][sizes == 2]
        keep[two] = keep[two + 1] = bucket.near(two, two + 1)
        for k in np.flatnonzero(sizes > 2):
            for i, j in bucket.pairs(int(edges[k]), int(edges[k + 1])):
                keep[i] = keep[j] = True
        if keep.any():
            yield batch.select(["bucket", "line_id"]).filter(pa.array(keep))


def _apart(batches: Batches) -> Iterator[tuple[_Bucket, np.ndarray, np.ndarray, int, int, int]]:
    """Buckets whose lines are not all joined: with line ids, components, first and last row, and the number of the block."""
    for batch in _grouped(batches, "bucket"):
        keys, lines, joined = (batch.column(c).to_numpy() for c in ("bucket", "line_id", "component"))
        bucket, edges, blocks = _Bucket(batch), _edges(keys), _blocks(keys)
        for first, last in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if (joined[first:last] != joined[first]).any():
                yield bucket, lines, joined, first, last, int(blocks[first])


def _spanning(batches: Batches) -> Batches:
    """As few close pairs as join the components with close lines of each bucket, those of the fewest differing bits."""
    links = []
    for bucket, lines, joined, first, last, _ in _apart(batches):
        classes = np.unique(joined[first:last], return_inverse=True)[1]
        left, right = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        for i, j in bucket.pairs(first, last):
            apart = joined[i] != joined[j]
            left, right = np.append(left, i[apart]), np.append(right, j[apart])
            if len(left) > 1:
                differ = _differing(bucket.codes, left, right)
                kept = spanning_forest(classes[left - first], classes[right - first], differ, last - first)
                left, right = left[kept], right[kept]
        links.append((lines[left], lines[right]))
    yield _pairs(links)


def _across(batches: Batches) -> Batches:
    """All close pairs that no verified link has joined yet, each from the first of the buckets in which it is close."""
    links = []
    for bucket, lines, joined, first, last, block in _apart(batches):
        for i, j in bucket.pairs(first, last):
            apart = joined[i] != joined[j]
            i, j = i[apart], j[apart]
            own = ~bucket.met_before(block, i, j)
            links.append((lines[i[own]], lines[j[own]]))
        if sum(len(a) for a, _ in links) > LINKS:
            yield _pairs(links)
            links = []
    yield _pairs(links)


def _pairs(links: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    none = np.empty(0, dtype=np.int64)
    a, b = (np.concatenate([none, *[x[k] for x in links]]) for k in (0, 1))
    both = np.unique(np.column_stack([np.minimum(a, b), np.maximum(a, b)]), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def _forms(docs: DataFrame) -> DataFrame:
    """Normal forms of chosen lines (doc text with arrays of line numbers and ids)."""

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in by_size(whole, "text", SLICE):
                ids, lines = [], []
                for text, chosen in zip(batch.column("text").to_pylist(), batch.column("chosen").to_pylist()):
                    split = text.split("\n")
                    ids += [c["line_id"] for c in chosen]
                    lines += [split[c["line_no"]] for c in chosen]
                forms = normal_forms(pa.array(lines, type=pa.large_string())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(ids, type=pa.int64()), forms], names=["line_id", "form"])

    return map_batches(docs, run, "line_id long, form string")


def similar(a: str, b: str, least: float = SIMILARITY) -> Column:
    """Whether one less the edit distance over the longer length is at least ``least``, for two columns of text.

    Exchanging the words that differ bounds the distance from above, which settles most pairs that are similar.
    """
    longer = f"greatest(char_length({a}), char_length({b}))"
    most = f"cast(floor({longer} - {least} * {longer} + 1e-9) as int)"
    words = f"split({a}, ' '), split({b}, ' ')"
    cost = f"zip_with({words}, (x, y) -> if(x = y, 0, greatest(char_length(x), char_length(y))))"
    exchanged = f"coalesce(aggregate({cost}, 0, (s, x) -> s + x), {most} + 1) <= {most}"  # null: not as many words
    return F.expr(
        f"abs(char_length({a}) - char_length({b})) <= {most} and ({exchanged} or levenshtein({a}, {b}, {most}) >= 0)"
    )


def _verified(pairs: DataFrame, forms: DataFrame) -> DataFrame:
    one = forms.select(F.col("line_id").alias("a"), F.col("form").alias("form_a"))
    two = forms.select(F.col("line_id").alias("b"), F.col("form").alias("form_b"))
    return pairs.join(one, "a").join(two, "b").filter(similar("form_a", "form_b")).select("a", "b")


def _met(distinct: DataFrame, tile: int, scratch: Scratch) -> DataFrame:
    """``bucket`` and ``line_id`` of all lines that are close to another one of their bucket.

    A few blocks are dealt at a time, so that the shuffle does not grow with the number of blocks. A bucket with several times the
    lines that are usual in this table is cut into tiles by hash, and each two of its tiles are a bucket of their own.
    """
    lines, blocks = distinct.count(), range(WORDS * PER_WORD)
    tile = max(tile, 4 * lines >> BLOCK_BITS)
    counted = distinct.select(F.explode(_buckets(blocks)).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    # Not more than 512 buckets of a block are this large: less than a broadcast may hold.
    large = scratch.table(counted.filter(F.col("n") > 2 * tile).select("bucket", F.ceil(F.col("n") / tile).alias("tiles")))
    part = F.pmod(F.xxhash64("line_id"), F.col("tiles"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("tiles", F.lit(1)) - 1)).alias("other")
    pair = F.xxhash64("bucket", F.least("part", "other"), F.greatest("part", "other")).bitwiseAND(F.lit((1 << 57) - 1))
    both = -1 - F.shiftleft(pair, 5).bitwiseOR(_block(F.col("bucket")))
    rest = ["line_id", "size", *CODES]
    found = []
    at_once = min(max(DEALT // max(lines, 1), 1), len(blocks))
    for first in blocks[::at_once]:
        keyed = distinct.select(*rest, F.explode(_buckets(blocks[first : first + at_once])).alias("bucket"))
        dealt = keyed.join(F.broadcast(large), "bucket", "left").select(*rest, "bucket", part.alias("part"), other)
        sorted_rows = (
            dealt.select(F.when(F.col("part").isNull(), F.col("bucket")).otherwise(both).alias("bucket"), *rest)
            .repartition("bucket")
            .sortWithinPartitions("bucket")
        )
        found.append(scratch.table(map_batches(sorted_rows, _members, "bucket long, line_id long")))
    return reduce(DataFrame.union, found)


def near_links(docs: DataFrame, distinct: DataFrame, tile: int, scratch: Scratch) -> DataFrame:
    """Verified links ``a``, ``b`` between distinct lines, enough to join all lines joined by similar pairs that are close.

    Lines that agree in a block meet, and those that have a close neighbour there go on. A spanning set of the close pairs of each
    bucket, those of the fewest differing bits, is verified first: in the blocks of the first word, then in all blocks between what
    that has joined. At last come all close pairs of any bucket that are not joined by then; so a family of n similar lines costs a
    few n verifications. A pair is verified once, and the last step hands it on from one bucket only.
    """
    met = _met(distinct, tile, scratch)
    wanted = scratch.table(met.select("line_id").distinct())
    chosen = scratch.table(distinct.join(wanted, "line_id").select("line_id", "size", *CODES, "first"))
    places = chosen.select("line_id", "first.id", "first.h", "first.line_no")
    per_doc = scratch.table(places.groupBy("id", "h").agg(F.collect_list(F.struct("line_no", "line_id")).alias("chosen")))
    once = docs.join(per_doc.hint("merge"), ["id", "h"]).select("text", "chosen")
    forms = scratch.table(_forms(once).dropDuplicates(["line_id"]))  # a row listed twice gives its lines twice
    members = scratch.table(met.join(chosen.drop("first"), "line_id"))

    def by_component(rows: DataFrame, joined: DataFrame | None) -> DataFrame:
        own = F.col("line_id") if joined is None else F.coalesce("component", "line_id")
        met = rows if joined is None else rows.join(joined, rows["line_id"] == joined["node"], "left")
        named = met.select("bucket", "line_id", "size", *CODES, own.alias("component"))
        return named.repartition("bucket").sortWithinPartitions("bucket")

    pair_of = "a long, b long"
    tried = sure = joined = None
    for rows in (members.filter(_block(F.col("bucket")) < PER_WORD), members):
        asked = map_batches(by_component(rows, joined), _spanning, pair_of).distinct()
        asked = scratch.table(asked if tried is None else asked.join(tried, ["a", "b"], "left_anti"))
        found = _verified(asked, forms)
        sure = scratch.table(found if sure is None else sure.union(found))
        tried = asked if tried is None else tried.union(asked)
        joined = components(sure)
    apart = map_batches(by_component(members, joined), _across, pair_of).distinct()
    left = scratch.table(apart.join(tried, ["a", "b"], "left_anti"))
    return scratch.table(sure.union(_verified(left, forms)))


def _identified(docs: DataFrame) -> DataFrame:
    """``id`` and ``h`` of each row, its text, and the whole row as a struct, safe from clashing names."""
    whole = F.struct(*[F.col(c).alias(f"c{n}") for n, c in enumerate(docs.columns)])
    identity = F.coalesce("doc_id", F.lit((1 << 63) - 1)).cast("long")
    return docs.select(identity.alias("id"), F.xxhash64("text", F.col("doc_id").isNull()).alias("h"), F.col("text"), whole.alias("whole"))


def dedup_lines(
    docs: DataFrame, min_letters: int = MIN_LETTERS, tile: int = TILE, counts: tuple[str, ...] = ("n_lines", "n_dropped")
) -> DataFrame:
    """All rows with one occurrence of each group of alike lines; ``counts`` names columns for the lines a text had and lost.

    Lines whose normal forms are equal are alike, and so are lines whose edit similarity is 0.8 or more and whose SimHashes over
    letters agree in one of twenty blocks and lie within the radius (README has the recall). Groups are what such links
    connect. The occurrence kept is the first by doc_id (null last), hash of the text and line number. Lines of fewer than ``min_letters``
    letters in normal form always stay. A document may be left with an empty text. Null texts stay null.

    Every row comes back. Of rows that repeat doc_id and text one keeps its lines, the others lose all that are long enough. Other
    columns pass through whatever their names, but for those of ``counts``, which are replaced; with no names in it,
    none is added. An empty table gives an empty table.
    """
    scratch, kept = Scratch(docs.sparkSession), Scratch(docs.sparkSession)
    rows = _identified(docs)
    texts = rows.select("id", "h", "text")
    with shuffles_deleted(docs.sparkSession):
        lines = scratch.table(line_hashes(texts, min_letters))
        place = F.struct("id", "h", "line_no")
        distinct = scratch.table(
            lines.groupBy("h1", "h2")
            .agg(F.min(place).alias("first"), *[F.min(c).alias(c) for c in ("size", *CODES)], F.count(F.lit(1)).alias("n"))
            .withColumn("line_id", F.monotonically_increasing_id())
        )
        groups = components(near_links(texts, distinct, tile, scratch))
        grouped = scratch.table(
            distinct.join(groups, distinct["line_id"] == groups["node"], "left").select("h1", "h2", "first", "n", "component")
        )
        keep = scratch.table(grouped.filter("component is not null").groupBy("component").agg(F.min("first").alias("keep")))
        alike = scratch.table(
            grouped.filter("n > 1 or component is not null")
            .join(keep, "component", "left")
            .select("h1", "h2", F.coalesce("keep", "first").alias("keep"))
        )
        listed = F.collect_set("line_no").alias("lost")
        dropped = lines.select("id", "h", "line_no", "h1", "h2").join(alike, ["h1", "h2"]).filter(~place.eqNullSafe(F.col("keep")))
        per_doc = kept.table(dropped.groupBy("id", "h").agg(listed))
        # Rows that repeat doc_id and text, told apart by numbers of their own.
        repeated = kept.table(texts.groupBy("id", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id", "h"))
        every = kept.table(lines.join(repeated, ["id", "h"], "left_semi").groupBy("id", "h").agg(listed))
        again = kept.table(rows.join(repeated, ["id", "h"], "left_semi").withColumn("row", F.monotonically_increasing_id()))
        first = kept.table(again.groupBy("id", "h").agg(F.min("row").alias("row")).select("row"))
    scratch.clear()
    single = rows.join(repeated, ["id", "h"], "left_anti").union(again.join(first, "row", "left_semi").drop("row"))
    copies = again.join(first, "row", "left_anti").drop("row")
    cut = single.join(per_doc.hint("merge"), ["id", "h"], "left").union(copies.join(every, ["id", "h"], "left"))

    split = F.split("text", "\n", -1)
    left = F.transform(
        F.array(F.struct(split.alias("lines"), F.array_except(F.sequence(F.lit(0), F.size(split) - 1), "lost").alias("at"))),
        lambda x: F.array_join(F.transform(x["at"], lambda i: F.get(x["lines"], i)), "\n"),
    )[0]
    text = F.when(F.col("lost").isNull(), F.col("text")).otherwise(left)
    measured = (
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(split)).cast("long"),
        F.coalesce(F.size("lost"), F.lit(0)).cast("long"),
    )
    own = [(text if c == "text" else F.col(f"whole.c{n}")).alias(c) for n, c in enumerate(docs.columns) if c not in counts]
    return cut.select(*own, *[c.alias(name) for c, name in zip(measured, counts)])


def op1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the lines it keeps."""
    kept = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", "text")
