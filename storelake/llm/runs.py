"""Periodic runs of words: maximal pairs from the LCP-interval tree whose distance fits their length."""

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.llm.suffixes import Suffixes
from storelake.llm.words import SPACED, hashed_words, slices
from storelake.llm.workers import Batches, map_batches
from storelake.operators.lateral import computed_once

REPEATS = 4  # a run is at least so many periods long
LEAST = 6  # and at least so many words

RUN = "array<struct<start: bigint, length: bigint, period: bigint>>"


def maximal_pairs(
    places: list[int], common: list[int], left: list[int], ratio: int, least: int
) -> dict[tuple[int, int], int]:
    """Smallest distance of the maximal pairs of each stretch (start, end), with distance * ratio <= length >= least.

    ``places`` are suffixes in order, ``common`` the length that each shares with the one before it, ``left`` the class of
    the word before each place (by place). The LCP intervals are built bottom-up. An interval holds its places by position, each with
    its left class; where two children meet, places of different classes make a maximal pair. Only the nearest
    place on either side can be the other end of a shortest period: were there one between them, the
    common text, which is at least three distances long, would have a smaller period.
    """
    found: dict[tuple[int, int], int] = {}

    def join(one: list[int], two: list[int], length: int) -> list[int]:
        big, small = (one, two) if len(one) >= len(two) else (two, one)
        reach = length // ratio
        for i in small:
            k = bisect_left(big, i)
            if k < len(big) and big[k] - i <= reach and left[big[k]] != left[i]:
                stretch, d = (i, big[k] + length), big[k] - i
                found[stretch] = min(d, found.get(stretch, d))
            if k and i - big[k - 1] <= reach and left[big[k - 1]] != left[i]:
                stretch, d = (big[k - 1], i + length), i - big[k - 1]
                found[stretch] = min(d, found.get(stretch, d))
        if len(small) * 16 < len(big):
            for i in small:
                insort(big, i)
        else:
            big += small
            big.sort()
        return big

    leaf = 1 << 62
    open_intervals: list[tuple[int, list[int]]] = []
    for place, length in zip([*places, -1], [*common, 0]):
        child = None
        while open_intervals and open_intervals[-1][0] > length:
            value, own = open_intervals.pop()
            child = own if child is None else join(own, child, value)
        if length >= least and child is not None:
            if open_intervals and open_intervals[-1][0] == length:
                open_intervals[-1] = (length, join(open_intervals[-1][1], child, length))
            else:
                open_intervals.append((length, child))
        elif length < least:
            open_intervals.clear()
        open_intervals.append((leaf, [place]))
    return found


def _runs(hashes: np.ndarray, starts: np.ndarray, repeats: int, least: int) -> np.ndarray:
    """Rows (text, start, length, period) of the runs in some texts, in order of text, start and period."""
    n, none = len(hashes), np.empty((0, 4), dtype=np.int64)
    if n < least:
        return none
    of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    # Words are numbered for each text on its own, so that no match runs from one text into the next.
    own = hashes ^ ((of.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    symbols = pa.array(own.view(np.int64)).dictionary_encode().indices.to_numpy().astype(np.int64) + 1
    suffixes = Suffixes(symbols, n, keep=True)
    # A run of period q and length L is a pair of places q words apart that share L - q words.
    shortest = min(max(least, repeats * q) - q for q in range(1, least + 1))
    order = suffixes.order
    begin = suffixes.levels[0][1][order]
    slots = np.flatnonzero(begin[1:] == begin[:-1]) + 1 if shortest >= suffixes.width else np.arange(1, n)
    length = suffixes.common(order[slots - 1], order[slots])
    slots, length = slots[length >= shortest], length[length >= shortest]
    if not len(slots):
        return none
    taken = np.union1d(slots, slots - 1)
    common = np.zeros(len(taken), dtype=np.int64)
    common[np.searchsorted(taken, slots)] = length
    left = np.zeros(n, dtype=np.int64)
    left[1:] = symbols[:-1]
    left[starts[:-1][np.diff(starts) > 0]] = 0  # nothing is before the first word: two texts never meet
    found = maximal_pairs(order[taken].tolist(), common.tolist(), left.tolist(), repeats - 1, shortest)
    rows = np.array([(s, e - s, q) for (s, e), q in found.items() if e - s >= least], dtype=np.int64).reshape(-1, 3)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    text = of[rows[:, 0]]
    return np.column_stack([text, rows[:, 0] - starts[text], rows[:, 1:]])


def _without(words: list[str], runs: np.ndarray) -> list[str]:
    dropped = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
    np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(dropped)[:-1] == 0
    return [word for word, kept in zip(words, keep.tolist()) if kept]


def find_runs(docs: DataFrame, text: str = "text", repeats: int = REPEATS, least: int = LEAST) -> DataFrame:
    """All documents without their text, with ``runs`` and ``collapsed``.

    A run is a stretch of words with smallest period q and a length of at least ``least`` and ``repeats`` * q (2 or more) words that no
    neighbouring word extends; ``runs`` lists them by start, then period, as word numbers from 0. ``collapsed`` is the text with the first period of
    each run alone, words joined by one space. A word is a run of anything but ASCII white space.

    Nothing is shuffled. Texts are handled a few megabytes at a time, a longer one alone; its suffix
    array and the ranks of each doubling round have to fit a task. Null and empty texts have no runs and an empty ``collapsed``.
    Repeated rows are kept. Other columns pass through, but for the two named here, which are replaced.
    """
    if repeats < 4:
        raise ValueError("nearest places are enough from four periods on")
    kept = [c for c in docs.columns if c not in (text, "runs", "collapsed")]
    fields = "".join(f"`{name}` {kind}, " for name, kind in docs.select(*kept).dtypes)
    given = "text"
    while given.lower() in {c.lower() for c in kept}:
        given += "_"

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for start, end in slices(whole.column(given)):
                batch = whole.slice(start, end - start)
                hashes, starts = hashed_words(batch.column(given), SPACED)
                runs = _runs(hashes, starts, repeats, least)
                edges = np.searchsorted(runs[:, 0], np.arange(batch.num_rows + 1))
                split = [(t or b"").split() for t in batch.column(given).cast(pa.binary()).to_pylist()]
                for row in np.flatnonzero(np.diff(edges)).tolist():
                    split[row] = _without(split[row], runs[edges[row] : edges[row + 1], 1:])
                values = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in (1, 2, 3)], names=["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), values)
                joined = pa.array([b" ".join(words) for words in split], type=pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in kept], lists, joined], names=[*kept, "runs", "collapsed"]
                )

    return map_batches(docs.select(*kept, F.col(text).alias(given)), run, f"{fields}runs {RUN}, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the words of one text in ten repeat a short stretch up to the end.

    Which, from where and with what period follows from the crc32 of the decimal doc_id. A null doc_id plants nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    known = computed_once(docs.select("doc_id", "text"), h=h, words=words)
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    sized = computed_once(known, n=n, a=(g % F.greatest(n, F.lit(1))).cast("int"), k=(F.lit(3) + g % 8).cast("int"))
    period = (F.lit(1) + F.floor((F.col("n") - F.col("a")) / F.col("k"))).cast("int")
    timed = computed_once(sized, p=period)
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.col("k") + 1))
    planted = F.concat(F.slice("words", 1, "a"), F.slice(tail, 1, F.col("n") - F.col("a")))
    return timed.select("doc_id", F.when(F.col("n") > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of each document, some of which have been given one."""
    found = find_runs(with_planted_runs(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    longest = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    best = computed_once(found, best=longest)
    length = -F.col("best.less")
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * length / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
