"""License scans: patience alignment of whole texts with the texts of licenses."""

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from storelake.llm.license_texts import COMMON, REQUIRED, TEMPLATES
from storelake.llm.line_dedup import normal_forms
from storelake.llm.text import words_of
from storelake.llm.workers import Batches, map_batches

COVERAGE = 0.8
SLICE = 256


def _increasing(places: list[int]) -> list[int]:
    """Positions in the list that form a longest increasing subsequence (piles of patience sorting)."""
    tops: list[int] = []
    pile_of: list[int] = []
    before: list[int] = []
    for at, value in enumerate(places):
        pile = bisect_left(tops, value)
        before.append(pile_of[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(value)
            pile_of.append(at)
        else:
            tops[pile], pile_of[pile] = value, at
    chain, at = [], pile_of[-1] if pile_of else -1
    while at >= 0:
        chain.append(at)
        at = before[at]
    return chain[::-1]


def align(text: list[int], template: list[int]) -> list[tuple[int, int]]:
    """Matched positions of two lists of words, in order.

    Equal ends match first. Within the rest the words that occur once in both are anchors; the longest set of them that
    is in order on both sides is kept, and each gap between them is aligned the same way. A gap without anchors has no match.
    """
    found, gaps = [], [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {w: k for k, w in enumerate(template[c:d], c) if there[w] == 1}
        anchors = [(k, place[w]) for k, w in enumerate(text[a:b], a) if here[w] == 1 and w in place]
        chain = [anchors[k] for k in _increasing([p for _, p in anchors])]
        found += chain
        edges = [(a - 1, c - 1), *chain, (b, d)] if chain else []
        gaps += [(i + 1, j, p + 1, q) for (i, p), (j, q) in zip(edges, edges[1:])]
    return _drawn_together(sorted(found), text)


def _drawn_together(pairs: list[tuple[int, int]], text: list[int]) -> list[tuple[int, int]]:
    """The same matches, each next to its neighbour towards the middle wherever the text has its word there too."""
    middle = len(pairs) // 2
    for steps, way in ((range(middle + 1, len(pairs)), 1), (range(middle - 1, -1, -1), -1)):
        for k in steps:
            (i, p), (j, q) = pairs[k], pairs[k - way]
            if p == q + way and text[j + way] == text[i]:
                pairs[k] = (j + way, p)
    return pairs


def _holds(words: list[int], phrase: list[int]) -> bool:
    """Whether a list of words has a phrase word for word."""
    return any(words[k : k + len(phrase)] == phrase for k, w in enumerate(words) if w == phrase[0])


class Scanner:
    """Templates as lists of word numbers, and which words of a template a search may begin at."""

    def __init__(self, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE):
        self.names, self.coverage = sorted(templates), coverage
        forms = normal_forms(pa.array([templates[n] for n in self.names], type=pa.large_string())).to_pylist()
        words = [form.split() for form in forms]
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for own in words for w in own}))}
        self.words = [[self.vocabulary[w] for w in own] for own in words]
        known = self.vocabulary
        phrases = [REQUIRED.get(n, []) if templates[n] == TEMPLATES.get(n) else [] for n in self.names]
        self.required = [[[known[w] for w in phrase.split()] for phrase in own] for own in phrases]
        common = {self.vocabulary[w] for w in COMMON.split() if w in self.vocabulary}
        self.rare = [frozenset(own) - common or frozenset(own) for own in self.words]
        self.counts = [Counter(own) for own in self.words]
        self.columns = [np.array(sorted(own), dtype=np.int64) for own in self.counts]
        self.numbers = [np.array([own[w] for w in sorted(own)], dtype=np.int64) for own in self.counts]
        self.needed = np.array([int(np.ceil(coverage * len(own) - 1e-9)) for own in self.words])

    def _windows(self, text: list[int], k: int, hits: np.ndarray):
        """Matches of one template: windows from each rare word on, a bit longer than the template; after a match, behind it."""
        template, need = self.words[k], self.needed[k]
        lead = next(i for i, w in enumerate(template) if w in self.rare[k])
        span = len(template) + len(template) // 2 + 4
        behind = soonest = 0
        for hit in hits.tolist():
            begin = max(behind, hit - lead - 2)
            if hit < behind or hit < soonest:
                continue
            window = text[begin : hit + span]
            if len(window) < need:
                return  # those after it are shorter still
            missing = need - (Counter(window) & self.counts[k]).total()
            if missing > 0:
                soonest = hit + missing  # a window gains no more words than it moves on by
                continue
            if not all(_holds(window, phrase) for phrase in self.required[k]):
                continue
            pairs = align(window, template)
            if len(pairs) >= need:
                first, last = begin + pairs[0][0], begin + pairs[-1][0]
                if not all(_holds(text[first : last + 1], phrase) for phrase in self.required[k]):
                    continue
                yield k, len(pairs), first, last
                behind = last + 1

    def scan(self, text: np.ndarray, candidates: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Template, matched words, first and last word of every match; of matches that overlap the one with most words."""
        own, found = text.tolist(), []
        for k in candidates:
            hits = np.flatnonzero(np.isin(text, list(self.rare[k])))
            found += self._windows(own, int(k), hits)
        kept: list[tuple[int, int, int, int]] = []
        for match in sorted(found, key=lambda m: (-m[1], -m[1] / len(self.words[m[0]]), m[0], m[2])):
            if all(match[3] < other[2] or match[2] > other[3] for other in kept):
                kept.append(match)
        return sorted(kept, key=lambda m: m[2])

    def scan_all(self, texts: pa.Array) -> list[list[tuple[int, int, int, int]]]:
        forms = normal_forms(texts.cast(pa.large_string()).fill_null(""))
        index, distinct, starts = words_of(forms)
        number = np.array([self.vocabulary.get(w, -1) for w in distinct.to_pylist()] or [0], dtype=np.int64)
        words = number[index]
        doc = np.repeat(np.arange(len(texts)), np.diff(starts))
        known = words >= 0
        size = len(self.vocabulary)
        counts = np.bincount(doc[known] * size + words[known], minlength=len(texts) * size).reshape(-1, size)
        shared = [np.minimum(counts[:, own], most).sum(axis=1) for own, most in zip(self.columns, self.numbers)]
        enough = np.stack(shared, axis=1) >= self.needed
        out: list[list[tuple[int, int, int, int]]] = [[] for _ in range(len(texts))]
        for row in np.flatnonzero(enough.any(axis=1)):
            out[row] = self.scan(words[starts[row] : starts[row + 1]], np.flatnonzero(enough[row]))
        return out


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """A row for each license text found in whole texts: doc_id, license_id, coverage, first_word, last_word, n_matched.

    Words are lower-case runs of letters and digits, numbered from 0 in the text. A match covers at least ``coverage`` of a
    template's words in order and holds the phrases that tell it from others (``REQUIRED``); of matches that overlap only the one with most words is given (ties: higher coverage,
    then the first name). Null and empty texts hold none, and documents without a match give no row. Rows that repeat
    are scanned each. A document may hold a license more than once.
    """
    own = Scanner(templates, coverage)

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                rows = [(row, *match) for row, found in enumerate(own.scan_all(batch.column("text"))) for match in found]
                taken = batch.column("doc_id").take(pa.array([r[0] for r in rows], type=pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        taken,
                        pa.array([own.names[r[1]] for r in rows], type=pa.string()),
                        pa.array([r[2] / len(own.words[r[1]]) for r in rows], type=pa.float64()),
                        *[pa.array([r[k] for r in rows], type=pa.int64()) for k in (3, 4, 2)],
                    ],
                    names=["doc_id", "license_id", "coverage", "first_word", "last_word", "n_matched"],
                )

    schema = "doc_id long, license_id string, coverage double, first_word long, last_word long, n_matched long"
    return map_batches(docs.select("doc_id", "text"), run, schema)


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All license texts found in all documents."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
