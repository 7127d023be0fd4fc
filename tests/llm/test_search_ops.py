"""Hard negatives, periodic runs and benchmark decontamination against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, documents, prose
from pyspark.sql import functions as F

from storelake.llm import contamination, negatives, runs
from storelake.llm.suffixes import Suffixes
from storelake.llm.words import PLAIN, SPACED, hashed_words, slices

SMALL = "/root/testdata/sf0.001"
PLAIN_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SPACED_WORD = re.compile("[^\x20\x09-\x0d]+")


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


# Words and suffixes.


def test_words_are_those_of_the_patterns():
    draw = random.Random(1)
    letters = ["a", "B", "z", "0", "É", "中", "\x1c", "\x00", " ", "\n", "\x0b", ",", "{", "\x7f", "\x80"]
    texts = [None, "", " "] + ["".join(draw.choice(letters) for _ in range(draw.randint(0, 30))) for _ in range(400)]
    for kind, words in (
        (PLAIN, [PLAIN_WORD.findall(lowered(t)) for t in texts]),
        (SPACED, [SPACED_WORD.findall(t or "") for t in texts]),
    ):
        for arrow in (pa.array(texts), pa.array(["x y", *texts, "z"]).slice(1, len(texts))):
            hashes, starts = hashed_words(arrow, kind)
            assert np.diff(starts).tolist() == [len(w) for w in words]
            number = {}
            for word, value in zip((w for own in words for w in own), hashes.tolist()):
                assert number.setdefault(word, value) == value
            assert len(set(number.values())) == len(number)


def test_slices_cover_all_rows():
    texts = pa.array(["a" * n for n in (3, 50, 1, 0, 9)] + [None, "b"])
    found = list(slices(texts, 10))
    assert [a for a, _ in found][1:] == [b for _, b in found][:-1] and found[0][0] == 0 and found[-1][1] == 7
    assert list(slices(pa.array([], type=pa.string()))) == []


@pytest.mark.parametrize("letters", [1, 2, 5, 3000])
def test_suffixes_are_sorted_and_searched(letters):
    draw = np.random.default_rng(letters)
    symbols = draw.integers(1, letters + 1, 300)
    symbols[[50, 51, 170, 299]] = 0
    found = Suffixes(symbols, len(symbols), keep=True)
    text = symbols.tolist()
    assert found.order.tolist() == sorted(range(300), key=lambda i: text[i:])
    a, b = draw.integers(0, 300, 500), draw.integers(0, 300, 500)

    def common(x, y):
        n = 0
        while n < min(len(x), len(y)) and x[n] == y[n]:
            n += 1
        return n

    kept = a != b
    a, b = a[kept], b[kept]
    assert found.common(a, b).tolist() == [common(text[i:], text[j:]) for i, j in zip(a, b)]
    asked = np.concatenate([np.maximum(symbols[20:60], 1), draw.integers(1, letters + 2, 60)])
    begin, size = draw.integers(0, 80, 90), draw.integers(1, 12, 90)
    low, high = found.find(asked, begin, size)
    length, where = found.longest(asked, begin, size)
    for q in range(90):
        own = asked[begin[q] : begin[q] + size[q]].tolist()
        assert sorted(found.order[low[q] : high[q]].tolist()) == [i for i in range(300) if text[i : i + len(own)] == own]
        assert length[q] == max(common(own, text[i:]) for i in range(300))
        assert not length[q] or text[where[q] : where[q] + length[q]] == own[: length[q]]


# Periodic runs.


def brute_runs(words, repeats=4, least=6):
    found, number = {}, {}
    own = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    for q in range(1, len(words) // repeats + 1):
        same = np.concatenate([[0], (own[:-q] == own[q:]).astype(int), [0]])
        edges = np.flatnonzero(np.diff(same))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start + q >= max(least, repeats * q):
                found.setdefault((start, end - start + q), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def brute_collapsed(words, found):
    dropped = {k for s, length, q in found for k in range(s + q, s + length)}
    return " ".join(w for k, w in enumerate(words) if k not in dropped)


def periodic(draw):
    words = []
    while len(words) < draw.randint(1, 120):
        part = [draw.choice("abcde") for _ in range(draw.randint(1, 9))]
        words += (part * draw.choice([1, 1, 2, 4, 5, 9]))[: draw.randint(1, 60)]
    return words


def test_runs_match_brute_force(spark):
    draw = random.Random(4)
    rows = [(k, " \n".join(periodic(draw)), "a") for k in range(400)] + [
        (500, "a " * 3000, "a"),
        (501, "a b " * 900 + "a a a a a a " * 50 + "b a b", "a"),
        (502, " ".join("abab" * 6 + "c") * 8, "a"),
        (503, ("x y z " * 5 + "q ") * 6, "a"),
    ]
    rows += [(600 + k, text, s) for k, (_, text, s) in enumerate(awkward())]
    found = runs.find_runs(documents(spark, rows).withColumn("runs", F.lit(1))).collect()
    assert len(found) == len(rows) and {r["fp"] for r in found} == {"fp"}
    by_id = {r["doc_id"]: r for r in found}
    for i, text, _ in rows:
        words = SPACED_WORD.findall(text or "")
        wanted = brute_runs(words)
        assert [tuple(x) for x in by_id[i]["runs"]] == wanted, i
        assert by_id[i]["collapsed"] == brute_collapsed(words, wanted)
    assert sum(len(r["runs"]) for r in found) > 300
    assert runs.find_runs(documents(spark, [])).count() == 0
    other = {r["doc_id"]: r["runs"] for r in runs.find_runs(documents(spark, rows[:100]), repeats=5, least=12).collect()}
    for i, text, _ in rows[:100]:
        assert [tuple(x) for x in other[i]] == brute_runs(SPACED_WORD.findall(text), 5, 12)


def test_many_left_words_and_shared_texts(spark):
    draw = random.Random(8)
    line = "one line that comes up again"
    scattered = " ".join(f"{line} {draw.randint(0, 10**9)}" for _ in range(4000))
    rows = [(k, scattered, "a") for k in range(3)] + [(9, " ".join([line] * 4000), "b")]
    found = {r["doc_id"]: r for r in runs.find_runs(documents(spark, rows)).collect()}
    assert all(found[k]["runs"] == [] and found[k]["collapsed"] == scattered for k in range(3))
    assert [tuple(x) for x in found[9]["runs"]] == [(0, 24000, 6)] and found[9]["collapsed"] == line


def planted(doc_id, text):
    words = SPACED_WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_op12_matches_brute_force(spark, tmp_path):
    draw = random.Random(6)
    rows = [(k, prose(k, draw.choice([1, 3, 9, 40, 200])), "a") for k in range(300)] + awkward()
    rows += [(k + 1000, " ".join(periodic(draw)), "a") for k in range(100)]
    rows = [r for r in rows if r[1] is None or len(r[1]) < 50_000]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = runs.op12_runs(spark, str(tmp_path)).collect()
    wanted = []
    for i, text, _ in rows:
        words = planted(i, text)
        own = brute_runs(words)
        best = min(own, key=lambda r: (-r[1], r[0], r[2])) if own else (None,) * 3
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in own)
        kept = brute_collapsed(words, own)
        wanted.append(
            (i, len(own), *best, 1000 * best[1] // best[2] if own else None,
             *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))
        )
    order = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, found), key=order) == sorted(wanted, key=order)
    assert sum(r["n_runs"] > 0 for r in found) > 50


# Decontamination.

ITEMS = [
    ("7", "One two three, four five six seven eight nine TEN eleven twelve."),
    ("10", "one two three four five six seven eight nine ten ELEVEN twelve"),
    ("8", "short item"), ("9", None), ("11", " ,. "), (None, "no id"), ("é", "中文 x"), ("12", "a a a a a a a a a a a a a"),
    ("13", "tail of the first"), ("7", "Another text under a number that is taken, and it goes on for twelve words"),
]


def brute_hits(texts, items, width=10):
    out = []
    for text in texts:
        words, hit, names = PLAIN_WORD.findall(lowered(text)), set(), set()
        for item, item_text in items:
            own = PLAIN_WORD.findall(lowered(item_text))
            size = min(len(own), width)
            grams = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if own else set()
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) in grams:
                    hit |= set(range(i, i + size))
                    names |= {item} - {None}
        out.append((len(words), len(hit), sorted(names)))
    return out


def leaky_texts():
    draw = random.Random(3)
    passages = [PLAIN_WORD.findall(lowered(t)) for _, t in ITEMS]
    texts = ["tail of the", "first", "a " * 25, "A, a a a a a a a a", None, "", "中文, X y", "short-item SHORT ITEM"]
    for k in range(250):
        words = prose(k, draw.randint(0, 40)).split()
        for own in draw.sample(passages, 2):
            cut = draw.randint(0, len(own))
            at = draw.randint(0, len(words))
            words[at:at] = draw.choice([own, own[:cut], own[cut:], own * 2])
        texts.append(draw.choice([" ", ", ", "\n"]).join(words))
    return texts


@pytest.mark.parametrize("block_words", [1 << 20, 14, 1])
def test_hits_match_brute_force(spark, block_words):
    texts = leaky_texts()
    docs = documents(spark, [(k, t, "a") for k, t in enumerate(texts)] + [(None, texts[0], "b")] * 2).withColumn("spans", F.lit(1))
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    found = contamination.hits(docs, items, block_words=block_words)
    assert found.columns[:2] == ["doc_id", "lang"] and found.columns[-3:] == ["n_words", "spans", "items"]
    rows = found.withColumn("n_hit", contamination.n_hit()).collect()
    by_id = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in rows}
    wanted = brute_hits(texts, ITEMS)
    assert len(rows) == len(texts) + 2 and sum(x[1] > 0 for x in wanted) > 60
    for k, want in enumerate(wanted):
        assert by_id[k] == want, texts[k]


def test_affected_documents_are_removed(spark):
    texts = leaky_texts()
    docs = documents(spark, [(k, t, "a") for k, t in enumerate(texts)]).withColumn("row", F.lit("x")).withColumn("items", F.lit("y"))
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    left = contamination.remove_contaminated(docs, items)
    assert left.columns == docs.columns
    clean = {k for k, (_, n, _) in enumerate(brute_hits(texts, ITEMS)) if not n}
    rows = left.collect()
    assert {r["doc_id"] for r in rows} == clean and all(r["row"] == "x" and r["items"] == "y" and r["text"] == texts[r["doc_id"]] for r in rows)
    none = spark.createDataFrame([("1", None), ("2", "")], "item_id string, text string")
    assert contamination.remove_contaminated(docs, none).count() == len(texts)
    assert contamination.hits(documents(spark, []), items).count() == 0
    counted = contamination.hits(docs, none.limit(0)).agg(F.sum("n_words"), F.sum(F.size("spans"))).first()
    assert tuple(counted) == (sum(len(PLAIN_WORD.findall(lowered(t))) for t in texts), 0)


def test_longest_matches(spark):
    texts = leaky_texts()
    docs = documents(spark, [(k, t, "a") for k, t in enumerate(texts)]).repartition(5)
    items = spark.createDataFrame([i for i in ITEMS if i[0] not in ("7", None)], "item_id string, text string")
    words = [PLAIN_WORD.findall(lowered(t)) for t in texts]
    for block_words in (1 << 20, 5):
        rows = contamination.longest_matches(docs, items, block_words=block_words).collect()
        by_suffix = {(r["item"], r["item_word"]): r for r in rows}
        for item, text in ITEMS:
            own = PLAIN_WORD.findall(lowered(text))
            if item in ("7", None) or not own:
                continue
            for k in range(len(own) - min(len(own), 10) + 1):
                rest, best = own[k:], 0
                for w in words:
                    for i in range(len(w)):
                        n = 0
                        while n < len(rest) and i + n < len(w) and w[i + n] == rest[n]:
                            n += 1
                        best = max(best, n)
                if best >= min(len(own), 10):
                    r = by_suffix.pop((item, k))
                    assert r["length"] == best
                    assert words[r["doc_id"]][r["doc_word"] : r["doc_word"] + best] == rest[:best]
        assert not by_suffix


# Hard negatives.


def brute_negatives(rows, anchors, k=5, m=10):
    out = []
    usable = [(n, i, y, v) for n, (i, y, v) in enumerate(rows) if None not in (i, y, v) and v and None not in v]
    for a, i, y, v in usable:
        if not anchors(i):
            continue
        scored = [(-sum(p * q for p, q in zip(v, w)), j, b, z) for b, j, z, w in usable if len(w) == len(v)]
        positives = sorted(s for s in scored if s[3] == y and s[2] != a)[:k]
        for p, j, _, _ in positives:
            fit = sorted(s for s in scored if s[3] != y and -30 * p <= -100 * s[0] <= -90 * p)[:m]
            out += [(i, j, r + 1, s[1], -p, -s[0]) for r, s in enumerate(fit)]
    return sorted(out)


def vectors(seed, n, dims, spread):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, dims))
    rows = []
    for k in range(n):
        v = (centres[draw.integers(6)] + spread * draw.normal(size=dims)) * 2.0 ** draw.integers(-2, 3)
        rows.append((k, int(draw.integers(4)), np.floor(v * 20).astype(int).tolist()))
    return rows


@pytest.mark.parametrize("dims, spread, bucket, block, focus", [(3, 0.3, 40, 7, 2), (8, 0.6, 4096, 1024, 4), (1, 1.0, 25, 3, 3)])
def test_negatives_match_brute_force(spark, dims, spread, bucket, block, focus):
    rows = vectors(dims, 400, dims, spread)
    rows += [(400, None, rows[0][2]), (401, 1, None), (402, 1, [None] * dims), (None, 1, rows[1][2]), (403, 9, rows[2][2])]
    rows += [(410, 1, [0] * dims), (420, 2, rows[5][2][:-1]), (430, 1, []), (440, 5, rows[7][2] + [3]), (450, 4, rows[8][2] + [1])]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<int>").withColumn("row", F.lit("x")).withColumn("part", F.lit(1))
    found = negatives.mine(df, F.col("vec_id") % 10 == 0, bucket=bucket, block=block, focus=focus)
    assert sorted(map(tuple, found.collect())) == brute_negatives(rows, lambda i: i % 10 == 0)
    assert negatives.mine(df, F.lit(False)).count() == 0 and negatives.mine(df.limit(0), F.lit(True)).count() == 0


def test_negatives_of_repeated_rows_and_large_numbers(spark):
    rows = [(k % 5, k % 2, [1 << 27, k % 3]) for k in range(60)] + [(7, 0, [-5, 2]), (7, 1, [-5, 2])]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<bigint>")
    found = negatives.mine(df, F.col("vec_id").isin(0, 7), bucket=10)
    assert sorted(map(tuple, found.collect())) == brute_negatives(rows, lambda i: i in (0, 7))


def test_pruning_keeps_all_that_reach_the_bound():
    draw = np.random.default_rng(3)
    rows = np.floor(draw.normal(size=(500, 16)) * 50).astype(np.int64)
    rows[::50] = 0
    bucket, fewer = negatives.Bucket(rows), 0
    for query in [*rows[:40], np.zeros(16, dtype=np.int64), 9 * np.eye(16, dtype=np.int64)[3]]:
        scores = rows @ query
        for least in (*np.sort(scores)[[-1, -2, -10, -100]].tolist(), 1, 0, -5):
            kept = bucket.candidates(query, float(least), 4)
            assert set(np.flatnonzero(scores >= least)) <= set(kept.tolist())
            fewer += len(kept) < len(rows)
    assert fewer > 50


def test_vectors_become_whole_numbers(spark):
    rows = [(1, [0.5, -0.001]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, None), (5, [None, 1.0]), (6, [])]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<float>")
    found = {r[0]: r[1] for r in df.select("vec_id", negatives.whole_vectors(df)).collect()}
    assert found == {1: [128, -1], 2: None, 3: None, 4: None, 5: None, 6: []}
