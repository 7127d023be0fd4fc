"""Quality rules, SimHash near-duplicates, lines, licenses."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from helpers import awkward, components, documents, prose
from pyspark.sql import functions as F

from storelake.llm import components as cc
from storelake.llm import license_texts, licenses, line_dedup, quality, simhash
from storelake.llm.scratch import Scratch
from storelake.llm.text import bit_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(words) < 5000 else None
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), None if covered is None else len(covered)


def test_quality_counts_match_brute_force(spark):
    rows = awkward() + [(20 + k, t, "a") for k, t in enumerate(["a b c a b c", "a a a a", "a b a b a", "x # * $", "l\nl\nl \n\n"])]
    judged = quality.judge(documents(spark, rows)).collect()
    assert len(judged) == len(rows)
    for row in judged:
        m = row.measures
        n, chars, symbols, lines, repeated = counts(row.text)
        assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines) == (n, chars, symbols, lines)
        if repeated is not None:
            assert m.n_repeat_words == repeated
            assert row.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert not (row.base_failed and row.kept)


@pytest.mark.parametrize(
    "text, failed",
    [
        (prose(3, 200), []),
        (" ".join(w + "###" for w in prose(3, 200).split()), ["symbols", "stop_words"]),
        (" ".join(w.upper() + "!!" for w in prose(3, 200).split()), ["shouting"]),
        (" | ".join(w for w in prose(3, 300).split() if len(w) > 4), ["symbols", "stop_words"]),
    ],
)
def test_each_rule(spark, text, failed):
    (row,) = quality.judge(documents(spark, [(1, text, "a")])).collect()
    assert set(failed) <= set(row.failed) if failed else row.failed == []


def test_quality_of_an_empty_table_and_no_python(spark):
    empty = quality.judge(documents(spark, []))
    assert empty.count() == 0
    assert "Python" not in empty._jdf.queryExecution().toString() and "Arrow" not in empty._jdf.queryExecution().toString()


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_bit_counts_of_long_segments():
    hashes = np.random.default_rng(0).integers(0, 1 << 63, 5000, dtype=np.uint64)
    starts = np.array([0, 0, 3, 1200, 1200, 5000])
    found = bit_counts(hashes, starts)
    for k in range(5):
        own = hashes[starts[k] : starts[k + 1]]
        assert found[k].tolist() == [int(((own >> np.uint64(b)) & np.uint64(1)).sum()) for b in range(64)]


def test_near_duplicates_match_brute_force(spark):
    draw, rows = random.Random(4), awkward()
    for k in range(60):
        words = prose(100 + k % 6, 120).split()
        for _ in range(draw.randint(0, 3)):
            words[draw.randrange(len(words))] = "changed"
        rows.append((100 + k, " ".join(words), "a"))
    found = simhash.near_duplicates(documents(spark, rows)).select("doc_id", "fp", "component_id").collect()
    codes = [fingerprint(t) for _, t, _ in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if bin(codes[a] ^ codes[b]).count("1") <= 4]
    least = {}
    root = components(range(len(rows)), links)
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[root[k]] = min(least.get(root[k], i), i)
    wanted = sorted((str(i), codes[k], str(least.get(root[k]))) for k, (i, _, _) in enumerate(rows))
    assert sorted((str(r.doc_id), r.fp % (1 << 64), str(r.component_id)) for r in found) == wanted
    once = simhash.one_of_each(documents(spark, rows))
    assert once.columns == documents(spark, []).columns and once.count() == len(set(root.values()))
    assert simhash.near_duplicates(documents(spark, [])).count() == 0 == simhash.one_of_each(documents(spark, [])).count()


def test_tiles_find_every_pair_within_the_radius(spark):
    draw = random.Random(1)
    codes = [draw.getrandbits(64) for _ in range(150)]
    codes += [c ^ sum(1 << b for b in draw.sample(range(64), draw.randint(1, 6))) for c in codes]
    signed = sorted({c - (1 << 64) if c >> 63 else c for c in codes})
    frame = spark.createDataFrame([(c,) for c in signed], "fp long")
    found = {r.fp: r["class"] for r in simhash.classes(frame).collect()}
    near = [(a, b) for a in signed for b in signed if b < a and bin((a ^ b) % (1 << 64)).count("1") <= 4]
    assert found == components(signed, near) and len(near) > 50


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    draw = random.Random(2)
    links = {
        "chain": [(k, k + 1) for k in range(40)],
        "star": [(99, k) for k in range(30)],
        "random": [(draw.randrange(60), draw.randrange(60)) for _ in range(45)],
        "none": [],
    }[shape]
    found = {r.node: r.component for r in cc.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == components({n for link in links for n in link}, links)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def alike(a, b, least=0.8):
    longer = max(len(a), len(b))
    return min(len(a), len(b)) >= least * longer - 1e-9 and edit_distance(a, b) <= int(longer - least * longer + 1e-9)


def lines_by_brute_force(rows, close, min_letters=line_dedup.MIN_LETTERS):
    """Texts after deduplication, each with its row; rows in order of doc_id. Links are those of ``close`` and edit similarity."""
    forms, places = {}, []
    for k, (_, text, _) in enumerate(rows):
        split = (text or "").split("\n")
        for n, form in enumerate(line_dedup.normal_forms(pa.array(split, type=pa.large_string())).to_pylist()):
            if len(form) >= min_letters:
                places.append((k, n, forms.setdefault(form, len(forms))))
    names = list(forms)
    near = close(names)
    links = [(a, b) for a in range(len(names)) for b in range(a) if near(a, b) and alike(names[a], names[b])]
    root, first = components(range(len(names)), links), {}
    for k, n, f in places:
        first.setdefault(root[f], (k, n))
    gone = {(k, n) for k, n, f in places if first[root[f]] != (k, n)}
    return [
        None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (k, n) not in gone)
        for k, (_, t, _) in enumerate(rows)
    ]


def by_blocks(names):
    """Which lines the operator verifies, stated plainly: a common block, and few bits between the two other words."""
    codes = line_dedup.simhashes(names).tolist()
    mask = (1 << line_dedup.BLOCK_BITS) - 1

    def near(a, b):
        longer = max(len(names[a]), len(names[b]))
        share = next(s for up_to, s in line_dedup.RADII if up_to is None or longer <= up_to)
        for word in range(line_dedup.WORDS):
            shifts = [line_dedup.BLOCK_BITS * n for n in range(line_dedup.PER_WORD)]
            if any((codes[a][word] ^ codes[b][word]) >> s & mask == 0 for s in shifts):
                apart = [(codes[a][(word + n) % 4] ^ codes[b][(word + n) % 4]).bit_count() for n in range(4)]
                seen = apart[1] + apart[2] <= int(128 * (share + line_dedup.ROOM))
                first = apart[1] <= line_dedup._FIRST
                if seen and first and sum(apart) <= int(256 * share):
                    return True
        return False

    return near


def fuzzy_rows(seed, n):
    draw, rows = random.Random(seed), []
    lines = [prose(1000 * seed + k, draw.randint(3, 40)) for k in range(30)]
    for k in range(n):
        text = []
        for line in draw.sample(lines, 4):
            words = line.split()
            for _ in range(draw.choice([0, 0, 1, 2, 5])):
                words[draw.randrange(len(words))] += draw.choice(["", "x", "!", "S"])
            text.append(" ".join(words))
        rows.append((k, "\n".join([*text, "short one"]), "a"))
    return rows


def test_pairs_far_apart_in_the_whole_code_do_not_leave_their_bucket():
    """Pairs close in the two words of a bucket alone left it as rows that grew with the square of the lines."""
    draw = random.Random(3)
    words = [[draw.getrandbits(62) for _ in line_dedup.CODES] for _ in range(60)]
    words += [[w ^ 5 for w in row] for row in words[:20]]  # twenty pairs are close in all words
    n = len(words)
    columns = {"bucket": [7] * n, "line_id": list(range(n)), "component": list(range(n)), "one": [9] * n, "two": [11] * n}
    columns |= {k: [row[i] for row in words] for i, k in enumerate(line_dedup.CODES)}
    batch = pa.RecordBatch.from_pydict({**columns, "size": pa.array([100] * n, pa.int32())})
    for leave in (line_dedup._across, line_dedup._spanning):
        found = pa.Table.from_batches(leave(iter([batch])))
        assert list(zip(*(found.column(c).to_pylist() for c in "ab"))) == [(k, k + 60) for k in range(20)]


def bucket_of(block, lines):
    """One bucket of a block as the operator deals it: (line_id, four words), no line joined to another."""
    word, place = divmod(block, line_dedup.PER_WORD)
    bits = lines[0][1][word] >> (place * line_dedup.BLOCK_BITS) & ((1 << line_dedup.BLOCK_BITS) - 1)
    columns = {"bucket": [block << line_dedup.BLOCK_BITS | bits] * len(lines)}
    columns |= {c: [n for n, _ in lines] for c in ("line_id", "component")}
    columns |= {c: [row[(word + k) % 4] for _, row in lines] for k, c in ((1, "one"), (2, "two"))}
    columns |= {k: [row[i] for _, row in lines] for i, k in enumerate(line_dedup.CODES)}
    return pa.RecordBatch.from_pydict({**columns, "size": pa.array([100] * len(lines), pa.int32())})


def test_a_pair_leaves_one_of_its_buckets_only():
    """A pair left every bucket in which it met: rows that grew with the square of a family of lines, twenty times over."""
    draw = random.Random(5)
    word = [draw.getrandbits(62) for _ in line_dedup.CODES]
    family = [(n, [*word[:3], word[3] ^ 1 << n]) for n in range(12)]  # alike but for a bit of the first block of the last word
    found = pa.Table.from_batches(line_dedup._across(bucket_of(block, family) for block in (0, 1, 6, 19)))
    assert found.num_rows == 66 and found.group_by(["a", "b"]).aggregate([]).num_rows == 66
    late = pa.Table.from_batches(line_dedup._across(iter([bucket_of(0, family[:2]), bucket_of(19, family)])))
    assert late.num_rows == 1  # all others are left to the bucket of block 0


def test_spanning_pairs_are_close_themselves():
    """A family was joined by links to its first line, close to it or not, of which most were not similar."""
    draw = random.Random(6)
    word = [draw.getrandbits(62) for _ in line_dedup.CODES]
    ones = [0, (1 << 12) - 1, (1 << 24) - 1, (1 << 36) - 1, (1 << 48) - 1]  # each twelve bits from the next in every word but the first
    chain = [(n, [word[0], *[w ^ x & (1 << 62) - 1 for w in word[1:]]]) for n, x in enumerate(ones)]
    found = pa.Table.from_batches(line_dedup._spanning(iter([bucket_of(0, chain)])))
    assert list(zip(*(found.column(c).to_pylist() for c in "ab"))) == [(0, 1), (1, 2), (2, 3), (3, 4)]


def test_lines_close_in_two_words_alone_do_not_go_on():
    """Lines were passed on for two words that agree, so that their rows grew with the square of the table."""
    draw, most = random.Random(9), line_dedup.RADII[0][1]
    lines = [(n, [draw.getrandbits(62), draw.getrandbits(50) << 12, *(draw.getrandbits(36) for _ in "ab")]) for n in range(60)]
    lines += [(60 + n, [word ^ 1 << 40 for word in row]) for n, row in lines[:3]]
    apart = [(a, b, [(x ^ y).bit_count() for x, y in zip(one, two)]) for a, one in lines for b, two in lines[:a]]
    seen = [x for x in apart if x[2][2] <= line_dedup._FIRST and sum(x[2][2:]) <= int(128 * (most + line_dedup.ROOM))]
    close = {line for a, b, bits in seen if sum(bits) <= int(256 * most) for line in (a, b)}
    assert len(seen) > 1000 and {0, 1, 2, 60, 61, 62} <= close and len(close) < 20
    found = line_dedup._members(iter([bucket_of(5, lines)]))  # block 5 is the first of the second word
    assert sorted(row for batch in found for row in batch.column("line_id").to_pylist()) == sorted(close)


def test_buckets_that_grow_with_the_table_are_dealt_once(spark, monkeypatch):
    """Beyond two tiles in every bucket each line was copied to all tiles of its twenty buckets, all of them in one shuffle."""
    draw, n, dealt = random.Random(10), 1 << 15, []
    rows = [(k, 100, k, 0, 0, *(draw.getrandbits(62) for _ in line_dedup.CODES)) for k in range(n)]
    codes = ", ".join(f"{c} long" for c in line_dedup.CODES)
    flat = spark.createDataFrame(rows, f"line_id long, size int, id long, h long, line_no int, {codes}")
    distinct = flat.withColumn("first", F.struct("id", "h", "line_no")).drop("id", "h", "line_no")
    docs = spark.createDataFrame([], "id long, h long, text string")
    plain = line_dedup.map_batches

    def counted(df, run, schema):
        dealt.append(df.count() if run is line_dedup._members or "large" in schema else 0)
        return plain(df, run, schema)

    monkeypatch.setattr(line_dedup, "map_batches", counted)
    monkeypatch.setattr(line_dedup, "DEALT", 1 << 17, raising=False)
    scratch = Scratch(spark)
    assert line_dedup.near_links(docs, distinct, 2, scratch).count() == 0
    scratch.clear()
    assert [rows for rows in dealt if rows] == [4 * n] * 5


def test_shuffle_files_go_with_their_query(spark):
    """They stayed until the driver happened to collect its garbage, all of an operator's beside each other."""
    kept_by = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        every = kept_by.getAllFiles()
        return {name for k in range(every.size()) if (name := every.apply(k).getName()).startswith("shuffle_")}

    before, option = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(option, None)
    line_dedup.dedup_lines(documents(spark, fuzzy_rows(5, 30)))
    for _ in range(100):
        if not (left := files() - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(option, None) == setting


@pytest.mark.parametrize("tile", [2, 2048])
def test_lines_match_brute_force(spark, tile):
    rows = fuzzy_rows(3, 60)
    found = {r.doc_id: r for r in line_dedup.dedup_lines(documents(spark, rows), tile=tile).collect()}
    assert [found[k].text for k in range(60)] == lines_by_brute_force(rows, by_blocks)
    assert all(r.n_lines == 5 for r in found.values()) and sum(r.n_dropped for r in found.values()) > 100


def changed(draw, line, kind):
    words = line.split()
    if kind == "word":
        words[draw.randrange(len(words))] = "".join(draw.choice("abcdefghij") for _ in range(5))
        return " ".join(words)
    letters = list(line)
    for i in draw.sample(range(len(letters)), max(1, int(kind * len(letters)))):
        letters[i] = draw.choice("abcdefghij")
    return "".join(letters)


@pytest.mark.parametrize("kind, words, recall", [("word", (5, 9), 0.6), ("word", (10, 40), 0.9), (0, (5, 40), 0.9), (0.05, (5, 40), 0.7), (0.1, (5, 40), 0.2)])
def test_recall_against_edit_similarity_alone(spark, kind, words, recall):
    draw, rows, asked = random.Random(8), [], 0
    for k in range(300):
        line = prose(5000 + k, draw.randint(*words))
        other = changed(draw, line, kind)
        if line != other and len(line) >= line_dedup.MIN_LETTERS and alike(line, other):
            rows += [(2 * k, line, "a"), (2 * k + 1, other, "a")]
            asked += 1
    kept = line_dedup.dedup_lines(documents(spark, rows)).collect()
    gone = {r.doc_id for r in kept if r.n_dropped}
    assert asked > 150 and len(kept) == len(rows)
    assert len({k for k in gone if k % 2}) >= recall * asked


def test_every_row_comes_back(spark):
    text = "one line that is long enough\nand another one that is long enough\nshort"
    rows = [(1, text, "en", "a"), (1, text, "fr", "b"), (1, text, "fr", "b"), (None, None, "x", "y"), (None, None, "x", "y"), (2, "short", "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for name in ("n_lines", "n_dropped", "id", "h", "whole", "row", "lost", "first", "c0"):
        docs = docs.withColumn(name, F.lit(name))
    plain = line_dedup.dedup_lines(docs, counts=())
    assert plain.columns == docs.columns
    found = plain.collect()
    assert all(r[name] == name for r in found for name in docs.columns[4:])
    assert sorted((r.doc_id or 0, r.text or "", r.lang, r.source) for r in found if r.text != "short" or r.doc_id == 2) == sorted(
        [(1, text, *next((r.lang, r.source) for r in found if r.text == text)), (0, "", "x", "y"), (0, "", "x", "y"), (2, "short", "", "")]
    )
    assert sum(r.text == "short" and r.doc_id == 1 for r in found) == 2
    assert sorted((r.lang, r.source) for r in found) == sorted((x[2], x[3]) for x in rows)


def test_lines_of_awkward_documents(spark):
    kept = line_dedup.dedup_lines(documents(spark, awkward()))
    assert set(documents(spark, []).columns) <= set(kept.columns)
    found = kept.collect()
    assert len(found) == len(awkward())
    texts = {r.doc_id: r.text for r in sorted(found, key=lambda r: r.text or "") if r.doc_id is not None}
    assert texts[1] is None and texts[2] == "" and texts[5] == "" and texts[7] == "one line that comes again and again"
    assert texts[4] == prose(1, 80) and texts[6] == prose(2, 30_000)
    assert line_dedup.dedup_lines(documents(spark, [])).count() == 0


def test_similarity_matches_the_table(spark):
    draw = random.Random(5)
    rows = [tuple("".join(draw.choice("abc ") for _ in range(draw.randint(0, 12))) for _ in range(2)) for _ in range(1500)]
    found = spark.createDataFrame(rows, "a string, b string").select("a", "b", line_dedup.similar("a", "b").alias("s")).collect()
    assert all(r.s == alike(r.a, r.b) for r in found) and 10 < sum(r.s for r in found) < 1400



def test_licenses(spark):
    mit, apache = license_texts.TEMPLATES["MIT"], license_texts.TEMPLATES["Apache-2.0"]
    rows = awkward() + [
        (30, prose(5, 400) + "\nReleased under the MIT License.\n" + prose(6, 400), "a"),
        (31, prose(5, 300) + " " + mit.replace("obtaining", "getting", 1) + "\n" + prose(6, 20) + " " + apache, "a"),
        (32, "Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0.", "a"),
        (33, "the license of the work is under discussion", "a"),
    ]
    found = sorted((r.doc_id, r.license_id, r.n_matched) for r in licenses.scan(documents(spark, rows)).collect())
    words = {n: len(line_dedup.normal_forms(pa.array([t]))[0].as_py().split()) for n, t in license_texts.TEMPLATES.items()}
    assert found == [
        (30, "MIT-notice", 5), (31, "Apache-2.0", words["Apache-2.0"]), (31, "MIT", words["MIT"] - 1),
        (32, "CC-BY-NC-4.0-notice", 7), (32, "CC-BY-NC-4.0-notice", 7),
    ]
    assert licenses.scan(documents(spark, [])).count() == 0


def test_close_licenses_are_told_apart(spark):
    gpl = license_texts.TEMPLATES["GPL-3.0-or-later"]
    second = gpl.replace("version 3", "version 2")
    lesser, affero = gpl.replace("GNU General", "GNU Lesser General"), gpl.replace("GNU\nGeneral", "GNU Affero General").replace("GNU General", "GNU Affero General")
    lesser = lesser.replace("GNU\nGeneral", "GNU Lesser General")
    two = license_texts.TEMPLATES["BSD-2-Clause"]
    three = two + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    texts = {
        "GPL-3.0-or-later": gpl, "GPL-2.0-or-later": second, "LGPL-3.0-or-later": lesser, "AGPL-3.0-or-later": affero,
        "BSD-2-Clause": two, "BSD-3-Clause": three, "CC-BY-NC-SA-4.0-notice": "Licensed under CC BY-NC-SA 4.0.",
        "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.", "CC-BY-SA-3.0-notice": "Licensed under CC BY-SA 3.0.",
        "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    }
    rows = [(k, prose(k, 30) + "\n" + text + "\n" + prose(50 + k, 30), "a") for k, text in enumerate(texts.values())]
    rows.append((99, "Released under the ISC License.", "a"))
    found = {(r.doc_id, r.license_id) for r in licenses.scan(documents(spark, rows)).collect()}
    assert found == set(enumerate(texts))


def test_alignment_is_a_common_subsequence():
    draw = random.Random(7)
    for _ in range(300):
        a, b = ([draw.randrange(12) for _ in range(draw.randint(0, 20))] for _ in range(2))
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x < y and p < q for (x, p), (y, q) in zip(pairs, pairs[1:]))
    same = list(range(30))
    assert licenses.align(same, same) == [(k, k) for k in range(30)]
    assert len(licenses.align([50, *same[:10], 51, *same[12:], 52], same)) == 28


def test_whole_license_texts_go_by_their_own_names(spark):
    names = sorted(license_texts.BODIES)
    rows = [(k, prose(k, 60) + "\n" + license_texts.BODIES[n] + "\n" + prose(70 + k, 60), "a") for k, n in enumerate(names)]
    tags = ["MIT", "GPL-2.0-only", "GPL-2.0-or-later"]
    rows += [(90 + k, f"// SPDX-License-Identifier: {tag}\n" + prose(3, 20), "a") for k, tag in enumerate(tags)]
    found = sorted((r.doc_id, r.license_id) for r in licenses.scan(documents(spark, rows)).collect())
    assert found == [(k, f"{n}-text") for k, n in enumerate(names)] + [(90 + k, f"{tag}-tag") for k, tag in enumerate(tags)]


def matches_of_all_windows(scanner, text):
    """All matches of each template, every window being aligned, and of those that overlap the best."""
    found = []
    for k, template in enumerate(scanner.words):
        lead, behind = next(i for i, w in enumerate(template) if w in scanner.rare[k]), 0
        for hit in (i for i, w in enumerate(text) if w in scanner.rare[k]):
            if hit >= behind:
                begin = max(behind, hit - lead - 2)
                pairs = licenses.align(text[begin : hit + len(template) + len(template) // 2 + 4], template)
                if len(pairs) >= scanner.coverage * len(template) - 1e-9:
                    found.append((k, len(pairs), begin + pairs[0][0], begin + pairs[-1][0]))
                    behind = begin + pairs[-1][0] + 1
    kept = []
    for m in sorted(found, key=lambda m: (-m[1], -m[1] / len(scanner.words[m[0]]), m[0], m[2])):
        if all(m[3] < other[2] or m[2] > other[3] for other in kept):
            kept.append(m)
    return sorted(kept, key=lambda m: m[2])


def test_license_windows_match_brute_force():
    draw, total = random.Random(11), 0
    for _ in range(150):
        vocabulary = [f"w{n}" for n in range(draw.randint(4, 30))]
        templates = {f"t{n}": " ".join(draw.choices(vocabulary, k=draw.randint(3, 25))) for n in range(4)}
        own, texts = licenses.Scanner(templates), []
        for _ in range(5):
            parts = [" ".join(draw.choices(vocabulary, k=draw.randint(0, 15))) for _ in range(3)]
            texts.append(" ".join([parts[0], draw.choice(list(templates.values())), parts[1], draw.choice(list(templates.values())), parts[2]]))
        for text, found in zip(texts, own.scan_all(pa.array(texts, type=pa.large_string()))):
            wanted = matches_of_all_windows(own, [own.vocabulary.get(w, -1) for w in text.split()])
            assert [tuple(int(x) for x in m) for m in found] == wanted
            total += len(wanted)
    assert total > 500
