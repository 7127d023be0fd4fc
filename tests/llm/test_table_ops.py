"""Token files, mixing, toxicity, nearest neighbours, packing, chat formatting, the pipeline and the registry."""

import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import awkward, documents, prose
from pyspark.sql import functions as F

from storelake.llm import ann, chat, encoding, mixing, packing, token_files, toxicity
from storelake.llm.gru import Network

SMALL = "/root/testdata/sf0.001"
ALPHABET = [
    "a", "Bc", "é", "É", "é", " ", "  ", "\n", "\t", " ", "\x1c", "\x85", ".", ",", "'s", "'", "don't", "12", "３",
    "<|endoftext|>", "<|", "\U0001f642", "中文", "​", "Σ", "ς", "_", "\r\n", "²", "ß", "\x00", "İ", "　", "the", "The.",
    "lès, ", "fooBar,", "x.", "é,", " ß", " Ünder.",
]


@pytest.mark.parametrize("name, kind", [("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", "byte")])
def test_chunks_give_the_ids_of_the_tokenizer(name, kind):
    from tokenizers import Tokenizer

    plain, own, draw = Tokenizer.from_file(encoding.vocabulary(name)), encoding.Encoder(encoding.vocabulary(name), kind), random.Random(1)
    for _ in range(1500):
        text = "".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 14)))
        ids, starts = own.encode([text, None, text + " x"], 7)
        assert ids[: starts[1]].tolist() == plain.encode(text, add_special_tokens=False).ids + [7], repr(text)
        assert ids[starts[1] : starts[2]].tolist() == [7]


@pytest.mark.parametrize("name, kind", [("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", "byte")])
def test_ids_stay_right_when_tables_are_full(monkeypatch, name, kind):
    monkeypatch.setattr(encoding, "MAX_CHUNKS", 60)
    own, draw = encoding.Encoder(encoding.vocabulary(name), kind), random.Random(4)
    for k in range(200):
        text = " ".join(draw.choice(["one", "two,", "three.", f"x{draw.randrange(90)}", f"y{k},"]) for _ in range(20))
        ids, _ = own.encode([text], 7)
        assert ids.tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids + [7]


def encoded(name, text, end):
    from tokenizers import Tokenizer

    return np.array(Tokenizer.from_file(encoding.vocabulary(name)).encode(text or "", add_special_tokens=False).ids + [end], dtype="<u4")


def test_token_files_round_trip(spark, tmp_path):
    rows = [r for r in awkward() if r[0] is not None]
    path = str(tmp_path / "tokens")
    token_files.write_tokens(documents(spark, awkward()), path)
    read = token_files.read_tokens(spark, path).filter("doc_id is not null").orderBy("doc_id").collect()
    wanted = {i: encoded("word_bpe_49k.json", t, 2).tolist() for i, t, _ in rows}
    assert [r.doc_id for r in read] == sorted(i for i, _, _ in rows)
    assert all(r.ids == wanted[r.doc_id] for r in read)
    starts = {r.doc_id: (r.start, r.n_tokens) for r in token_files.read_starts(spark, path).collect()}
    before = sum(len(encoded("word_bpe_49k.json", t, 2)) for i, t, _ in awkward() if i is None)
    for i in sorted(wanted):
        if i != 4:  # listed twice
            assert starts[i] == (before, len(wanted[i]))
        before += len(wanted[i]) * (2 if i == 4 else 1)
    assert {r.doc_id for r in token_files.read_tokens(spark, path, 5, 7).collect()} == {5, 6, 7}
    plan = token_files.read_tokens(spark, path, 5, 7).select("doc_id", "n_tokens")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,5)" in plan and "ids" not in plan.split("ReadSchema")[-1]
    file = next(f for f in os.listdir(path) if f.endswith(".parquet"))
    group = pq.ParquetFile(f"{path}/{file}").metadata.row_group(0)
    columns = {group.column(k).path_in_schema.split(".")[0]: group.column(k) for k in range(group.num_columns)}
    assert columns["doc_id"].has_offset_index and columns["doc_id"].has_column_index
    assert "DELTA_BINARY_PACKED" in columns["first"].encodings
    token_files.write_tokens(documents(spark, []), str(tmp_path / "none"))
    assert token_files.read_starts(spark, str(tmp_path / "none")).count() == 0


def test_tokens_of_a_hot_id_are_dealt_over_tasks(spark, tmp_path, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = [(7 if k % 2 else k, "the same words" if k % 4 == 1 else prose(k % 50, 20), "a") for k in range(4000)]
    path = str(tmp_path / "tokens")
    token_files.write_tokens(documents(spark, rows).repartition(8), path)
    read = token_files.read_tokens(spark, path)
    sizes = [r[1] for r in read.groupBy("part").agg(F.count(F.lit(1))).collect()]
    assert sum(sizes) == 4000 and max(sizes) < 1000
    starts = token_files.read_starts(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in starts] == sorted(i for i, _, _ in rows)
    assert [r.start for r in starts] == [0, *np.cumsum([r.n_tokens for r in starts])[:-1].tolist()]


@pytest.mark.parametrize("rows_per_task", [7, 100_000])
def test_packing_is_whole_and_tight(spark, rows_per_task):
    draw = random.Random(2)
    rows = awkward() + [(100 + k, prose(k, draw.choice([3, 50, 400, 900])), "a") for k in range(60)]
    packed = packing.pack(packing.pieces(documents(spark, rows), capacity=512), 512, rows=rows_per_task).toPandas()
    for _, own in packed.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own["length"].sum() <= 512 and own["offset"].tolist() == [0, *own["length"].cumsum()[:-1]]
    total = 0
    for i, text, _ in rows:
        ids = encoded("byte_bpe_50k.json", text, 0)
        total += len(ids)
        if i is None or i == 4:
            continue
        own = packed[packed["doc_id"] == i].sort_values("piece")
        assert own["piece"].tolist() == list(range(-(-len(ids) // 512)))
        assert own["start"].tolist() == [0, *own["length"].cumsum()[:-1]] and own["length"].sum() == len(ids)
        assert (own["length"].iloc[1:] == 512).all()
        for p in own.itertuples():
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    assert packed["length"].sum() == total
    assert packed["sequence_id"].nunique() <= -(-total // 512) * (1.05 if rows_per_task > 100 else 1.12) + 1
    assert packing.pack(packing.pieces(documents(spark, []))).count() == 0


@pytest.mark.parametrize("low, high, joined", [(270, 500, False), (2, 500, True)])
def test_packing_bounds_every_task(spark, monkeypatch, low, high, joined):
    asked, plain = [], packing.map_batches
    monkeypatch.setattr(packing, "map_batches", lambda df, run, schema: asked.append((df.count(), df.rdd.getNumPartitions())) or plain(df, run, schema))
    draw = random.Random(9)
    rows = [(k, 0, 0, draw.randint(low, high), 0) for k in range(2000)]
    items = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    packed = packing.pack(items, 512, rows=100).toPandas()
    assert sorted(packed["doc_id"]) == list(range(2000)) and packed.groupby("sequence_id")["length"].sum().max() <= 512
    assert all(count <= 100 * parts for count, parts in asked) and len(asked) < 40
    total = packed["length"].sum()
    assert packed["sequence_id"].nunique() <= total / 512 * 1.1 if joined else packed["sequence_id"].nunique() == 2000


def test_best_fit_takes_the_tightest_bin():
    own, bins = packing.best_fit(np.array([3, 7, 5, 5, 10]), 10)
    assert bins == 3 and own[4] != own[1] and own[0] == own[1] and own[2] == own[3]


def water(sizes, most=3.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {n: (5.0, 2.0, 1.0)[k % 3] for k, n in enumerate(names)}
    free, fixed, total = set(names), {}, sum(sizes.values())
    while True:
        level = (total - sum(fixed.values())) / sum(weight[n] for n in free)
        over = {n for n in free if level * weight[n] > most * sizes[n]}
        if not over:
            return {**fixed, **{n: level * weight[n] for n in free}}
        fixed.update({n: most * sizes[n] for n in over})
        free -= over


def test_mix_meets_its_targets(spark):
    draw = random.Random(3)
    rows = [(k, prose(k, draw.choice([5, 20, 60, 90])), draw.choice(["s1", "s1", "s1", "s2", "ä", "S", None])) for k in range(700)]
    rows += [(900 + k, t, s) for k, (_, t, s) in enumerate(awkward())]
    docs = documents(spark, rows)
    found, again = (sorted(map(tuple, mixing.mix(docs).select("doc_id", "size", "source", "target", "copies").collect())) for _ in range(2))
    assert found == again
    sizes, taken = {}, {}
    for (_, size, source, _, copies), (i, text, _) in zip(found, rows):
        assert size == len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) and 0 <= copies <= 3 and (copies == 0 or size)
        sizes[source], taken[source] = sizes.get(source, 0) + size, taken.get(source, 0) + size * copies
    wanted = water(sizes)
    for _, _, source, target, _ in found:
        assert target == pytest.approx(wanted[source])
    for source, target in wanted.items():
        assert taken[source] == pytest.approx(target, abs=max(100, 0.05 * target)) or source in ("b", "c")
    assert mixing.mix(documents(spark, [])).count() == 0
    whole = mixing.mix_documents(documents(spark, awkward()))
    assert whole.count() == len(awkward()) and whole.columns[:2] == ["doc_id", "text"]
    plan = mixing.mix(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_mix_of_equal_rows_is_dealt_over_tasks(spark):
    rows = [(1, prose(1, 40), "s1")] * 2000 + [(k, prose(k, 3 + k % 90), "s2" if k % 3 else None) for k in range(1500)]
    docs = documents(spark, rows).repartition(8)
    found = mixing.mix(docs, part_rows=60).select("doc_id", "source", "size", "source_size", "target", "copies").toPandas()
    assert len(found) == len(rows) and found["copies"].between(0, 3).all()
    equal = found[(found["doc_id"] == 1) & (found["source"] == "s1")]
    assert len(equal) == 2000 and equal["copies"].max() - equal["copies"].min() <= 1  # one rate, carried over
    for _, own in found.groupby("source", dropna=False):
        assert (own["copies"] * own["size"]).sum() == pytest.approx(own["target"].iloc[0], rel=0.02)
    numbered = mixing._numbered(docs.select(F.xxhash64("text").alias("__h"), F.monotonically_increasing_id().alias("__id")))
    numbers = numbered.groupBy("__h").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("__number").alias("d"), F.max("__number").alias("m"))
    assert all(r.n == r.d == r.m + 1 for r in numbers.collect())
    plain = mixing.mix(docs).select("doc_id", "source", "size", "copies").toPandas()
    for _, own in plain.groupby("source", dropna=False):
        at = found.loc[found["source"].isna() if own["source"].isna().all() else found["source"] == own["source"].iloc[0]]
        assert (own["copies"] * own["size"]).sum() == pytest.approx((at["copies"] * at["size"]).sum(), rel=0.02)


def test_tilts_match_bisection(spark):
    draw = np.random.default_rng(5)
    sizes = {"s": draw.integers(1, 400, 300), "t": draw.integers(1, 40, 200), None: np.array([7])}
    table = [(s, int(x), 1 + k % 4) for s, own in sizes.items() for k, x in enumerate(own)]
    wanted = {"s": 0.4, "t": 2.2, None: 1.7}
    total = {s: sum(x * n for o, x, n in table if o == s) for s in sizes}
    histogram = spark.createDataFrame(table, "source string, size long, n long")
    asked = spark.createDataFrame([(s, total[s], wanted[s] * total[s]) for s in sizes], "source string, source_size long, target double")
    for row in mixing.tilts(histogram, asked).collect():
        size, n = (np.array([r[k] for r in table if r[0] == row.source], dtype=float) for k in (1, 2))
        mean = (size * n).sum() / n.sum()
        mixed = lambda t: (n * size * np.minimum(3.0, np.exp(np.minimum(50.0, t * size / mean)))).sum()  # noqa: E731, B023
        low, high = -60.0, 60.0
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (low, middle) if mixed(middle) > wanted[row.source] * total[row.source] else (middle, high)
        assert row.scale == pytest.approx(mean) and row.tilt == pytest.approx(low, rel=1e-4, abs=1e-5)


def test_network_gradients():
    network, draw = Network.fresh(5, 1, 4, np.float64), np.random.default_rng(0)
    inputs, mask, truth = draw.normal(size=(3, 6, 5)), np.ones((3, 6)), np.array([1.0, 0, 1])
    mask[1, 4:] = 0
    _, grads, d_inputs = network.gradients(inputs, mask, truth)

    def slope(array, at):
        kept = array[at]
        losses = []
        for step in (1e-5, -1e-5):
            array[at] = kept + step
            losses.append(network.gradients(inputs, mask, truth)[0])
        array[at] = kept
        return (losses[0] - losses[1]) / 2e-5

    for name, grad in grads.items():
        at = tuple(draw.integers(0, s) for s in network.weights[name].shape)
        assert slope(network.weights[name], at) == pytest.approx(grad[at], abs=1e-6)
    assert slope(inputs, (0, 2, 1)) == pytest.approx(d_inputs[0, 2, 1], abs=1e-6)


def test_windows_cover_every_word():
    for size in range(0, 120):
        doc, begin = toxicity.windows(np.array([size, 5]))
        own = begin[doc == 0]
        assert {w for b in own for w in range(b, min(size, b + toxicity.WINDOW))} == set(range(size))


def test_toxicity_learns_words_and_stems(spark):
    draw, rows, labels = random.Random(4), [], []
    for k in range(500):
        words, toxic = prose(k, 150).split(), k % 4 == 0
        if toxic:
            words[draw.randrange(len(words))] = draw.choice(["idiot", "moron", "vexu" + draw.choice(["ba", "ke", "lora", "mi", "tuke"])])
        rows.append((k, " ".join(words), "a"))
        labels.append((k, 1, int(toxic)))
    docs = documents(spark, rows + [(1000, None, "a"), (1001, "", "a"), (1002, prose(7, 20_000) + " idiot", "a")])
    scorer = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    found = {r.doc_id: r.score for r in toxicity.score(docs, scorer).collect()}
    hidden = [k for k in range(500) if zlib.crc32(str(k).encode()) % 3 == 1]
    right = [(found[k] >= 0.7) == (k % 4 == 0) for k in hidden]
    assert np.mean(right) > 0.93
    assert found[1000] == found[1001] == 0 and found[1002] >= 0.7
    ids = spark.createDataFrame([(k,) for k in range(200)], "doc_id long")
    assert {r.doc_id for r in ids.filter(toxicity.held_out(F.col("doc_id"))).collect()} == {k for k in hidden if k < 200}
    none = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert none is None and {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(documents(spark, []), scorer).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_neighbours_reach_the_recall(spark):
    draw = np.random.default_rng(1)
    data = draw.normal(size=(3000, 24)).astype(np.float32) + draw.integers(0, 8, 3000)[:, None] * 0.3
    data[50:90] = data[50]  # a common vector
    rows = [(k, v.tolist(), 0) for k, v in enumerate(data)]
    rows += [(5000, None, 0), (5001, [0.0] * 24, 0), (5002, [None] * 24, 0), (5003, [float("nan")] * 24, 0), (None, [1.0] * 24, 0), (5005, [1.0], 0)]
    table = vectors(spark, rows)
    found = ann.search(table, table.filter("vec_id % 50 = 0")).toPandas()
    hits = 0
    for q in range(0, 3000, 50):
        far = np.sqrt(((data.astype(float) - data[q].astype(float)) ** 2).sum(axis=1))
        far[q] = np.inf
        best = np.lexsort((np.arange(3000), far))[:10]
        own = found[found["query_id"] == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 11)) and own["score"].is_monotonic_increasing
        assert np.allclose(own["score"], far[own["id"]], atol=1e-12)
        hits += len(set(best) & set(own["id"]))
    assert hits >= 0.9 * 600 and set(found["query_id"]) == set(range(0, 3000, 50))
    assert found[found["query_id"] == 50].sort_values("rank")["id"].tolist() == list(range(51, 61))
    few = vectors(spark, rows[:4])
    assert ann.search(few, few.filter("vec_id = 0")).count() == 3
    assert ann.search(few.limit(0), few.limit(0)).count() == 0


@pytest.mark.parametrize(("width", "rows"), [(1, 300), (4, 400), (5, 3000)])
def test_probing_finds_all_codes_within_the_radius(width, rows):
    draw = np.random.default_rng(2)
    codes, asked = (draw.integers(0, 256, (n, width), dtype=np.uint8) for n in (rows, 20))
    asked[:10] = codes[:10] ^ draw.integers(0, 2, (10, width), dtype=np.uint8)
    distance = np.unpackbits(codes[None] ^ asked[:, None], axis=2).sum(axis=2)
    tables = ann.SubstringTables(codes)
    for radius in range(8 * width + 1):
        found, met = tables.within(asked, radius, least=0)
        assert (found == (distance <= radius)).all() and (met >= found.sum(axis=1)).all()
        if radius < 2 * ((width + 1) // 2):  # up to one bit in each substring: few codes are looked at
            assert width == 1 or met.sum() < 0.1 * distance.size
    # Widened bit by bit to the first radius that holds enough.
    found, _ = tables.within(asked, 0, least=11)
    reach = np.sort(distance, axis=1)[:, 10]
    assert (found == (distance <= reach[:, None])).all()
    assert tables.within(asked, 0, least=rows + 5)[0].all()


def test_neighbours_of_several_lengths(spark):
    rows = [(k, [float(k), 1.0, 0.0][: 2 + k % 2], 0) for k in range(40)]
    table = vectors(spark, [*rows, *rows[:3]])
    found = ann.search(table, table.filter("vec_id in (10, 11)"), k=3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.id, r.score) for r in found] == [
        (10, 1, 8, 2.0), (10, 2, 12, 2.0), (10, 3, 6, 4.0), (11, 1, 9, 2.0), (11, 2, 13, 2.0), (11, 3, 7, 4.0)
    ]


def test_snapshots_collapse(spark):
    def conv(i, *texts, roles=("user", "assistant")):
        return [(i, n, roles[n % 2], t, "x") for n, t in enumerate(texts)]

    rows = conv(1, "a", "b") + conv(2, "a", "b", "c") + conv(3, "a", "b", "c") + conv(4, "a", "x") + conv(5, "b", "a")
    rows += conv(6, None) + conv(7, "", "t") + [(None, 0, "user", "lost", "x"), (8, None, None, "z", "x"), (8, None, None, "z", "x")]
    rows += conv(9, "ab", roles=("user", "user")) + conv(10, "a", "b", "d", roles=("system", "assistant"))
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place string")
    found = {r.conv_id: r for r in chat.render(table).collect()}
    assert sorted(found) == [2, 4, 5, 7, 8, 9, 10]
    assert found[4].rendered == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n"
    assert found[8].n_turns == 2 and found[8].rendered.startswith("<|im_start|>none\nz")
    assert chat.render(table.limit(0)).count() == 0
    plan = chat.render(table)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_equal_turns_go_by_their_texts(spark):
    draw, rows = random.Random(6), []
    for k in range(0, 40, 2):
        texts = sorted("".join(draw.choice("abcdef") for _ in range(4)) for _ in range(3))
        turn = None if k % 4 else 1
        rows += [(k, turn, "user", texts[0]), *[(k + 1, turn, "user", t) for t in reversed(texts)]]  # a true prefix
        rows += [(100 + k, turn, "user", texts[2]), (100 + k, turn, "user", texts[2] + "z")]  # opens no other conversation
        rows += [(101 + k, turn, "user", texts[2] + "z")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = [r.conv_id for r in chat.render(table).collect()]
    assert sorted(found) == [*range(1, 40, 2), *range(100, 140)]


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, SMALL).toPandas()
        if name == "best_fit_packing":
            assert {"doc_id", "sequence_id", "offset"} <= set(rows.columns) and rows["doc_id"].nunique() == docs.select("doc_id").distinct().count()
            continue
        assert list(rows.columns) == columns
        if name != "source_mix":
            assert rows["doc_id"].is_unique and len(rows) <= before
        docs, before = spark.createDataFrame(pa.Table.from_pandas(rows, preserve_index=False)), len(rows)
    assert [n for n, _ in corpus_pipeline.STAGES][:1] == ["quality_rules"]


def test_pipeline_of_awkward_documents(spark):
    import corpus_pipeline

    good = [(k, prose(k, 120), f"s{k % 2}") for k in range(20, 40)]
    docs = documents(spark, awkward() + good).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).collect(), stage(spark, docs, SMALL).schema)
    assert set(range(20, 40)) & {r.doc_id for r in docs.collect()}
    empty = documents(spark, []).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SMALL)
    assert empty.count() == 0


def test_stages_leave_other_columns_alone(spark):
    import corpus_pipeline

    good = [(k, "\n".join([prose(k, 60), f"line number {k} that is all alone", prose(k + 500, 60)]), f"s{k % 2}") for k in range(60)]
    names = ["kept", "measures", "failed", "base_failed", "n_lines", "n_dropped", "whole", "id", "h", "row", "copies", "turn", "fp",
             "class", "component_id", "size", "target", "__h", "__i", "__n", "__row", "__copy"]
    docs = documents(spark, good).select("doc_id", "text", "lang", "source", "n_chars").withColumns({n: F.concat(F.lit(n), F.col("doc_id")) for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, SMALL)
        assert found.columns == docs.columns, name
        rows = found.collect()
        assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names), name
        docs = spark.createDataFrame(rows, docs.schema)


def test_one_row_of_a_labelled_id_reaches_the_driver(spark, monkeypatch):
    rows = [(1, f"{prose(1, 30)} {n}", "a") for n in range(1000)] + [(k, prose(k, 30), "a") for k in range(2, 40)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 40)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, truth: seen.append((texts, truth)))
    toxicity.fit(documents(spark, rows), labels)
    ((texts, truth),) = seen
    assert len(texts) == len(truth) <= 39 and len(set(texts)) == len(texts)


@pytest.mark.parametrize("name", ["op7_quality", "op9_chat", "op11_negatives", "op13_contamination"])
def test_queries_match_their_sql(spark, name):
    from oracle_check import compare, connect

    from storelake.llm.registry import ORACLES, QUERIES

    problem, rows, _ = compare(spark, connect(SMALL), SMALL, name, QUERIES[name], ORACLES[name])
    assert problem is None and rows > 0


@pytest.mark.parametrize("name", ["op1_lines", "op2_tokens", "op3_mixing", "op4_toxicity", "op5_licenses", "op6_ann", "op8_packing", "op10_simhash", "op12_runs"])
def test_queries_return_whole_tables(spark, name):
    from storelake.llm.registry import QUERIES

    rows = QUERIES[name](spark, SMALL).toPandas()
    wanted = {"op6_ann": 50, "op5_licenses": None, "op8_packing": None}.get(name, 200)
    assert len(rows) == wanted if wanted else len(rows) > 0
    if name == "op8_packing":
        assert rows["doc_id"].nunique() == 200
