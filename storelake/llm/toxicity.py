"""Toxicity scores of whole texts: a small recurrent network over words and their letters, on overlapping windows."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.llm.gru import Adam, Network, sigmoid
from storelake.llm.text import segment_sums, words_of
from storelake.llm.workers import Batches, map_batches

WINDOW, STRIDE = 32, 16
WORDS, GRAMS, WIDTH = 1 << 14, 1 << 13, 8  # hashed words and letter trigrams, and the length of their vectors
MAX_TOXIC, MAX_CLEAN = 1200, 2400  # labelled documents learnt from, those of the smallest hashes
ROUNDS, EPOCHS, BATCH, RATE = 4, 3, 256, 0.01
THRESHOLD = 0.7
SLICE = 512  # documents scored at a time
AT_ONCE = 8192  # windows run through the network at a time
PUNCTUATION = ".,;:!?\"'()[]{}*#$%&<>|-_"


def word_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For distinct words: their hashed number, all their hashed letter trigrams, and where each word's trigrams begin.

    Words are taken in lower case without punctuation at the ends; trigrams run over the bytes between two end marks.
    """
    plain = pc.utf8_trim(pc.utf8_lower(words.cast(pa.large_string())), characters=PUNCTUATION)
    sizes = pc.binary_length(plain).to_numpy().astype(np.int64)
    data = np.frombuffer(b"".join(plain.cast(pa.large_binary()).to_pylist()), dtype=np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    marked = np.full(len(data) + 2 * len(sizes), ord("$"), dtype=np.uint32)
    first = starts[:-1] + 2 * np.arange(len(sizes))
    marked[first] = ord("^")
    word_of = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(data)) - starts[word_of]
    at = first[word_of] + 1 + place
    marked[at] = data
    trigrams = marked[at - 1] * np.uint32(0x9E3779B1) ^ marked[at] * np.uint32(0x85EBCA77) ^ marked[at + 1] * np.uint32(0xC2B2AE3D)
    powers = (np.uint64(31) ** (np.arange(place.max() + 1 if len(place) else 0) % 64).astype(np.uint64)) | np.uint64(1)
    number = segment_sums((data.astype(np.uint64) + np.uint64(7)) * powers[place], starts) * np.uint64(0x9E3779B97F4A7C15)
    return (number >> np.uint64(50)).astype(np.int64) % WORDS, ((trigrams * np.uint32(2654435761)) >> np.uint32(19)).astype(np.int64) % GRAMS, starts


class Scorer:
    """The network with its vectors of words and trigrams."""

    def __init__(self, seed: int = 0):
        draw = np.random.default_rng(seed)
        self.network = Network.fresh(2 * WIDTH, seed)
        self.words = (0.1 * draw.normal(size=(WORDS, WIDTH))).astype(np.float32)
        self.grams = (0.1 * draw.normal(size=(GRAMS, WIDTH))).astype(np.float32)

    def vectors(self, features: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """Input of each distinct word: its own vector, and the sum of its trigrams' by the root of their number."""
        number, trigrams, starts = features
        spelt = segment_sums(self.grams[trigrams], starts) / np.sqrt(np.maximum(1, np.diff(starts)))[:, None].astype(np.float32)
        return np.hstack([self.words[number], spelt.astype(np.float32)])

    def logits(self, index: np.ndarray, vectors: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits of all windows, the document of each and the place of its first word."""
        doc, begin = windows(np.diff(starts))
        pf, pb = self.network.projected(vectors)
        out = np.empty(len(doc), dtype=np.float32)
        padded = np.concatenate([index, np.zeros(WINDOW, dtype=index.dtype)])
        for at in range(0, len(doc), AT_ONCE):
            d, b = doc[at : at + AT_ONCE], begin[at : at + AT_ONCE]
            first = starts[d] + b
            mask = (b[:, None] + np.arange(WINDOW) < np.diff(starts)[d][:, None]).astype(np.float32)
            out[at : at + AT_ONCE] = self.network.forward(
                lambda t, first=first: pf[padded[first + t]], lambda t, first=first: pb[padded[first + t]], mask
            )
        return out, doc, begin

    def scores(self, texts: pa.Array) -> np.ndarray:
        """The largest chance among the windows of each text; 0 for texts without words."""
        index, distinct, starts = words_of(texts)
        best = np.full(len(texts), -np.inf)
        if len(index):
            logits, doc, _ = self.logits(index, self.vectors(word_features(distinct)), starts)
            np.maximum.at(best, doc, logits)
        return np.where(np.isfinite(best), sigmoid(best), 0.0)


def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and first word of all overlapping windows; the last one reaches the end."""
    count = np.where(sizes > 0, np.maximum(1, -(-(sizes - WINDOW) // STRIDE) + 1), 0)
    doc = np.repeat(np.arange(len(sizes)), count)
    return doc, (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * STRIDE


def _odds(index: np.ndarray, starts: np.ndarray, features, toxic: np.ndarray) -> np.ndarray:
    """A first guess for each distinct word: log odds of its trigrams and itself among the documents of either label."""
    number, trigrams, gram_starts = features
    doc = np.repeat(np.arange(len(toxic)), np.diff(starts))
    seen = np.unique(np.stack([doc, index], axis=1), axis=0)
    sides = []
    for side in (toxic > 0, toxic == 0):
        own = np.bincount(seen[side[seen[:, 0]], 1], minlength=len(number)).astype(float)
        word = np.bincount(number, weights=own, minlength=WORDS)
        gram = np.bincount(trigrams, weights=np.repeat(own, np.diff(gram_starts)), minlength=GRAMS)
        sides.append((np.log((word + 0.5) / side.sum())[number], np.log((gram + 5) / (gram.sum() + 5 * GRAMS))[trigrams]))
    words, grams = sides[0][0] - sides[1][0], sides[0][1] - sides[1][1]
    return np.maximum(words, 0) * 0.5 + segment_sums(grams, gram_starts) / np.maximum(1, np.diff(gram_starts))


def train(texts: list[str], toxic: np.ndarray, seed: int = 0) -> Scorer:
    """Learn from whole labelled texts: a text is toxic if one of its windows is.

    In every round the windows that look most toxic are chosen from each text: one or two of a toxic one, three and a few at random
    of a clean one. The first round chooses by log odds, the others by the network itself.
    """
    draw = np.random.default_rng(seed)
    scorer, adam = Scorer(seed), Adam(RATE)
    index, distinct, starts = words_of(pa.array(texts, type=pa.large_string()))
    features = word_features(distinct)
    number, trigrams, gram_starts = features
    doc, begin = windows(np.diff(starts))
    first = starts[doc] + begin
    guess = np.concatenate([[0], np.cumsum(np.maximum(_odds(index, starts, features, toxic), 0)[index] ** 2)])
    rank = guess[np.minimum(first + WINDOW, starts[doc + 1])] - guess[first]
    weights = {**scorer.network.weights, "words": scorer.words, "grams": scorer.grams}
    for number_of_round in range(ROUNDS):
        order = np.lexsort((-rank, doc))
        place = np.arange(len(doc)) - np.searchsorted(doc[order], doc[order])
        hot = toxic[doc[order]] > 0
        near = np.where(hot, place < 1, place < 3) | (~hot & (draw.random(len(doc)) < 2 / (1 + np.diff(starts)[doc[order]] / STRIDE)))
        chosen = order[near]
        for _ in range(EPOCHS):
            draw.shuffle(chosen)
            for at in range(0, len(chosen), BATCH):
                own = chosen[at : at + BATCH]
                span = first[own][:, None] + np.arange(WINDOW)
                mask = (span < starts[doc[own] + 1][:, None]).astype(np.float32)
                used, where = np.unique(index[np.minimum(span, len(index) - 1)], return_inverse=True)
                where = where.reshape(span.shape)
                sizes = np.diff(gram_starts)[used]
                edges = np.concatenate([[0], np.cumsum(sizes)])
                flat = trigrams[np.repeat(gram_starts[used] - edges[:-1], sizes) + np.arange(edges[-1])]
                vectors = scorer.vectors((number[used], flat, edges))
                known = (draw.random(len(used)) > 0.4).astype(np.float32)  # words hidden at times, so that letters count
                vectors[:, :WIDTH] *= known[:, None]
                _, grads, d_inputs = scorer.network.gradients(vectors[where], mask, (toxic[doc[own]] > 0).astype(np.float32))
                by_word = np.stack([np.bincount(where.ravel(), weights=d_inputs[:, :, k].ravel(), minlength=len(used)) for k in range(2 * WIDTH)], axis=1)
                by_gram = np.repeat(by_word[:, WIDTH:] / np.sqrt(np.maximum(1, sizes))[:, None], sizes, axis=0)
                grads["words"] = np.stack([np.bincount(number[used], weights=by_word[:, k] * known, minlength=WORDS) for k in range(WIDTH)], axis=1)
                grads["grams"] = np.stack([np.bincount(flat, weights=by_gram[:, k], minlength=GRAMS) for k in range(WIDTH)], axis=1)
                adam.update(weights, grads)
                scorer.words, scorer.grams = weights["words"], weights["grams"]
                scorer.network.weights = {k: v for k, v in weights.items() if k not in ("words", "grams")}
        rank = scorer.logits(index, scorer.vectors(features), starts)[0]
    return scorer


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: those whose checksum of the id as text is 1 modulo 3 (null: the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, most_toxic: int = MAX_TOXIC, most_clean: int = MAX_CLEAN) -> Scorer | None:
    """A scorer learnt on the driver from a bounded sample: at most ``most_toxic`` and ``most_clean`` labelled documents.

    Ids with several labels count as toxic if one of them says so; null labels say nothing. Of rows that repeat an id the text with
    the smallest hash is learnt from. None if either kind is missing.
    """
    told = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    learnt = told.filter(~held_out(F.col("doc_id")))
    order = F.xxhash64("doc_id"), "doc_id"
    toxic = learnt.filter("toxic > 0").orderBy(*order).limit(most_toxic)
    clean = learnt.filter("toxic <= 0").orderBy(*order).limit(most_clean)
    chosen = docs.select("doc_id", "text").join(toxic.union(clean), "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text", "toxic")).alias("one")  # of rows that repeat an id
    rows = chosen.groupBy("doc_id").agg(one).select("doc_id", "one.text", "one.toxic").toPandas()
    rows = rows[rows["text"].fillna("").str.strip() != ""].sort_values(["doc_id", "text"])
    truth = (rows["toxic"] > 0).to_numpy().astype(int)
    return train(rows["text"].tolist(), truth) if 0 < truth.sum() < len(truth) else None


def score(docs: DataFrame, scorer: Scorer | None) -> DataFrame:
    """All rows of ``doc_id`` and ``text`` as doc_id and ``score`` (0 to 1): the largest over all windows of the whole text.

    Null and empty texts score 0, and so does everything without a scorer. Repeated rows are scored each.
    """

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                found = scorer.scores(batch.column("text")) if scorer else np.zeros(batch.num_rows)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.astype(np.float64))], names=["doc_id", "score"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, score double")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score and a verdict for each document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scorer = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, scorer).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
