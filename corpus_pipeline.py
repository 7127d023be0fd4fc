"""Quality rules, line deduplication, near-duplicate removal, mixing and packing, one after the other."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.llm import line_dedup, mixing, packing, quality, simhash
from storelake.session import scratch_path
from storelake.sinks.files import delete_folder


def packed(docs: DataFrame, *needed: str) -> DataFrame:
    """The columns an operator needs, and whole rows as a struct: no name of the operator's own meets one of theirs."""
    whole = F.struct(*[F.col(c).alias(f"c{n}") for n, c in enumerate(docs.columns)])
    return docs.select(whole.alias("whole"), *needed)


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col(f"whole.c{n}").alias(c) for n, c in enumerate(columns)])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule, unchanged."""
    return unpacked(quality.judge(packed(docs, "text")).filter("kept"), docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with one occurrence of each group of alike lines, other columns unchanged; ``n_chars`` follows the text."""
    cut = line_dedup.dedup_lines(docs, counts=())
    return cut.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else cut


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest doc_id (null last)."""
    return unpacked(simhash.one_of_each(packed(docs, "doc_id", "text")), docs.columns)


def take_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many rows of each document as the mix takes of it."""
    mixed = mixing.mix_documents(packed(docs, "text", "source"))
    repeated = mixed.filter("copies > 0").select("whole", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return unpacked(repeated, docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows (null text: the end id alone) with their sequences and offsets."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mix", take_copies),
    ("best_fit_packing", pack_sequences),
]

# Fuzzy lines, fingerprints, the mix and packing are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents, each written and read again for the next, after which its input is deleted."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
