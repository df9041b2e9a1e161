"""A training corpus from documents: quality rules, near copies, repeated passages, benchmark passages, packing.

Every stage takes the session, the documents its predecessor kept and the folder of the tables. All but the last return the
columns of documents; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.llm import decontam, jaccard, packing, quality, substring
from marquee.llm.storage import stored


def tokenizer() -> str:
    """The vocabulary of the last stage. Its package is needed when the stage runs, not before."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects. Texts that are NULL or empty have too few words and go; equal rows are judged alike."""
    return quality.filter_quality(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id; documents without words are no copies."""
    return jaccard.first_of_groups(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur more than once; text and n_chars are what is left of them.

    Documents in which nothing repeats stay as they are, also with a NULL or empty text. Equal rows repeat each other.
    """
    cut = substring.remove_repeats(docs)
    changed = F.col("row").withField("text", F.col("kept")).withField("n_chars", F.length("kept").cast("bigint"))
    return cut.select(F.when(F.col("n_removed") > 0, changed).otherwise(F.col("row")).alias("row")).select("row.*")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items. Texts that are NULL or empty are not; an empty benchmark keeps everything."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences. A NULL or empty text is the closing id alone; equal rows are packed each; no documents, no pieces."""
    packed = packing.pack(docs, tokenizer())
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return packed.select(F.col("row.doc_id").alias("doc_id"), *names)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", ngram_jaccard),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", pack_sequences),
]

#: Stages two to five cannot be said in SQL; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
