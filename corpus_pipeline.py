"""A training corpus from ``documents``: quality, near duplicates, repeated passages, benchmark
passages, tokens.  Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; its
result is written as Parquet and read again as the next one's documents.

Defined results of every stage: an empty table gives an empty one; texts of any length are handled whole; only the
columns of documents are read, so other columns may have any names, and only they are returned.

- quality: a document without text (null or empty) goes; rows repeated whole, and rows that tie on an id, are judged each.
- near-duplicates: of rows that are repeated whole, or are near each other, the one of the smallest id stays; a row without
  an id stays unless one with an id has its fingerprint; documents that reach it without text are near each other.
- repeats: a null text becomes empty; copies that are left, under whatever ids, lose all that they share.
- benchmark: a null text stays null, an empty benchmark takes nothing.
- tokens: a null text is encoded as an empty one; a row each for repeated rows and tied or null ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import common, decontaminate, quality, sentencepiece_bpe, simhash, suffix_dedup
from orderlens.llm.queries import tokenizer_path

#: Bytes of a repeated passage.  Of the runs of 51 words or more that two texts share among 19,035 different texts of a
#: given table, 1 in 100 has under 170 bytes, 1 in 20 under 269 and 1 in 3 under 400.
REPEAT_BYTES = 200

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with_text(df: DataFrame, text: str) -> DataFrame:
    """The columns of documents with a new text."""
    return df.select("doc_id", F.col(text).alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    judged = quality.classify(docs, common.table(spark, sf_dir, "labels"), keep=COLUMNS)
    return judged.filter("kept").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.deduplicate(docs.select(*COLUMNS), shingle=3, radius=3, seed=42)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings of ``REPEAT_BYTES`` that repeat: passages of 50 words, and longer ones."""
    return _with_text(suffix_dedup.remove_repeats(docs, keep=("doc_id", "lang", "source"), size=REPEAT_BYTES, kept_text=True), "kept")


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages."""
    found = decontaminate.decontaminate(docs, common.table(spark, sf_dir, "benchmark"), keep=("doc_id", "lang", "source"), cleaned=True)
    return _with_text(found, "clean_text")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and what they decode to as a digest."""
    return (sentencepiece_bpe.encode_documents(docs, tokenizer_path(), tokens=True)
            .select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("quality", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("benchmark", cut_benchmark),
    ("tokens", tokenize),
]

#: SQL can express neither the model's training nor the token merges; tests/llm compares the stages
#: with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:  # what was made of it is written
            common.discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
