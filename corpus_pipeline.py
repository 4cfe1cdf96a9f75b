"""Corpus pipeline: language ID, near-duplicates, benchmark decontamination, secret scans, packing.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor
kept and returns the columns of documents; the last returns the packed pieces.
Between stages the documents are written and read again.

Cases, all stages: an empty table gives no rows; very long texts are read whole;
columns beyond those of documents are kept but for the last stage; the stages'
docstrings say what becomes of null, empty and repeated rows and of ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stride.llm import bagminhash, decontamination, language_id, packing, secret_scan
from stride.llm.common import cut, held_out, table
from stride.llm.queries import tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents of an identified language; the model learns from the training rows of the given documents.

    Null texts and texts without letters have no language and go; a null id stays
    (it is never learned from); repeated rows share their fate; of equally likely
    languages the alphabetically first is taken, which decides nothing here.
    """
    model = language_id.train(docs.where(~held_out("doc_id", 4, 2)))
    return language_id.keep_identified(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays.

    The smallest id stays, null ids last, then the smaller hash of the text; of
    repeated rows one stays; texts without words are copies of one another.
    """
    return bagminhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go.

    Null and empty texts and null ids stay; repeated rows share their fate.
    """
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reported secrets are replaced by a mark; every document stays, n_chars follows its text.

    Null texts stay null; spans that overlap become one mark; repeated rows and
    null ids are redacted alike.
    """
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in clean.columns else clean


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their sequence and place; null texts are empty, repeated rows pieces of their own."""
    return packing.pack(docs, tokenizer_path(), remember=False)  # other stages' workers need the memory


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # naive Bayes, signatures and packing have no SQL form; tests/llm/test_pipeline.py compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
