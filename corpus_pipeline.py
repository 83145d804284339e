"""The corpus pipeline: toxicity, host quality rules, near duplicates, pseudonyms, packing.

Every stage works on all documents that its predecessor kept, and all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsheet.llm import host_rules, ngram_join, packing, pii, toxicity
from callsheet.llm.common import Scratch, read_table
from callsheet.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not reject."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.with_severity(docs.select(*COLUMNS), model).where(~F.col("toxic")).select(*COLUMNS)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules, of hosts that are not rejected."""
    return host_rules.kept_documents(docs.select(*COLUMNS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts: the one with the smallest id."""
    return ngram_join.first_of_each(docs.select(*COLUMNS))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data."""
    out = pii.pseudonymised(docs.select(*COLUMNS), pii.application_key(spark)).select(*COLUMNS)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces and their places in training sequences."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("host_rules", drop_low_quality), ("ngram_join", drop_near_copies),
          ("pii", hide_personal_data), ("packing", pack)]

# a fitted model, hashing with a key and a tokenizer are beyond SQL: test_pipeline_stages_keep_what_they_should
# compares each stage's ids and texts with brute force on planted documents
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
