"""From raw documents to token ids, in five stages; each is written and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from episodica.llm import byte_bpe, minhash_tensor, qgram_decontam, quality_gam, secret_ledger
from episodica.llm.common import shared_folder, stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches 0.7; the model learns from the labelled ones among them.

    Without labels every score is 0.5, so nothing is kept; no rows give no rows.
    """
    return quality_gam.keep_good(docs, quality_gam.train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of every group of near duplicates, on shingles of five words.

    Stages on word shingles take five words at a similarity of 0.8; the query of the operator takes four, as its contract
    says. Rows without a word are linked with nothing; no rows give no rows.
    """
    return minhash_tensor.keep_one(docs, width=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; all of them if the benchmark is empty."""
    return qgram_decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mask for each secret; a null text stays null, repeated rows are masked each."""
    ledger = shared_folder(spark, "ledger")
    secret_ledger.scan(docs, ledger)
    return secret_ledger.masked(docs, ledger)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens of all documents; a null text has no tokens."""
    return byte_bpe.encoded(docs, public_tokenizers.path(byte_bpe.VOCABULARY))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mask_secrets", mask_secrets),
    ("tokenize", tokenize),
]

# SQL has no word for fitting the classifier or for the tokenizer; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
