"""A training corpus in four stages, each one of the operators of `tidemill.llm`.

Each stage takes what the one before it has kept, as a table that was written and read again. The first three return
the columns of `documents`, the last one the packed pieces.
"""

from __future__ import annotations

import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemill.llm import minhash, packing, secret_scan, toxicity  # noqa: E402
from tidemill.llm.common import kept_table  # noqa: E402
from tidemill.plans.inputs import table  # noqa: E402

#: Learnt weights, signatures, randomness tests and tokenizer ids are beyond SQL; the tests hold each stage against a
#: brute-force version.
ORACLE_SQL = None


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose toxicity score reaches the threshold of their language."""
    return toxicity.clean_documents(docs, docs, table(spark, sf_dir, "labels"))


def duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of least id, of each group that links of 0.8 or more on five-word shingles connect."""
    return minhash.keep_one(docs)


def secrets_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in the place of each secret."""
    return secret_scan.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 4096 ids."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", toxic_out), ("near_duplicates", duplicates_out), ("secrets", secrets_out), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; between them a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
