"""Corpus pipeline from raw documents to token ids.

STAGES holds (name, function).  A function takes (spark, docs, sf_dir) and
returns what the next stage reads; each result is written as Parquet and read
again.  Every stage works on all that the one before kept:

1. quality classifier: documents that it rejects go;
2. SimHash near-dedup: of each group the document with the smallest id stays;
3. secret scans: secrets are replaced by their kind, n_chars follows the text;
4. mixing: documents are repeated or left out so that sources meet their
   targets, in training order;
5. BPE: doc_id, lang, source, n_chars, position, ids and n_tokens.  ``position``
   ascends in training order: the stage before returns the columns of documents
   alone, so it is the place where a row was read, by file number and row.

Columns beside those of ``documents`` pass through stages 1 to 4.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm import bpe, classifier, mixing, secrets, simhash
from patronage.llm.common import documents
from patronage.session import materialize
from patronage.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return classifier.accepted(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.first_of_each(docs, shingle=3, radius=2)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.training_order(docs)


def with_position(docs: DataFrame) -> DataFrame:
    """``docs`` with ``position``, which ascends in the order they were written in:
    files are numbered by partition, and rows by their place in a file.  Rows that
    come from no file are numbered as they are."""
    try:
        number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).try_cast("long")
        return docs.select("*", (F.coalesce(number, F.lit(0)) * F.lit(1 << 33) + F.col("_metadata.row_index")).alias("position"))
    except AnalysisException:  # no file behind it
        return docs.withColumn("position", F.monotonically_increasing_id())


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    lexicon = bpe.build_lexicon(docs, tokenizer)
    return bpe.encode(with_position(docs.drop("position")), tokenizer, lexicon,
                      keep=("doc_id", "lang", "source", "n_chars", "position")).withColumn(
        "n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("secrets", redact_secrets),
    ("mix", mix),
    ("encode", encode),
]

# SQL can't express the trained stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
