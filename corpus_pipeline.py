"""The corpus pipeline: quality rules, near-duplicates, personal data, source mixing, encoding.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir) and returns what it keeps
with the columns of ``documents``; its rows are written and read again as the next stage's input.
The last stage returns the encoded documents. Every stage accepts NULLs in any column, empty and
very long texts, repeated rows, empty tables and further columns, which it passes on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dayframe.llm import common, mixing, neardup, pieces, pii, quality, queries


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep(docs, queries.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest doc_id, and
    one of equal rows. Texts without words are in no group and stay."""
    return neardup.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kind, disclosing terms generalised or removed; n_chars
    follows the text. All documents stay."""
    return pii.clean(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (whole copies, rounded): documents that it does
    not take go, repeated ones come two or three times. Texts without words go."""
    return mixing.repeated(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' SentencePiece ids: doc_id, ids, n_tokens, ids_crc32, parity, round_trip."""
    return pieces.encode(docs, queries.tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("personal data", personal_data),
    ("source mixing", source_mixing),
    ("encoding", encoding),
]

# The mix's and the near-duplicates' methods and the encoding are beyond SQL; the stages are
# tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = common.stored(docs, f"pipeline-{i}")
    return docs
