"""From raw documents to token ids: five stages, each written as Parquet before the next reads it.

In all of them a null text is an empty one, columns beside doc_id, text and lang are carried
along whatever their names, and an empty table gives an empty one. Filters judge each row by
what it holds: rows that share a doc_id, or have none, go or stay on their own. Only near
duplicates go by ids: see there.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramledger.llm import decontaminate, minhash, piece_bpe, quality, toxicity
from gramledger.llm.queries import PIECES, table
from gramledger.llm.text import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go; the model is learnt from the labelled ones among docs.

    Repeated rows have one score and go or stay together. Without labelled rows none goes.
    """
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that fail the base rules, as empty ones do, or are too far from their language.

    Texts of a null or unknown lang are judged by the base rules alone.
    """
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates stays.

    Rows that share an id are one document, of which one row stays. Rows without an id, and
    texts without words, are linked with nothing and stay.
    """
    return minhash.drop_near_duplicates(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of whose words a twentieth or more are benchmark passages. Those without words stay."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256, decoded_sha256 of what is left: a row for every row. An empty text has the end id alone."""
    rows = piece_bpe.encode(docs, public_tokenizers.path(PIECES))
    return rows.select("doc_id", "n_tokens", "ids", F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", remove_contaminated),
    ("sentencepiece", encode),
]

# Stages that learn a model or merge pieces are not SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
