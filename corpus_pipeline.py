"""From documents to sampled pieces, in five stages.

Each stage takes (spark, docs, sf_dir), docs being what its predecessor kept, and returns
a DataFrame; all but the last return the columns of documents. run() writes each result as
Parquet below the shared folder and reads it again as the next one's docs.

Every stage passes on other columns whatever their names, gives an empty table for an empty
one, reads texts whole however long they are, and treats rows with a null doc_id like others.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import decontaminate, near_dedup, piece_sampling, quality_rules, secret_scan
from corpusmill.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go. A null or empty text has no words and goes; repeated rows share their verdict."""
    return quality_rules.keep_good(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near copies stays; of repeated rows one, that with the smallest text. Rows with a null doc_id, and texts without words, stay."""
    return near_dedup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, repeated rows all alike. A null or empty text holds none."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; n_chars counts what is left where a text changed. A null or empty text stays as it is."""
    return secret_scan.redacted(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts, as decoded from their sampled pieces, and the pieces; what is drawn depends on doc_id and text alone, so repeated rows draw alike."""
    return piece_sampling.with_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), seed=0)


STAGES = [("quality", quality), ("near_dedup", dedup), ("decontamination", decontamination), ("secrets", secrets), ("pieces", pieces)]

#: A sampled segmentation can't be written in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
