"""The corpus pipeline: five stages over ``documents``.

A stage is ``(name, function)``; the function takes ``(spark, docs, sf_dir)``
and works on all rows its predecessor kept. Its result is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of
``documents``.

1. toxicity: rows that the model rejects go.
2. simhash: one row of each near-duplicate group stays.
3. secrets: secrets in the texts are replaced by a mark.
4. mix: rows are repeated or left out so that sources meet their target weights.
5. bpe: every row's token ids, with their digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import bpe, mixing, secrets, simhash, toxicity
from strata.llm.common import materialized, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, length="n_chars" if "n_chars" in docs.columns else None)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.bpe(docs, keep_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mix", mix_sources),
    ("bpe", encode),
]

#: Trained scores, hashes and byte-level BPE are beyond SQL: the stages are
#: tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
