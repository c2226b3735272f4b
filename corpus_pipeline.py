"""From raw documents to token records: quality, near duplicates, decontamination, mixing, token output.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. All but the last return the columns of ``documents``; rows of ``docs`` that a stage
keeps are unchanged, and the mix repeats a row as often as it was drawn.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marlstone.llm import decontaminate, jaccard, mixing, quality_rules, token_records
from marlstone.llm.common import staged, table
from marlstone.llm.queries import TOKENIZER


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy's rules pass."""
    policy = quality_rules.POLICIES[quality_rules.CURRENT_POLICY]
    return quality_rules.evaluate_rules(docs, keep=None).where(quality_rules.passes(policy)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: that with the smallest id."""
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any 10-word passage of the benchmark."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that the sources come near their target weights."""
    return mixing.emitted(mixing.mix_sources(docs))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's token ids stand in the files written, read back from those."""
    return token_records.round_trip(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
    ("token_output", token_output),
]

#: Tokenizing has no SQL; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
