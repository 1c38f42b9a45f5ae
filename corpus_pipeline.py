"""From raw documents to a mixed and sharded training set.

Each stage takes the documents that its predecessor kept and returns documents; the last adds shard and slot.

All stages share these rules: an empty table gives an empty one with the same columns; a null text is an empty text;
a row without a key stays and is told apart from no other; texts of any length are read whole; columns that no stage
knows are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabweave.llm import decontaminate, mixing, quality, sharding, simhash
from tabweave.llm.queries import CURRICULUM, GOOD, SHARDS, held_out
from tabweave.session import materialize
from tabweave.sources.tables import table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject, learnt from the labels that are not held out.

    Every row is scored by its text alone, so repeated rows and null keys are kept or go like any other; empty and
    null texts have a score too. Without any labelled document all scores are a half, and all documents stay.
    """
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    return quality.keep_quality(docs, model, GOOD)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the least key.

    Documents without words, null texts among them, are one group. Rows that share a key are one document, of which
    one row stays; rows without a key stay all. Ties cannot occur, as keys order the documents of a group.
    """
    return simhash.keep_one(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Each row is judged by its own text: repeated rows and null keys go or stay like any other; a text without words
    holds nothing, and a benchmark without items removes nothing.
    """
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, each as often as its source's target asks for.

    Rows without a source are a source of their own, the last. A document without words is never taken, as it has no
    share of any target; repeated rows are documents each. Ties in time are ordered by pass. Columns of the
    documents that are named like those of the mix (``size``, ``taken`` and so on) are left out.
    """
    return mixing.training_order(mixing.mix_sources(docs, CURRICULUM))


def sharded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix with each row's shard and its slot there.

    The key decides, so copies of a document share a shard and get slots each; rows without a key share one. Columns
    named ``shard`` and ``slot`` are replaced.
    """
    return sharding.shard_documents(docs, sharding.balanced_tree(SHARDS))


STAGES = [
    ("quality", good_documents),
    ("near_dedup", distinct_documents),
    ("decontaminate", clean_documents),
    ("mix", mixed_documents),
    ("shard", sharded_documents),
]

# Fingerprints and models are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
