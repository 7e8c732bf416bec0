"""A training corpus from ``documents``: five stages, each on all that the one before kept.

1. toxicity: documents whose score reaches the threshold go; the classifier is trained
   on the labelled documents of the input that are not held out.
2. line dedup: repeated and nearly repeated lines go, one of each component stays;
   documents of which nothing is left go.
3. near duplicates: one document of each group of linked fingerprints stays.
4. decontamination: documents that hold a passage of the benchmark go.
5. mixing: sources are brought to their target weights; a repetition is a row, so the
   result has the columns of ``documents`` and the number of the repetition.

Defined results for null, empty and repeated rows are those of the operators; an empty
table gives an empty corpus; further columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandgrid.llm import decontamination, line_dedup, mixing, simhash, toxicity
from demandgrid.llm.base import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels.where(toxicity.training_rows(labels))))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_of_each(docs)


def drop_leaking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_leaking),
    ("mixing", mix_sources),
]

#: The first stage is a trained classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"corpus-{name.replace(' ', '-')}")
    return docs
