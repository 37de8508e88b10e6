"""The training-data pipeline: toxicity, quality, exact and near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and reads all that its predecessor kept.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from datasheaf.llm import exact_dedup, packing, quality_rules, simhash_dedup, toxicity
from datasheaf.llm._common import staging_root, vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't toxic, by the ``labels`` beside them.

    Null and empty texts stay, null ids are judged but not learned from,
    repeated rows are judged alike; without toxic labels or rows nothing goes.
    Columns of any name are kept.
    """
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are more likely good than not.

    Null, empty and very short texts go, as they fail the base; null ids and
    repeated rows are judged like any other; no rows give no rows.
    """
    return quality_rules.good_documents(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, white space normalised: the smallest id, null ids last.

    Null texts are empty texts; of repeated rows one stays; no rows give no rows.
    """
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that Jaccard similarities of 0.8 or more of 5-word shingles join: the smallest id, null ids last.

    Texts without words are copies of each other; of repeated rows one stays; no
    rows give no rows.
    """
    return simhash_dedup.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens: one row for each piece of a document.

    A null or empty text is its end token alone; null ids and repeated rows are
    packed like any other; no rows give no rows.
    """
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

#: The first stage's fit and the second's expectation-maximisation aren't SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; what each one returns is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{staging_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        out = f"{root}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
