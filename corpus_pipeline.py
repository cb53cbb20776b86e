"""The corpus pipeline: toxicity, near-duplicates, benchmark leaks, personal data, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's result as Parquet in the shared folder and reads it back as the next one's
docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerwatch.llm import decontaminate, minhash, mixing, pii, toxicity
from ledgerwatch.llm.common import table, written


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to the target weights; adds copy, rate and shuffle_key."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", toxicity.stage),
    ("minhash", minhash.stage),
    ("decontamination", decontaminate.stage),
    ("pii", pii.stage),
    ("mixing", mixed),
]

#: The first stages (a learned score, near-duplicate components) aren't SQL; tests compare
#: the run to a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
