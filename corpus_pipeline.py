"""The corpus pipeline: filtering, deduplication, mixing and tokenisation of documents.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and reread as the next one's docs.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaffer.llm import pipeline
from gaffer.llm.common import load, stored

STAGES = [
    ("toxicity", pipeline.drop_toxic),
    ("line_dedup", pipeline.drop_repeated_lines),
    ("near_duplicates", pipeline.drop_similar),
    ("mix_sources", pipeline.mix_sources),
    ("bpe", pipeline.tokenise),
]

# A learnt model, a seeded shuffle and merges of byte pairs can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
