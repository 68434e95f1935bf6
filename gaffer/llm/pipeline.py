"""The stages of ``corpus_pipeline.py``: each applies one operator to all that
its predecessor kept, and all but the last return the columns of documents."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaffer.llm import bpe, jaccard, linededup, mixing, toxicity
from gaffer.llm.common import load, prepare
from gaffer.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def documents(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. It learns from ``labels``
    (the same rows as op4) and scores every document."""
    prepare(spark)
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    return documents(docs.where(toxicity.score_column(spark, model) < toxicity.REJECT_FROM))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of three lines go; a document goes when nothing of it is left."""
    cut = linededup.dedup_lines(documents(docs))
    left = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return documents(left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
                                     .otherwise(F.col("n_chars"))))


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar documents stays, the smallest doc_id."""
    prepare(spark)
    return documents(jaccard.one_of_each(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them (0, 1 or 2 times)."""
    return documents(mixing.mixed_documents(docs))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian 32-bit) and the decoded text's digest."""
    prepare(spark)
    out = bpe.encode_decode(docs, tokenizer_path())
    return out.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
