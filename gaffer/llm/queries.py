"""The registered queries of the training-data operators: whole tables in, whole
results out. Each derives its contract's columns from an operator's output."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaffer.llm import (ann, bpe, chat, decontaminate, jaccard, license, linededup, mixing, quality, rules, structure,
                        toxicity, whitening)
from gaffer.llm.common import load

TOKENIZER_FILE = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER_FILE)


def op1_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(load(spark, sf_dir, "conversations"))


def op2_positive_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    out = quality.score(docs, quality.fit(docs, load(spark, sf_dir, "labels")))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.document_takes(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op4_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    out = toxicity.score(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")))
    return out.withColumn("predicted", (F.col("score") >= toxicity.REJECT_FROM).cast("int"))


def op5_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(load(spark, sf_dir, "documents"), tokenizer_path())
    return out.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op6_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license.scan(load(spark, sf_dir, "documents"))
    best = F.get("matches", F.lit(0))
    return out.select("doc_id", "license", "dice", best["first_line"].alias("first_line"),
                      best["last_line"].alias("last_line"), F.size("matches").alias("n_licenses"),
                      F.array_join(F.transform("matches", lambda m: m["license"]), ",").alias("licenses"))


def op7_three_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op8_int8_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(load(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op9_partition_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = jaccard.similar_documents(load(spark, sf_dir, "documents"))
    return documents


def op10_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.judge(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", F.array_join("broken", ",").alias("broken_rules"))


def op11_cyk_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.damaged_and_repaired(load(spark, sf_dir, "conversations"))


def op12_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(decontaminate.decontaminate(load(spark, sf_dir, "documents"),
                                                            load(spark, sf_dir, "benchmark")))


def op13_cholesky_jacobi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(load(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_role_repair": (op1_role_repair, None),
    "op2_positive_unlabelled": (op2_positive_unlabelled, None),
    "op3_source_schedule": (op3_source_schedule, None),
    "op4_boosted_trees": (op4_boosted_trees, None),
    "op5_segment_tree_bpe": (op5_segment_tree_bpe, None),
    "op6_license_dice": (op6_license_dice, None),
    "op7_three_line_windows": (op7_three_line_windows, linededup.ORACLE_SQL),
    "op8_int8_tiles": (op8_int8_tiles, None),
    "op9_partition_join": (op9_partition_join, None),
    "op10_risk_controlled_rules": (op10_risk_controlled_rules, None),
    "op11_cyk_repair": (op11_cyk_repair, structure.ORACLE_SQL),
    "op12_wu_manber": (op12_wu_manber, decontaminate.ORACLE_SQL),
    "op13_cholesky_jacobi": (op13_cholesky_jacobi, None),
}
