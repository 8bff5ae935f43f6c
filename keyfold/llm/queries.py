"""The operators of this subpackage over their whole test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.llm import (
    bpe, divergence, infill, leaks, minhash, neighbours, pages, pii, quality, repeats, rules, suffix_tree, units,
)
from keyfold.llm.oracles import ORACLES as ORACLES

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> tuple[bytes, str]:
    import public_tokenizers

    with open(public_tokenizers.path(VOCABULARY), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


def op1_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


#: A document is predicted to be good from this score on.
GOOD = 0.3


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    scored = quality.score_quality(docs, table(spark, sf_dir, "labels"), length="n_chars")
    return scored.select("doc_id", quality.in_fold("doc_id", 0).alias("held_out"), "score",
                         (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), quality.in_fold("doc_id", 1))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, width=2, percent=80)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = leaks.summary(leaks.find_leaks(docs, table(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
                        leaks.written("hit_spans").alias("hit_spans"))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.dedup_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.all_spans(pii.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text")))
    counts = [pii.count("base_spans", k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.written("base_spans").cast("binary"), 256).alias("base_sha256"),
                        pii.written("spans").alias("spans"), F.size("added_spans").cast("long").alias("n_added"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = units.dedup_units(table(spark, sf_dir, "documents").select("doc_id", "text"), headings=True)
    return found.select("doc_id", "n_units", F.size("removed").cast("long").alias("n_removed"), "removed",
                        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encode_decode(docs, *vocabulary())).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


def op12_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = infill.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(infill.restored().cast("binary"), 256).alias("restored_sha256"))


QUERIES = {
    "op1_pages": op1_pages,
    "op2_quality": op2_quality,
    "op3_suffix_tree": op3_suffix_tree,
    "op4_minhash": op4_minhash,
    "op5_decontaminate": op5_decontaminate,
    "op6_repeats": op6_repeats,
    "op7_pii": op7_pii,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_neighbours": op9_neighbours,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_source_divergence": op11_source_divergence,
    "op12_adaptive_rules": op12_adaptive_rules,
    "op13_fill_in_middle": op13_fill_in_middle,
}
