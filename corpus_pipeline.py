"""A training corpus from raw documents, in stages that each hand on a Parquet table.

Stages take ``(spark, docs, sf_dir)``. All but the last return the columns of
``docs``, whatever they are called; the last one returns token ids.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.llm import bpe, leaks, minhash, pii, quality
from keyfold.llm.queries import GOOD, table, vocabulary
from keyfold.session import shared_dir


def _carried(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns a stage works on, beside all others in one struct: no text travels twice."""
    rest = [c for c in docs.columns if c not in columns]
    return docs.select(F.struct(*rest).alias("_rest") if rest else F.lit(True).alias("_rest"), *columns)


def _whole(found: DataFrame, docs: DataFrame, *columns: str) -> DataFrame:
    """The columns of ``docs`` again."""
    return found.select(*((F.col(c) if c in columns else F.col("_rest")[c].alias(c)) for c in docs.columns))


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects.

    Null and empty texts are scored like any other; repeated rows stay or go together.
    Rows without an id are scored too, and never learned from. An empty table stays empty.
    """
    used = ["doc_id", "text", "n_chars"]
    scored = quality.score_quality(_carried(docs, *used), table(spark, sf_dir, "labels"), length="n_chars")
    return _whole(scored.where(F.col("score") >= GOOD), docs, *used)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near duplicates, on shingles of five words.

    Rows with equal ids are one document and stay or go together; rows without an id
    stay.
    """
    gone = minhash.near_duplicates(docs.select("doc_id", "text"), width=5, percent=80).where("not kept and doc_id is not null")
    return docs.join(gone.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark. Null and empty texts hold none and stay."""
    found = leaks.find_leaks(_carried(docs, "text"), table(spark, sf_dir, "benchmark"))
    return _whole(found.where(F.size("hit_runs") == 0), docs, "text")


def private_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind in brackets in place of personal data; n_chars follows a text that changed.

    Null and empty texts stay as they are; repeated rows change alike.
    """
    used = ["doc_id", "text", "n_chars"]
    found = pii.redact(pii.all_spans(pii.find_personal_data(_carried(docs, *used))))
    length = F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return _whole(found.withColumn("n_chars", length), docs, *used)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and what they decode to as a digest; a null or empty text has none."""
    encoded = bpe.digests(bpe.encode_decode(docs.select("doc_id", "text", "lang", "source"), *vocabulary()))
    return encoded.select("doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality", good_documents),
    ("near_dedup", distinct_documents),
    ("decontaminate", clean_documents),
    ("pii", private_documents),
    ("encode", token_ids),
]

#: SQL expresses neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
