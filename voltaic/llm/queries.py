"""Registered queries of the numbered operators; the operators stand in the sibling modules."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaic.llm import (
    alignment,
    arrow_ids,
    bag_minhash,
    byte_bpe,
    fm_index,
    langid,
    oracle,
    pca_dedup,
    pii,
    token_counts,
    toxicity,
    url_rules,
    warc,
    whitening,
)
from voltaic.llm.common import Scratch, id_bucket, read_table

BYTE_VOCABULARY = "byte_bpe_50k.tiktoken"
WORD_VOCABULARY = "word_bpe_49k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"
BYTE_TOKENIZER = "byte_bpe_50k.json"
#: ``(verdict, host, path)``.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bag_minhash.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "kept")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels")
    held_out = F.coalesce(id_bucket("doc_id", 3) == 1, F.lit(False))
    model = toxicity.fit(docs.where(~held_out), labels.where(~held_out))
    scored = toxicity.score(docs, model, threshold=0.7, keep_text=False)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "n_hits")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return fm_index.digest(fm_index.find_spans(docs, read_table(spark, sf_dir, "benchmark"), size=10))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    manifest = warc.write(pages, Scratch(spark, "warc"), least_bytes=0, file_bytes=16 << 20)
    return warc.read(manifest).select(
        F.col("page_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path(WORD_VOCABULARY)
    return arrow_ids.read(arrow_ids.write(docs, Scratch(spark, "token-ids"), path=path, end_id=2))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, path=public_tokenizers.path(PIECE_VOCABULARY))
    return counted.select("doc_id", "n_words", "n_tokens")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(id_bucket("doc_id", 4) == 2, F.lit(False))
    model = langid.fit(docs.where(~held_out))
    out = langid.predict(docs.select("doc_id", "text"), model, keep_text=False)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(read_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return pca_dedup.near_duplicates(vectors, threshold=0.98)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path(BYTE_VOCABULARY)
    coded = byte_bpe.encode(docs, path=path, pattern=public_tokenizers.PATTERN, decode=True, keep_text=False)
    return byte_bpe.digests(coded)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(vectors, components=32).withColumnRenamed("id", "vec_id")


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(read_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = alignment.align(
        docs, path_a=public_tokenizers.path(BYTE_TOKENIZER), path_b=public_tokenizers.path(PIECE_VOCABULARY)
    )
    return found.select(
        F.col("id").cast("long").alias("doc_id"),
        "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared",
    )


QUERIES = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_warc": op4_warc,
    "op5_token_ids": op5_token_ids,
    "op6_token_counts": op6_token_counts,
    "op7_language_id": op7_language_id,
    "op8_url_rules": op8_url_rules,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_whitening": op11_whitening,
    "op12_pii": op12_pii,
    "op13_alignment": op13_alignment,
}

#: The rest has no SQL form and is tested against brute force, the library it follows or held-out rows.
ORACLE: dict[str, str] = {
    "op1_minhash_dedup": oracle.near_duplicates(0.8),
    "op3_decontamination": oracle.decontamination(10),
    "op4_warc": oracle.WARC,
    "op8_url_rules": oracle.url_rules(URL_RULES),
    "op9_embedding_dedup": oracle.embedding_duplicates(0.98),
    "op12_pii": oracle.personal_data(),
}
