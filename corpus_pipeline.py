"""Corpus cleaning pipeline: five stages from raw documents to token ids.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; ``run`` writes each stage's rows as Parquet in the shared
folder and reads them back as the next stage's ``docs``, so a lost executor or
a restarted stage never recomputes what came before.

Null and empty texts, and texts without letters, have no language and go in the
second stage. Null ids are allowed; documents with one are classed by their
texts. Of repeated rows, equal ones included, the near-duplicate stage keeps
one. Columns other than ``COLUMNS`` are not read, whatever their names. An empty
table gives an empty table at every stage.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaic.llm import bag_minhash, byte_bpe, fm_index, langid, toxicity
from voltaic.llm.common import Scratch, id_bucket, read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document stays if its best language has at least this posterior.
MIN_LANGUAGE_SCORE = 0.5
#: A document is rejected as toxic from this score on.
TOXIC_SCORE = 0.7


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below ``TOXIC_SCORE``; the lexicon is learned from labelled ``docs``."""
    learn = ~F.coalesce(id_bucket("doc_id", 3) == 1, F.lit(False))
    model = toxicity.fit(docs.where(learn), read_table(spark, sf_dir, "labels").where(learn))
    return toxicity.score(docs.select(COLUMNS), model, threshold=TOXIC_SCORE, drop=True).select(COLUMNS)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters and a language the model is sure enough of."""
    learn = ~F.coalesce(id_bucket("doc_id", 4) == 2, F.lit(False))
    model = langid.fit(docs.where(learn))
    return langid.predict(docs.select(COLUMNS), model, least=MIN_LANGUAGE_SCORE).select(COLUMNS)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return bag_minhash.keep_one(docs.select(COLUMNS))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test window (ten consecutive words of a benchmark item)."""
    found = fm_index.find_spans(docs.select(COLUMNS), read_table(spark, sf_dir, "benchmark"), size=10)
    return found.where("n_hit = 0").select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the decoded bytes."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = byte_bpe.encode(
        docs.select("doc_id", "text", "lang", "source"), path=path, pattern=public_tokenizers.PATTERN, decode=True, keep_text=False
    )
    return coded.select(
        "doc_id", "lang", "source", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", remove_toxic),
    ("language_id", keep_known_language),
    ("near_dedup", remove_near_duplicates),
    ("decontamination", remove_benchmark),
    ("byte_bpe", encode),
]

#: No stage but the window search can be stated in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents").select(COLUMNS)
    before = None
    for name, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir), name)
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
