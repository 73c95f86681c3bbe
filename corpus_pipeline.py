"""The corpus pipeline: documents in, token sequences out.

Every stage takes what its predecessor kept and returns the columns of documents; the last
returns the token ids.  Stages are written as Parquet and read again in between.

A stage that decides by statistics over all rows carries only a row's key through them
(two hashes of its columns) and meets the texts again in one join.  Rows repeated whole share a
key and a decision.

Null and empty texts are ordinary rows: they are not toxic, have no sure language, and so end
at the second stage.  Rows with a null doc_id are treated like others.  Of rows that repeat doc_id and
text the one with the smallest lang, source and n_chars stays (nulls first).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import bpe, languages, minhash, mixing, toxicity
from kindred.llm.queries import RANKS, domain_of, mix_weights
from kindred.sources.staging import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _keyed(docs: DataFrame) -> DataFrame:
    """With two hashes of the whole row: rows share them only if they are equal in every column."""
    docs = docs.select(*COLUMNS)
    return docs.withColumn("row_key", F.xxhash64(*COLUMNS)).withColumn("row_check", F.xxhash64(F.lit("check"), *COLUMNS))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the models, fitted on the labelled ones, call toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.rate(docs, labels, keep=COLUMNS).where("predicted = 0").select(*COLUMNS)


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a sure language go; ``lang`` becomes the language found."""
    keyed = _keyed(docs)
    keys = ["row_key", "row_check"]
    found = languages.identify(languages.document_evidence(keyed), languages.fit_documents(docs), keys)
    # Equal rows have equal posteriors but for rounding.
    found = found.where("accepted").groupBy(*keys).agg(F.min("language").alias("lang"))
    return keyed.drop("lang").join(stage(found, "languages"), keys).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8) stays."""
    found = minhash.near_duplicates(docs, words=5, percent=80).where("kept").select("doc_id", "text_hash").distinct()
    kept = stage(found.select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")), "kept")
    rows = docs.select(*COLUMNS, F.xxhash64("text").alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & F.col("text_hash").eqNullSafe(F.col("kept_hash"))
    first = F.min(F.struct("lang", "source", "n_chars", "text")).alias("first")
    rows = rows.join(kept, same, "left_semi").groupBy("doc_id", "text_hash").agg(first)
    return rows.select("doc_id", "first.text", "first.lang", "first.source", "first.n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Four fifths of the tokens (blank-separated words), mixed by weight, each document at most once."""
    keyed = _keyed(docs)
    tokens = F.size(F.split(F.coalesce("text", F.lit("")), " "))
    rows = keyed.drop("doc_id").withColumnRenamed("row_key", "doc_id").withColumn("domain", domain_of("source"))
    chosen = mixing.mix(rows, tokens, F.floor(F.sum("tokens") * 4 / 5), mix_weights(), epochs=1)
    chosen = stage(chosen.select(F.col("doc_id").alias("row_key")), "mixed")
    return keyed.join(chosen, "row_key", "left_semi").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (binary, little-endian uint32), and whether they decode to its text."""
    rows = bpe.transcode(
        docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, decoded="decoded", keep=["doc_id", "text"]
    )
    return rows.select("doc_id", "n_tokens", "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("intact"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", identify_languages),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]
#: Models and sketches are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
