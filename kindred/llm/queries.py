"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import ann, bpe, collocations, kdshards, languages, licenses, minhash, mixing, quality, ranked, records, subspace, toxicity
from kindred.sources.staging import scratch

RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"


def _documents(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", *columns)


def _embeddings(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/embeddings.parquet")


def op1_subspace(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of a label with a cosine of 0.98 or more."""
    return subspace.near_vectors(_embeddings(spark, d), 0.98)


def op2_kdshards(spark: SparkSession, d: str) -> DataFrame:
    """Eight shards of nearly equal bytes."""
    placed = kdshards.shard(_documents(spark, d, "lang", "source"), 8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_licenses(spark: SparkSession, d: str) -> DataFrame:
    """License phrases and notices in every text."""
    return licenses.scan(_documents(spark, d)).drop("spans")


def op4_languages(spark: SparkSession, d: str) -> DataFrame:
    """The language of every document and every page; models fitted on the documents."""
    docs = _documents(spark, d, "lang", "source")
    model = languages.fit_documents(docs)
    pages = languages.page_evidence(spark.read.parquet(f"{d}/pages.parquet"))
    of_docs = languages.identify(languages.document_evidence(docs), model, ["doc_id"])
    of_pages = languages.identify(pages, model, ["page_id"])
    return of_docs.unionByName(of_pages, allowMissingColumns=True)


def op5_minhash(spark: SparkSession, d: str) -> DataFrame:
    """Near-duplicates: three-word shingles, similarity 0.85."""
    found = minhash.near_duplicates(_documents(spark, d), words=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op6_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """Scores by class-conditional models fitted on the labelled rows outside fold 0."""
    rated = toxicity.rate(_documents(spark, d), spark.read.parquet(f"{d}/labels.parquet"))
    return rated.select("doc_id", F.coalesce(toxicity.fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op7_records(spark: SparkSession, d: str) -> DataFrame:
    """Token ids written to record files, indexed, and read back."""
    path = scratch(spark, "records")
    records.write(_documents(spark, d), path, public_tokenizers.path(TOKENIZER))
    records.write_index(spark, path)
    back = records.read_all(spark, path)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_bpe(spark: SparkSession, d: str) -> DataFrame:
    """Token ids by the transducer, and the text decoded from them."""
    ranks = public_tokenizers.path(RANKS)
    rows = bpe.transcode(_documents(spark, d), ranks, public_tokenizers.PATTERN, decoded="decoded", keep=["doc_id"])
    return rows.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def domain_of(source: str) -> Column:
    """The domain of a source: which block of five its number falls in; 'd-' without a number."""
    number = F.regexp_extract(F.coalesce(F.col(source), F.lit("")), "([0-9]{1,6})$", 1)
    return F.concat(F.lit("d"), F.when(number == "", F.lit("-")).otherwise(F.floor(number.cast("int") / 5).cast("string")))


def mix_weights() -> dict[str, Column]:
    """Integer weights among siblings: domains, languages, sources."""
    return {
        "domain": F.when(F.col("domain") == "d0", 4).when(F.col("domain") == "d1", 3).otherwise(2),
        "lang": F.when(F.col("lang") == "en", 5).when(F.col("lang") == "es", 3).otherwise(2),
        "source": F.lit(1),
    }


def op8_mixing(spark: SparkSession, d: str) -> DataFrame:
    """As many tokens (blank-separated words) as three fifths of the table, mixed by weight."""
    docs = _documents(spark, d, "lang", "source").withColumn("domain", domain_of("source"))
    tokens = F.size(F.split(F.coalesce("text", F.lit("")), " "))
    return mixing.mix(docs, tokens, F.floor(F.sum("tokens") * 3 / 5), mix_weights(), epochs=4)


def op10_ann(spark: SparkSession, d: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    return ann.search(_embeddings(spark, d), F.col("vec_id") % 50 == 0, 5)


def op11_quality(spark: SparkSession, d: str) -> DataFrame:
    """Base rules and the verdict of boosted trees fitted on the labelled documents."""
    return quality.judge(_documents(spark, d), spark.read.parquet(f"{d}/labels.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op12_search(spark: SparkSession, d: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return ranked.search(_documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet"), 10)


def op13_collocations(spark: SparkSession, d: str) -> DataFrame:
    """The 2,000 strongest phrases of each language."""
    return collocations.collocations(_documents(spark, d, "lang"))


QUERIES = {
    "op1_subspace": op1_subspace, "op10_ann": op10_ann, "op2_kdshards": op2_kdshards, "op3_licenses": op3_licenses, "op4_languages": op4_languages, "op5_minhash": op5_minhash, "op6_toxicity": op6_toxicity, "op7_records": op7_records, "op8_mixing": op8_mixing, "op9_bpe": op9_bpe,
    "op11_quality": op11_quality, "op12_search": op12_search, "op13_collocations": op13_collocations,
}
