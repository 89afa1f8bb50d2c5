"""Registered queries of the training-data operators: thin views that derive the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.llm import (bpe, codes, decontamination, hmm, hnsw, jaccard, language, mixing, periods, sharding, surrogates,
                          tokenfiles, toxicity)
from roomtide.llm.oracles import ORACLES  # noqa: F401

#: Folder of public vocabulary files; a parameter of the operators that read them.
TOKENIZERS = "/opt/tokenizers"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str, by: int):
    """crc32 of the id as text, modulo ``by``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % by


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replaced(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number", "position")


def op3_hidden_markov_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"), remainder("doc_id", 10) == 0)


def op4_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(documents, f"{TOKENIZERS}/word_bpe_49k.json")


def op5_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, a row per document and item."""
    found = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "matched", "item_size", "containment")


def op8_multi_order_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.groups(table(spark, sf_dir, "documents"), n=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


def op9_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 3) == 1
    found = language.identify(documents, held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_recurrent_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder("doc_id", 3) == 1
    found = toxicity.classify(table(spark, sf_dir, "documents").select("doc_id", "text"),
                              table(spark, sf_dir, "labels"), held_out)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted", "windows")


def op7_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in the flat files that hold them."""
    found = tokenfiles.counts(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json")
    return found.select("doc_id", "n_tokens", "ordinal")


def op10_small_world_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.neighbours(table(spark, sf_dir, "embeddings"))


def op11_trie_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", codes.code(F.col("entries")).alias("code"), "error", "label_error",
                        F.lit(codes.digest(books)).alias("codebooks_sha256"))


def planted(doc_id: Column, text: Column) -> Column:
    """The text; where the contract's hash of the id asks for it, its tail repeats its first words."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g, n = F.floor(h / 10).cast("long"), F.size(F.regexp_extract_all(text, F.lit(periods.WORD), F.lit(0)))
    start = F.pmod(g, n).cast("int")
    period = (1 + F.floor((n - start) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    return F.when((h % 10 == 0) & (n > 0), periods.repeated(text, start, period)).otherwise(text)


def op12_recompression_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    found = periods.runs(documents.withColumn("text", planted(F.col("doc_id"), F.col("text"))))
    best = found.withColumn("best", periods.greatest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.call_function("div", F.col("best.length") * 1000, F.col("best.period")).alias("exponent_milli"),
        F.sha2(periods.listing(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"), "n_words")


def op13_pareto_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.plan(table(spark, sf_dir, "documents"))
    return drawn.select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_surrogates": op1_surrogates,
    "op2_feistel_shards": op2_feistel_shards,
    "op3_hidden_markov_model": op3_hidden_markov_model,
    "op4_bpe_automaton": op4_bpe_automaton,
    "op5_benchmark_containment": op5_benchmark_containment,
    "op6_recurrent_toxicity": op6_recurrent_toxicity,
    "op7_separator_scan": op7_separator_scan,
    "op8_multi_order_jaccard": op8_multi_order_jaccard,
    "op9_string_kernel_language": op9_string_kernel_language,
    "op10_small_world_neighbours": op10_small_world_neighbours,
    "op11_trie_codes": op11_trie_codes,
    "op12_recompression_runs": op12_recompression_runs,
    "op13_pareto_mixture": op13_pareto_mixture,
}
