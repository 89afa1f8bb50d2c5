"""The training-data pipeline: five stages over ``documents``, each one an operator of roomtide.llm.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last
return the columns of ``documents``.  Rows are told apart by doc_id,
in the n-gram Jaccard join by all columns.

Defined results: documents without text are kept by every filter (nothing speaks against them) and
have no tokens; an empty table gives an empty result; columns beyond those of ``documents`` pass
through the first four stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.llm import bpe, decontamination, jaccard, surrogates, toxicity
from roomtide.llm.names import unused
from roomtide.llm.queries import TOKENIZERS, remainder, table
from roomtide.runtime import stage


#: Columns that the toxicity network adds.
RESULTS = ("score", "windows", "predicted")


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the toxicity network rejects (score 0.7 or more)."""
    # Columns that are called like the network's results are set aside meanwhile.
    aside = {c: new for c, new in zip(RESULTS, unused(docs.columns, *RESULTS)) if c in docs.columns}
    judged = toxicity.classify(docs.withColumnsRenamed(aside), table(spark, sf_dir, "labels"), remainder("doc_id", 3) == 1)
    return judged.where("predicted = 0").drop(*RESULTS).withColumnsRenamed({n: c for c, n in aside.items()}).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group linked by five-word Jaccard similarity 0.8, keep one row, of the smallest doc_id."""
    return jaccard.deduplicated(docs, n=5, percent=80)


def keep_unseen_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain 80 % of a benchmark item's five-word shingles."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by surrogates; ``n_chars`` follows the new text."""
    aside = {"n_entities": unused(docs.columns, "n_entities")[0]} if "n_entities" in docs.columns else {}
    out = surrogates.replaced(docs.withColumnsRenamed(aside))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_entities") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(
            docs.schema["n_chars"].dataType))
    return out.drop("n_entities").withColumnsRenamed({n: c for c, n in aside.items()}).select(*docs.columns)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the decoded text."""
    return bpe.encode(docs.select("doc_id", "text"), f"{TOKENIZERS}/word_bpe_49k.json")


STAGES = [
    ("toxicity", keep_civil),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", keep_unseen_in_benchmark),
    ("personal data surrogates", replace_personal_data),
    ("BPE encoding and decoding", encode_and_decode),
]

#: Models, set similarity joins and automata have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what a stage returns is written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for place, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stage(docs)
    return docs
