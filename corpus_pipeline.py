"""A training corpus from ``documents``: quality rules, near-duplicates, benchmark passages, mixing, token files.

Every stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read
again as the next stage's documents. All but the last return the columns of ``documents``. A stage's
input is removed once its output is stored, so the corpus stands on disk twice at most.

Defined cases: a document with a null or empty text, or of fewer than 50 words, fails the base rule of the
first stage and goes; very long texts are one row throughout; ties and rows that share doc_id and text are
one document to the second stage, which keeps one; a null doc_id is kept like others, last among near-duplicates
and first in the token files; a null source is a source of its own; empty tables give empty stages; extra
columns are carried to the mixing stage, whatever their names, and are not in the token files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from record_loader.llm import common, decontaminate, jaccard, mixing, rules, tokens


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return rules.kept_documents(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return jaccard.one_of_each(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminated(docs, common.read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files, read back: (doc_id, start, n_tokens, ids_crc32)."""
    return tokens.token_files(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("ngram_jaccard", distinct),
    ("decontamination", clean),
    ("mixing", mix),
    ("token_files", token_ids),
]

#: The estimate behind the quality rules and the token ids have no SQL form; the pipeline is tested
#: against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, last = common.read(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = common.new_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            if last:
                common.removed(spark, last)
            last = path
    return docs
