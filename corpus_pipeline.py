"""From documents to a training mix: quality, exact and near copies, benchmark leaks, target weights.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to
the shared folder and reads it back as the next one's documents. All stages but the last
return the columns they were given, whatever these are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import decontaminate, exact_dedup, mixing, near_dedup, quality
from martloom.llm.common import decided, free_shuffles, fresh, table
from martloom.session import stage

# Learned weights, set hashes and knapsack choices have no SQL form.
ORACLE_SQL = None


def _whole(docs: DataFrame) -> DataFrame:
    """Id and text beside the whole row, so that no column of the row clashes with a result."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_whole"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the best grade suffices."""
    labels = table(spark, sf_dir, "labels")
    model = quality.train(docs.select("doc_id", "text"), quality.grades_of(labels))
    return quality.score(_whole(docs), model).filter("kept").select("_whole.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return decided(docs, exact_dedup.exact_groups(docs).filter("kept"), {})


# A stage without a contract of its own links near copies from a similarity of 0.8.
NEAR_PERCENT = 80


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies linked at 0.8 or more, that with the smallest doc_id."""
    return decided(docs, near_dedup.near_groups(docs, percent=NEAR_PERCENT).filter("kept"), {})


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    found = decontaminate.contamination(_whole(docs), table(spark, sf_dir, "benchmark"), keep=["_whole"])
    return found.filter(~F.col("contaminated")).select("_whole.*")


def target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, with how many of their words it takes, repeats counted."""
    mixed = mixing.mix(docs).filter("taken > 0")
    return decided(docs, mixed, {name: fresh(docs, f"mix_{name}") for name in ("size", "source_size", "target", "taken")})


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("minhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark_leaks),
    ("mixing", target_weights),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
        free_shuffles(spark)
    return docs
