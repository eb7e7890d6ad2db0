"""Quality filter, rules, exact and near duplicates, packing: a corpus made ready for training.

Each stage takes the documents that its predecessor kept, written as Parquet, and
returns documents with the same columns, the last one the pieces of packed windows.
The two models are fitted on the original documents and labels of the input folder,
on bounded samples outside the held-out fold, as in the single operators. Without good
labels nothing can be learnt: a warning says so, and no document passes the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from almanack.llm import exact_dedup, near_dedup, packing, quality_classifier, quality_rules
from almanack.llm.queries import tokenizer_path
from almanack.llm.tables import read
from almanack.session import hand_over


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality_classifier.fit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), strict=False)
    return quality_classifier.accepted(docs, model)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and consist mostly of content."""
    field = quality_rules.fit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), strict=False)
    return quality_rules.retained(docs, field)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicate(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.deduplicate(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents' pieces in windows of 2048 tokens."""
    return packing.packed(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", classify),
    ("quality_rules", rules),
    ("exact_dedup", drop_exact),
    ("minhash_near_dedup", drop_near),
    ("packing", pack),
]

#: The classifier, the line labels and the sketches have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = hand_over(docs, f"pipeline-{name}")
    return docs
