"""From raw documents to packed training sequences, over the operators of the training-data package.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``. ``run``
writes every stage's result as Parquet in the shared folder and reads it back as the next one's input, so a lost
executor costs at most a part of one stage. ``labels`` of ``sf_dir`` is read by the first stage only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.llm import classifier, naming, neardup, packing, pii
from voltide.llm.queries import SURROGATE_KEY
from voltide.llm.tables import table
from voltide.session import stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the labelled ones among them."""
    model = classifier.fit(docs, table(spark, sf_dir, "labels"), "quality")
    return classifier.keep_good(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the smallest id."""
    return naming.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that with the smallest id."""
    return neardup.deduplicate(docs)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; ``n_chars`` follows the new text."""
    replaced = pii.pseudonymise(docs, SURROGATE_KEY)
    if "n_chars" not in docs.columns:
        return replaced
    return replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and their place in it."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("surrogates", surrogates),
    ("best-fit packing", best_fit_packing),
]

# Training, sampling and packing have no SQL form; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
