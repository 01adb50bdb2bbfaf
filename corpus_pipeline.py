"""Curates documents for training, stage by stage, with the operators of rinse.llm.

Each stage is a function of (spark, docs, sf_dir). All but the last return rows with the columns of documents:
documents in no known language go, one document of each class of near-duplicates stays, documents that overlap with
the benchmark go, sources are mixed to their target weights (a document that the mix reads in two passes stands twice),
and the ids of what is left are written as ORC; the last stage returns their index. The result depends on trained
language statistics and sampled paths, so there is no SQL for it; tests compare it with a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rinse.llm import chosen_path, language_mixture, mixing, spaced_seeds, token_orc
from rinse.llm.queries import public_tokenizer
from rinse.llm.shared import free_name, shared_folder, table, written

ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those whose words fit no mixture of languages better than noise."""
    model = language_mixture.learn_languages(docs)
    into = free_name(docs, "language_mixture")
    found = language_mixture.predict_languages(docs, model, into=into)
    return found.where(F.col(into)["fits"]).drop(into)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that have no near copy, and of each class of near copies the one with the least id. Null
    texts are nobody's copy; of rows that are equal one stays."""
    return chosen_path.one_of_each(docs, chosen_path.jaccard_classes(docs.select("doc_id", "text")))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that overlap with an item of the benchmark. Items of fewer than five words are left out, as
    documents with a common word or phrase are clean."""
    return spaced_seeds.without_overlaps(docs, table(spark, sf_dir, "benchmark"), fewest=5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the mix reads words, once for each pass that does."""
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the ids of all documents as ORC in ascending order of doc_id, null first, and returns their index."""
    to = shared_folder(spark, "tokens")
    token_orc.write_tokens(docs, to, public_tokenizer("byte_bpe_50k.json"))
    return token_orc.token_index(spark, to)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs
