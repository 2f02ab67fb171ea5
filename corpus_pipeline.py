"""Corpus pipeline: language ID, line dedup, n-gram Jaccard join, benchmark decontamination, mixing.

Each stage takes all that its predecessor kept.  All but the last return the columns
of documents; the last adds the words, the posterior of each domain, the rate and
the copies of each document.  It filters nothing: a document that the mixture leaves
out has the rate 0 and no copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weakspot.llm.common import read, removed, written
from weakspot.llm.decontamination import decontaminated
from weakspot.llm.jaccard_join import one_of_each
from weakspot.llm.language_id import accepted, train
from weakspot.llm.line_dedup import without_recurring_lines
from weakspot.llm.mixing import TARGETS, domains_of_labels, drawn, mixed


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language can't be told: no letter, or no language clearly ahead."""
    return accepted(docs, train(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines of recurring templates, but for the first document; drop what is left without a line."""
    cut = without_recurring_lines(docs, drop_emptied=True)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in cut.columns else cut


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold passages of the benchmark."""
    return decontaminated(docs, read(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rates at which the documents meet the target weights of the domains."""
    rows, _ = mixed(docs, domains_of_labels(read(spark, sf_dir, "labels")), TARGETS)
    return drawn(rows)


STAGES = [
    ("language ID", language), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination), ("mixing to target weights", mixture),
]
# training, similarity and iteration of the stages have no SQL; tests hold them against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's table stands in the shared folder until the next is written."""
    docs, before = read(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs, path = written(stage(spark, docs, sf_dir))
        if before:
            removed(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
