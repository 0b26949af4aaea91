"""From raw documents to a training mix: four stages, each on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landledger.llm.edit_matching import without_leaks
from landledger.llm.line_crf import fit, with_quality
from landledger.llm.mixing import entropy_mix
from landledger.llm.ngram_join import jaccard_components
from landledger.llm.shared import table
from landledger.session import discard, kept, materialize, scratch_scope


def carried(docs: DataFrame) -> DataFrame:
    """Documents with their row in a struct, so that no column of theirs clashes with one that a stage adds."""
    return docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line labeller does not reject. NULL texts are judged as empty ones."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    return with_quality(carried(docs), model).filter("predicted = 1").select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents with similar shingle sets, the one of smallest id.

    Documents are similar from 0.8 on over their five-word shingles. Documents
    without words and documents without an id stay. Rows that repeat an id and
    its text are one document.
    """
    grouped = jaccard_components(docs, words=5, percent=80)
    gone = grouped.filter("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    again = grouped.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    if again.isEmpty():
        return kept
    named = kept.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"])
    return named.unionByName(kept.filter("doc_id IS NULL"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return without_leaks(carried(docs), table(spark, sf_dir, "benchmark")).select("_row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with their number of copies."""
    return entropy_mix(docs).filter("copies > 0")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

# No stage can be expressed in SQL; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; a stage's tables are removed when its result is written, and that one when the next is."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        with scratch_scope(spark):
            made = kept(materialize(stage(spark, docs, sf_dir), name))
        if number:
            discard(docs)
        docs = made
    return docs
