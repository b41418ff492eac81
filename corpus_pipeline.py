"""Training corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes all its predecessor kept and returns a table that is written and read again:
low-quality documents go, repeated lines go, one document of each group of near duplicates stays,
repeated passages go, and what is left is packed. All but the last keep the columns of documents;
``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join, line_dedup, packing, quality, substring_dedup
from tidemark.llm.queries import table, vocabulary
from tidemark.llm.shipping import ship
from tidemark.scratch import materialise

NEAR_WORDS = 5
NEAR_PERCENT = 80


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labelled rows of the training folds."""
    ship(spark)
    apart = F.coalesce(quality.held_out(5, 0), F.lit(False))
    machine = quality.train(docs.filter(~apart), table(spark, sf_dir, "labels"))
    return quality.score(docs, machine).filter(F.col("quality_score") >= quality.THRESHOLD).select(*docs.columns)


def _with_text(docs: DataFrame, columns: list[str]) -> DataFrame:
    counted = docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in columns else docs
    return counted.select(*columns)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many documents share."""
    ship(spark)
    return _with_text(line_dedup.drop_repeated_lines(docs), docs.columns)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest id, null ids last; documents without words stay.

    Groups are of rows, not of ids: rows that repeat an id stay or go by their own texts, and of equal rows one stays.
    """
    ship(spark)
    names = {"_row_" + "x" * n for n in range(len(docs.columns) + 1)} - set(docs.columns)
    row = min(names, key=len)  # a name that no column has
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    groups = jaccard_join.similar_groups(numbered.select(F.col(row).alias("doc_id"), "text"), NEAR_WORDS, NEAR_PERCENT)
    grouped = materialise(groups.select(F.col("doc_id").alias(row), "component_id"), "groups")
    shared = grouped.filter(F.col("component_id") != F.col(row)).select("component_id").distinct()
    members = grouped.join(shared, "component_id", "left_semi").join(numbered.select(row, "doc_id"), row)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(row).alias("first"))).alias("best")
    stays = members.groupBy("component_id").agg(best)
    gone = members.join(stays, "component_id").filter(F.col("best.first") != F.col(row)).select(row)
    return numbered.join(gone, row, "left_anti").select(*docs.columns)


def fresh_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages seen before; characters of which only a part is left go too."""
    ship(spark)
    kept = substring_dedup.remove_repeats(docs)
    whole = kept.withColumn("text", substring_dedup.text_of("kept"))
    return _with_text(whole, docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    ship(spark)
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality", good_quality),
    ("lines", fresh_lines),
    ("near duplicates", one_of_near_duplicates),
    ("passages", fresh_passages),
    ("packing", packed),
]

# Neither the classifier nor tokenisation can be put in SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each is written to shared storage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
