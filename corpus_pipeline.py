"""A corpus pipeline: five operators, one after the other, over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet in the shared folder and read again as the next one's docs.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import budget_mix, fuzzy_lines, mil_quality, odd_sketch, piece_viterbi
from shelfwise.llm.common import scratch, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return mil_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines that repeat an earlier one, exactly or nearly, out of the texts."""
    new = fuzzy_lines.dedup_lines(docs)
    return new.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one with the smallest id, of each group of near copies.

    Rows that share an id stand or fall together; of those with the same text too, one stays.
    """
    kept = mil_quality.filter_by(docs, lambda d: odd_sketch.near_duplicates(d).where("kept").select("id"))
    twice = docs.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_id"))
    again = F.col("doc_id").eqNullSafe(F.col("_id"))
    marked = scratch(kept.join(twice, again, "left").withColumn("_twice", F.col("_id").isNotNull() | F.col("doc_id").isNull()),
                     "pipeline-kept").drop("_id")
    once = marked.where("not _twice").drop("_twice")
    return once.unionByName(marked.where("_twice").drop("_twice").dropDuplicates(["doc_id", "text"]))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws the documents by the target weights; one that two epochs include comes twice."""
    return budget_mix.mixed(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the piece ids of each text, and their number."""
    return piece_viterbi.encode_texts(docs).withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mixture", mixture),
          ("pieces", pieces)]

#: The classifier, the MinHash stage and the encoder can't be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
