"""Documents from raw to encoded: quality, line dedup, near dedup, decontamination, encoding.

Every stage works on all that the one before kept and is written as Parquet in the shared folder before
the next one reads it, so a lost executor repeats a part of one stage.

In every stage null texts are read as empty ones, texts are read whole however long, an empty table gives an
empty table, and columns beyond those of documents are left out. Rows that repeat id and text are one
document for line dedup (all copies keep the same lines) and for near dedup (one row stays); the other
stages judge each row by itself. Each stage says how it breaks ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascata.llm import common, decontamination, line_dedup, queries, quality_classifier, sentencepiece_codec, simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; the model is fitted on these documents.

    A score right at the threshold is kept; equal texts have equal scores. Without labels all stay.
    """
    common.ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.fit(quality_classifier.measure(docs), labels)
    scored = docs.withColumn("_score", quality_classifier.text_score(F.col("text"), model))
    return scored.where(F.col("_score") >= quality_classifier.THRESHOLD).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of 50 words or more go; a document that loses all its lines stays, empty.

    The first copy is the one of the least id, null ids first, ties by text hash.
    """
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays whose fingerprints link at two or fewer differing bits.

    The one with the least id stays, null ids last, ties by text hash. Documents without a word are one group.
    """
    common.ship(spark)
    return simhash.keep_one(docs, 3, 2).select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go; repeated rows and items change nothing, a null id stays if clean."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ids and the text decoded from them; no ids and "" for empty texts."""
    common.ship(spark)
    model = queries.piece_model()
    coded = docs.select(*COLUMNS, sentencepiece_codec.coded_column(F.col("text"), model).alias("_c"))
    return coded.select(*COLUMNS, F.size("_c.ids").alias("n_tokens"), "_c.ids", "_c.decoded")


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near dedup", near_duplicates),
    ("decontamination", decontaminated),
    ("encoding", encoded),
]
#: Not to be said in SQL. Tests compare each stage's documents with a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
