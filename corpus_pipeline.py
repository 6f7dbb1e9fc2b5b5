"""A corpus pipeline over ``documents``: reject toxic texts, keep one of each near-duplicate group, drop what overlaps
the benchmark, mask secrets, and pack what is left into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's documents; all but the last return the columns they got, whatever further
columns there are and whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import decontaminate, packing, secret_scan, simhash, toxicity
from eventide.llm.base import load_table, materialize, prepare, query
from eventide.llm.queries import fold, public_tokenizer

MASK = "[secret]"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.7, by a model of the labels outside the held-out fold.

    Each row is judged by its own text, so equal rows go or stay alike; null and empty texts have a harmless score and
    stay, whatever their id; an empty table, or labels of one class only, reject nothing."""
    prepare(spark)
    model = toxicity.fit(docs, load_table(spark, sf_dir, "labels").filter(fold() != 1))
    return docs.filter(toxicity.score_column(model, F.col("text")) < 0.7)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of 4-word shingles link at 4 bits or fewer.

    The one of the smallest id stays, of equal ids the smallest text hash, of equal rows any one; null ids come last.  Null,
    empty and wordless texts share fingerprint zero: one of them stays.  An empty table stays empty."""
    prepare(spark)
    return simhash.keep_one(docs, shingle=4, distance=4)


def drop_benchmark_overlaps(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap of 13 words (or a whole shorter item) with the benchmark at 80 % equal words.

    Rows go or stay by their own text, so null, repeated and equal ids decide nothing; null and empty texts stay; an empty
    table or benchmark drops nothing."""
    prepare(spark)
    return decontaminate.drop_contaminated(docs, load_table(spark, sf_dir, "benchmark"), min_words=13, similarity=0.8)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets masked and n_chars brought in line (counted anew where a mask stands in the text).

    Rows are masked by their own text: null and empty texts stay as they are, equal rows are masked alike, null ids as
    any other; overlapping finds share one mask; an empty table stays empty."""
    prepare(spark)
    masked = secret_scan.redact(docs, mask=MASK)
    return masked.withColumn("n_chars", F.when(F.col("text").contains(MASK), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens and their places.

    Null and empty texts are one token, the end mark; rows of equal or null ids are packed each for itself; pieces of one
    length may take each other's place; an empty table gives no pieces."""
    prepare(spark)
    return packing.pack_documents(docs, public_tokenizer(), capacity=4096)


STAGES = [("toxicity", reject_toxic), ("simhash_near_dedup", keep_one_of_each), ("benchmark_decontamination", drop_benchmark_overlaps),
          ("secret_scans", mask_secrets), ("best_fit_packing", pack_sequences)]

ORACLE_SQL = None  # a trained model and best-fit packing are beyond SQL; tests/llm holds run() against a plain version


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that every stage kept."""
    docs = load_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
