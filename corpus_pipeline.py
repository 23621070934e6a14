"""The corpus pipeline: stages over `documents`, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramlag.llm import mixing_wfq, quality_ordinal, simhash_vp, substring_cm
from tramlag.llm.common import written
from tramlag.llm.registry import SELECTED, packed


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier gives the highest grade with probability SELECTED or more."""
    model = quality_ordinal.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_ordinal.grade(docs, model).where(F.col("_tail") >= SELECTED).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by the contract of operator 2: SimHash of
    three-word shingles, links at three or fewer differing bits."""
    return simhash_vp.one_of_each(docs, shingle=3, radius=3)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document with a smaller id holds as well."""
    cut = substring_cm.remove_repeats(docs)
    text = F.when(F.col("_n_removed") > 0, F.col("_kept")).otherwise(F.col("text"))
    return _measured(cut.withColumn("text", text).select(*docs.columns))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of the mixture, one per copy taken."""
    return _measured(mixing_wfq.mixture(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    return packed(docs)


def _measured(docs: DataFrame) -> DataFrame:
    """`n_chars` of the texts as they now are."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else docs


STAGES = [
    ("quality", quality),
    ("simhash", near_duplicates),
    ("substrings", repeats),
    ("mixing", mixing),
    ("packing", packing),
]


def _shielded(stage):
    """The stage, with the columns that no operator reads under names that none of them uses."""

    def named(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        safe = docs.toDF(*[c if c in READ else f"other_{i}" for i, c in enumerate(names)])
        made = stage(spark, safe, sf_dir)
        return made.toDF(*names) if made.columns == safe.columns else made

    return named


#: Columns of `documents` that the operators read.
READ = ("doc_id", "text", "source", "n_chars")

STAGES = [(name, _shielded(stage)) for name, stage in STAGES]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: Learned grades, fingerprints and tokens are beyond SQL. A test holds the whole run against its stages in plain
#: loops, given the fitted model; others hold each stage's operator against brute force or held-out labels.
ORACLE_SQL = None
