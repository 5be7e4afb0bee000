"""Corpus pipeline: toxicity, near duplicates, repeated passages, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; all but the last return the columns of ``documents``. ``run``
writes every stage's result as Parquet in the shared checkpoint folder and
reads it back, so a lost executor costs no more than the running stage.

Nulls, empty texts, ties and repeated rows follow the operators' docstrings.
In short: null and empty texts pass the first three stages (one of them, as
near duplicates of each other) and are not taken by the mix, which counts
words. An empty table passes through as an empty table. Very long texts are
worked on whole in every stage: scored, fingerprinted, cut, counted and packed
(their full windows fill sequences of their own). Further columns, whatever
their names, go along to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import mixing, packing, simhash, substrings
from lakeloom.llm import toxicity as toxic
from lakeloom.session import scratch_path
from lakeloom.tables import load


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labels outside the held-out
    fold, does not find toxic."""
    return toxic.clean(docs, toxic.train(docs, load(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates: the smallest id."""
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows that start earlier in the corpus;
    ``n_chars`` follows the text where there is such a column."""
    out = substrings.remove_repeats(docs)
    if "n_chars" in docs.columns:
        length = F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), length))
    return out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in as many copies as the mix takes."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mixed documents, by sequence."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# Hashes (XXH64), a fitted model and a tokenizer decide: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
