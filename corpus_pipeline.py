"""The corpus pipeline: classify, drop near duplicates, cut repeated passages, mix sources, encode.

Each stage works on all rows that the stage before kept. Documents whose text a stage empties stay until mixing, which
never takes a text without words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm import bpe, minhash_dedup, mixing, quality, substring_dedup
from quirework.llm.common import written


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.fit(docs, quality.labels_of(spark, sf_dir)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substring_dedup.dedup_substrings(docs, counts=False)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.bpe_documents(docs)


STAGES = [
    ("quality classifier", drop_bad),
    ("minhash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeats),
    ("mixing to target weights", mix_sources),
    ("bpe encoding and decoding", encode),
]

#: The classifier, the sampling of near duplicates and byte pair encoding are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs
