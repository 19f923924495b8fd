"""A training-data pipeline over ``documents``: quality, language, shared lines, near-duplicates, packing.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and reread as the next one's docs.
All but the last return the columns of ``docs``. Models are fitted on the stage's own input, outside the held-out fold.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from assetlens.llm import langid, line_dedup, packing, quality_model, simhash
from assetlens.llm.common import read
from assetlens.llm.queries import tokenizer_path
from assetlens.session import scratch_path

def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier predicts 0 for. Null and empty texts are scored like any other."""
    model = quality_model.train(docs, read(spark, sf_dir, "labels"))
    return docs.where(quality_model.score_column(model, F.col("text")) >= quality_model.THRESHOLD)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of no language: null texts, those without a letter, and those unlike every learned one: noise and
    other scripts. How like is enough depends on the number of n-grams, so texts of a word or two stay."""
    found = langid.predict_column(langid.train(docs), F.col("text"))
    return docs.where((found["lang"] != langid.UNDETERMINED) & (found["score"] >= langid.least_score(found["grams"])))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that ten or more documents share; a document that loses all its lines stays, empty. ``n_chars``,
    where there is one, follows the text."""
    row = line_dedup.drop_shared_lines(docs, min_docs=10, min_chars=1).select("row.*")
    if "n_chars" not in docs.columns:
        return row
    return row.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash component."""
    return simhash.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of at most 4096 tokens."""
    return packing.pack(docs, functools.partial(packing.word_encoder, tokenizer_path("word_bpe_49k.json")))


STAGES = [("quality", quality), ("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("packing", packed)]

ORACLE_SQL = None  # models and best-fit packing have no SQL form; tests hold each stage against a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
