"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Every function takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but
the last return the columns of ``documents``. Nulls, empty tables and repeated
rows take the course that the stages' operators define for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.llm import language, mixing, near_copies, packing, pii, tokens
from sitegrain.llm.common import Workspace, bucket_of, read_table
from sitegrain.session import ship


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no letter, no text) go; a missing lang is filled in."""
    ship(spark)
    model = language.fit(docs, learn=bucket_of("doc_id", 4) != 2)
    found = language.predict(docs, model, told=("__sg_lang", "__sg_score")).filter(F.col("__sg_lang") != language.NONE)
    return found.select(*[F.coalesce("lang", "__sg_lang").alias("lang") if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near copies (Jaccard similarity of five-word shingles 0.8 or more) the document with the smallest doc_id stays, in one row."""
    return near_copies.keep_one(docs)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in angle brackets; n_chars follows the text."""
    clean = pii.redact(docs)
    return clean.select(*[F.length("text").cast("long").alias("n_chars") if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once or twice."""
    return mixing.repeated(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training windows, with their ids."""
    return packing.pack(docs, tokens.default_path())


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("personal_data", remove_personal_data),
    ("mixture", mix_sources),
    ("packing", pack_windows),
]

#: Hashes, learned models and window packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ship(spark)
    work = Workspace(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
