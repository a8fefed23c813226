"""The corpus pipeline: language, quality, repeated lines, near duplicates, packing. Part of the corpus operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.llm import langid, lines, ngramjoin, packing, quality
from tabkit.session import store

LEAST_SCORE = 0.5
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
SEQUENCE, END_ID = 4096, 1


def _aside(docs: DataFrame, taken: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    """``docs`` with own columns of a stage's working names under other names, and all names as they then are.

    ``select(*names).toDF(*docs.columns)`` gives the columns back, so that no stage replaces a column of its input.
    """
    names, held = [], {c.lower() for c in docs.columns} | set(taken)
    for c in docs.columns:
        new = c
        while new.lower() in held and c.lower() in taken:
            new = f"own_{new}"
        held.add(new.lower())
        names.append(new)
    return docs.toDF(*names), names


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have no letters or no language of at least ``LEAST_SCORE``."""
    rows, names = _aside(docs, ("_pred", "_score"))
    judged = langid.predict_languages(rows, langid.fit_languages(rows), pred="_pred", score="_score")
    kept = judged.filter((F.col("_pred") != langid.UNDECIDED) & (F.col("_score") >= LEAST_SCORE))
    return kept.select(*names).toDF(*docs.columns)


def check_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that fail the base rules or lie outside the fences of their language and source."""
    rows, names = _aside(docs, ("n_words", "base_failed", "kept", *quality.SCORED))
    return quality.judge_quality(rows).filter("kept").select(*names).toDF(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without later occurrences of three lines; ``n_chars``, where there is one, follows the text that is left."""
    rows, names = _aside(docs, ("n_lines", "n_removed"))
    cut = lines.dedup_lines(rows)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long"))
    return cut.select(*names).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of least id, of each component of near duplicates."""
    return ngramjoin.one_of_each(docs, ngramjoin.link_documents(docs, SHINGLE_WORDS, SIMILAR_PERCENT))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), SEQUENCE, END_ID)


STAGES = [
    ("language ID", identify_language),
    ("quality rules", check_quality),
    ("line dedup", drop_repeated_lines),
    ("near duplicates", drop_near_duplicates),
    ("packing", pack),
]

#: The language model is learned, which SQL cannot express; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
