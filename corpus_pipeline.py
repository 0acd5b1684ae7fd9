"""Five stages from documents to token ids; each is one of the operators in ``tidemark.llm``.

language ID -> n-gram Jaccard join (one document of each group stays) -> personal data -> mixing -> SentencePiece.
Every stage but the last returns the columns of ``documents``. Rows are told apart by where they are stored, so
repeated ids do no harm.

Nulls and edge cases, for every stage: a null or empty text has no language and goes at the first stage; long texts are
taken whole; of equal rows the join keeps one; null ids are ids like any other; an empty table stays empty; other columns
of the documents pass through, whatever their names (those that start with an underscore are the operators' own), and
the last stage returns token ids in their place.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, language, mixing, pieces, pii
from tidemark.llm.rows import ADDRESS, addressed, without
from tidemark.plans.bounds import run_dir
from tidemark.streaming.sinks import settings

#: Near duplicates: shingles of five words, similarity of 80 percent or more.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


#: The driver keeps the described plan of a thousand queries; a stage makes dozens, each of many joins. So their text is bounded.
PLAN_TEXT = {"spark.sql.ui.explainMode": "simple", "spark.sql.maxPlanStringLength": "4096"}

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _short_plans(stage: Stage) -> Stage:
    @wraps(stage)
    def run_it(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with settings(spark, PLAN_TEXT):
            return stage(spark, docs, sf_dir)

    return run_it


@_short_plans
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found go on."""
    rows = addressed(docs)
    found = language.identify_documents(rows, extra=ADDRESS)
    return without(rows, found.where(~F.col("kept")))


@_short_plans
def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: one with the smallest id."""
    rows = addressed(docs)
    groups = jaccard.link_groups(rows, SHINGLE_WORDS, SIMILAR_PERCENT, extra=ADDRESS)
    return without(rows, groups.where(~F.col("keep")))


@_short_plans
def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data give way to their kind."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text")).otherwise(F.col("n_chars")).cast("bigint"))


@_short_plans
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = addressed(docs)
    return mixing.apply_mix(rows, mixing.mix(rows, quality=mixing.document_quality(labels), by_text=True))


@_short_plans
def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding them."""
    from public_tokenizers import path

    return pieces.encode_and_read_back(docs, path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", join_near_copies),
    ("personal_data", redact_personal_data),
    ("mix_sources", mix_sources),
    ("sentence_pieces", encode_pieces),
]

#: Trained models and an external tokenizer have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; every stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = run_dir(spark, "corpus")
    for name, stage in STAGES[:-1]:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
