"""Training-data pipeline: documents in, packed token sequences out.

Each stage takes the documents that the one before it kept, and all but the
last return documents with the columns they came with.

Defined cases: a text that is NULL, empty or without letters has no language and
goes in the first stage; a text of any length is read whole; rows with NULL in
any other column stay, and rows without id are never taken for copies of each
other; rows that repeat an id and text count once from the third stage on; of
a group of near copies the least id stays, of equal ids the least hash of the
text; without labelled rows no document is rejected for its language or its
quality; an empty table stays empty through all stages; further columns are kept
whatever their names, but for the last stage, whose rows are pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.llm.language import UNDETERMINED, train_language_model, with_language
from trendlake.llm.minhash import without_near_duplicates
from trendlake.llm.mixing import mixed
from trendlake.llm.packing import pack
from trendlake.llm.quality import train_quality_model, with_quality
from trendlake.llm.shared import Workspace, free_names

#: A text of which no language reaches this share is rejected.
LEAST_LANGUAGE_SCORE = 0.35
LEAST_QUALITY_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; it learns from the labelled ones among them."""
    model = train_language_model(docs, F.lit(True))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    lang, score = free_names(docs, "_found_lang", "_found_score")
    named = with_language(docs, model, lang, score)
    return named.where((F.col(lang) != UNDETERMINED) & (F.col(score) >= LEAST_LANGUAGE_SCORE)).select(*docs.columns)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts; it learns from ``labels``."""
    model = train_quality_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.lit(True))
    [score] = free_names(docs, "_found_score")
    return with_quality(docs, model, score).where(F.col(score) >= LEAST_QUALITY_SCORE).select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share 80 % of their five-word shingles."""
    return without_near_duplicates(docs, words=5, percent=80, bands=40, rows=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training order with sources at their target weights; a document stands once for each pass through it."""
    return mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in full sequences."""
    return pack(docs)


STAGES = [
    ("language", identify_language),
    ("quality", classify_quality),
    ("near_duplicates", remove_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trained models, signatures and tokenization can't be written in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs = work.table(name, stage(spark, docs, sf_dir))
        if before:
            work.drop(before)
        before = name
    return docs
