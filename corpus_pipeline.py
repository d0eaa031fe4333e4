"""From raw documents to packed training sequences: the stages and their order.

Each stage takes (spark, docs, sf_dir) and returns the documents that its decisions leave; the last returns the pieces
of the packed sequences. Columns beyond those of ``documents`` are carried along. Nulls in any column, empty and very
long texts, repeated rows and an empty table go through every stage; each stage says what becomes of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalfold.llm.components import stored
from signalfold.llm.filters import without
from signalfold.llm.langid import UNKNOWN, language_column, learn_profiles
from signalfold.llm.mixing import mixed_documents
from signalfold.llm.ngram_join import Jaccard, ngram_jaccard_join
from signalfold.llm.packing import pack_documents
from signalfold.llm.ship import ship, text_batches
from signalfold.llm.substring_dedup import substring_dedup

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language stay; those without a letter (null and empty texts too) go.

    Profiles are learned from the documents' own labels. Where none has a label, nothing can be recognised, and every
    document with a letter stays.
    Each row is judged by its own text.
    """
    text_batches(spark)
    profiles = learn_profiles(docs)
    if not profiles.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    told = docs.select(F.struct(*docs.columns).alias("_row"), language_column(F.col("text"), profiles).alias("_told"))
    return told.where(F.col("_told.lang_pred") != UNKNOWN).select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id.

    Documents without words are copies of nothing and stay, as do those without an id. Of rows that repeat an id,
    all stay or none.
    """
    text_batches(spark)
    groups = ngram_jaccard_join(docs, Jaccard(n=5, num=80, den=100))
    copies = groups.where("component_id <> doc_id").select("doc_id").distinct()
    return without(docs, "doc_id", copies)


def long_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document has are cut out; a text without any stays as it is.

    A document that had words and has none left goes. n_chars follows the text.
    """
    text_batches(spark)
    # the text is moved once, beside the other columns
    rest = [F.col(c) for c in docs.columns if c != "text"]
    row = F.struct(*rest, F.col("text").isNull().alias("_null")).alias("_row")
    told = substring_dedup(docs.select(row, "doc_id", "text"), row_col="_row")
    changed = F.col("n_removed") > 0
    new = {"text": F.when(~F.col("_row._null"), F.col("kept_text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_row.n_chars"))
    left = told.where(~changed | (F.col("n_removed") < F.col("n_words")))
    return left.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by weight: a document the mix takes twice is there twice, one that it takes in part has that
    part's words, and one that it leaves out, or without words, is gone. n_chars follows the text."""
    text_batches(spark)
    mixed = mixed_documents(docs)
    if "n_chars" not in docs.columns:
        return mixed
    return mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of 2048; every row is a document, null texts are empty ones."""
    text_batches(spark)
    return pack_documents(docs, TOKENIZER)


STAGES = [
    ("language ID", languages),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", long_repeats),
    ("mixing sources to target weights", mixture),
    ("packing", sequences),
]

# the stages learn models and choose by seed, which SQL does not express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
