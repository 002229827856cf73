"""The corpus pipeline: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendwise.session import scratch_path

from . import decontamination, language_mixture, ngram_join, piece_codec, secret_ledger
from .queries import tokenizer_path
from .shared import materialise, read_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those of which the languages of the
    table hold no trigram; a kept document without a language gets the one
    predicted.

    An even mixture of languages stays; of a table without any language all
    documents with letters stay and none gets one.  Null and empty texts have
    no letters.  Repeated rows and null ids stay as given, as do all other
    columns, whatever their names; an empty table gives an empty result.
    """
    names, table = language_mixture.learn(docs)
    return language_mixture.keep_identified(docs, names, table, lang_col="lang")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of every group of similar ones: five
    words a shingle, similarity 0.8 or more.

    Null and empty texts, and texts without words, are similar to nothing and
    stay.  Of rows that repeat an id and a text one stays; rows of one id with
    different texts are one document and stay or go together; rows without an
    id stay.  All columns are kept, whatever their names; an empty table gives
    an empty result.
    """
    return ngram_join.keep_one_of_each(docs, ngram_join.JoinParams(width=5, percent=80))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage.

    Each row is judged by its own text: null and empty texts hold nothing and
    stay, repeated rows go or stay together, null ids do not matter.  All
    columns are kept, whatever their names; an empty table gives an empty
    result, and an empty benchmark drops nothing.
    """
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets; keeps every document and its count of characters right.

    Texts are matched by content, so repeated rows and ids and null ids do no
    harm; a null text stays null, and so does its count.  All columns are
    kept, whatever their names; an empty table gives an empty result.
    """
    ledger = secret_ledger.Ledger(spark, scratch_path(spark, "secret_ledger"))
    clean = secret_ledger.redact(docs, ledger)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, the span of every piece in the text's bytes,
    and whether the ids decode to their text (a space mark in a text comes
    back as a space).

    Null and empty texts have no ids.  Repeated rows and null ids come back as
    given; other columns are left behind; an empty table gives an empty
    result.
    """
    rows = piece_codec.encode(docs, tokenizer_path("piece_bpe_32k.model"), decoded=True)
    return rows.select(F.col("id").alias("doc_id"), "n_bytes", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       "begins", "ends", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("secret_scans", redact_secrets),
    ("sentencepiece", encode_pieces),
]


def apply_stages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every stage's result is written as parquet and read by the next."""
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, name)
    return docs
