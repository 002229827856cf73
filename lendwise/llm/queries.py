"""The operators' queries over the given tables, by their contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lendwise.session import scratch_path

from . import (conversation_repair, decontamination, divergence, language_mixture, ngram_join, piece_codec, pivot_clusters, quality_trees,
               secret_ledger, sharding, token_counts, token_files, warc)
from .oracle import ORACLE
from .shared import read_table

__all__ = ["ORACLE", "QUERIES"]

# Production size of a shard is set by the job; the registered query uses a
# limit at which its tables make many shards.
SHARD_BYTES = 1 << 20
MAX_TOKENS = 1024


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer files are installed; never copied here."""
    import public_tokenizers
    return public_tokenizers.path(name)


def id_remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False))
    names, table = language_mixture.learn(docs.where(id_remainder("doc_id", 3) != 1))
    rows = language_mixture.identify(docs, names, table).withColumnRenamed("id", "doc_id")
    return rows.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", F.size("languages").alias("n_languages"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False))
    model = quality_trees.fit(docs, labels.where(id_remainder("doc_id", 5) != 0))
    rows = quality_trees.classify(docs, model).withColumnRenamed("id", "doc_id")
    return rows.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_counts.token_counts(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                     MAX_TOKENS)
    return rows.withColumnRenamed("id", "doc_id")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = divergence.quality_rules(read_table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "base_failed", "kept")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = piece_codec.encode(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), decoded=True)
    return rows.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"),
                       spans_cover("begins", "ends", "n_bytes").alias("spans_cover"))


def spans_cover(begins: str, ends: str, n_bytes: str) -> Column:
    """Whether the pieces' spans run through the whole text."""
    last = F.coalesce(F.get(ends, F.size(ends) - 1), F.lit(0))
    return (F.coalesce(F.get(begins, F.lit(0)), F.lit(0)) == 0) & (last == F.col(n_bytes))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.assign_shards(read_table(spark, sf_dir, "documents"), SHARD_BYTES)
    return rows.select(F.col("id").alias("doc_id"), "n_bytes", "shard", "page", "shard_bytes", "shard_rows")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_pages(read_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return records.select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
                          "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ngram_join.similar_documents(read_table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_passages(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "start", "end", "edits")


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = secret_ledger.Ledger(spark, scratch_path(spark, "secret_ledger"))
    rows = secret_ledger.scan(read_table(spark, sf_dir, "documents"), ledger, "doc_id", None)
    kinds = [r.kind for r in secret_ledger.RULES if r.base]
    base = F.filter("findings", lambda f: f["kind"].isin(kinds))
    count = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")
    return rows.select(F.col("path").alias("doc_id"), *[count(k).alias(f"n_{k}") for k in kinds],
                       F.sha2(secret_ledger.joined(base), 256).alias("base_sha256"),
                       secret_ledger.joined(F.col("findings")).alias("spans"))


def damaged_conversations(rows: DataFrame) -> DataFrame:
    """The contract's damage; null cells are one space."""
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", cell("conv_id"), cell("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", cell("role").alias("role"), cell("text").alias("text"), kind.alias("kind")).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations")
    repaired = conversation_repair.repair(damaged_conversations(rows))
    found = repaired.conversations
    joined = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")
    found = found.withColumn("repaired_sha256", F.sha2(joined, 256))
    if repaired.long_messages is not None:
        long = conversation_repair.long_digests(repaired.long_messages)
        found = found.join(long, found["conv"].eqNullSafe(long["name"]), "left").withColumn(
            "repaired_sha256", F.coalesce("repaired_sha256", "sha256"))
    every = rows.select("conv_id").distinct()
    all_ = every.join(found, every["conv_id"].eqNullSafe(found["conv"]), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return all_.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_files")
    token_files.write_token_files(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), path)
    return token_files.read_documents(spark, path).withColumnRenamed("id", "doc_id")


def op13_pivot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, centroids = pivot_clusters.cluster(read_table(spark, sf_dir, "embeddings"))
    return pivot_clusters.with_inertia(rows, centroids).withColumnRenamed("id", "vec_id")


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_token_counts, op3_quality_rules, op4_sentencepiece, op5_sharding, op6_warc, op7_ngram_join,
    op8_decontamination, op9_secret_scans,
    op10_quality_classifier, op11_conversation_repair, op12_token_files, op13_pivot_clusters)}
