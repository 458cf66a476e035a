"""Registered queries: each operator on its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmeter.llm import (
    chat, decontaminate, merkle, minhash, mixture, negatives, quality, shards, substrings, tokens, topk, toxicity, urls)
from cabmeter.llm.scratch import cut

URL_RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]
N_SHARDS = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url."""
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation and of the control one (-7)."""
    said = "</s>[INST] ok [/INST]"
    control = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"),
                 F.lit(role).alias("role"), F.lit(said).alias("text"))
        for i, role in enumerate(("user", "assistant"))])).alias("r")).select("r.*")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_digest(chat.format_chats(rows.unionByName(control)))


def sized_rows(docs: DataFrame) -> DataFrame:
    """doc_id and source with the size in bytes (16 more for the row) and the
    checksum of the text, so that the text itself is not shuffled."""
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return docs.select("doc_id", "source", (F.octet_length(data) + 16).cast("long").alias("size"),
                       F.crc32(data).cast("long").alias("text_crc32"))


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards that match the mixture."""
    rows = sized_rows(table(spark, sf_dir, "documents"))
    return shards.stratified_shards(rows, N_SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mixture of all sources takes of every document."""
    docs = table(spark, sf_dir, "documents")
    narrow = cut(docs.select("doc_id", "source", mixture.word_count(F.col("text")).alias("size")), "sizes")
    return mixture.mix_plan(narrow, N_SHARDS).select(
        "doc_id", "size", F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"), F.col("__taken").alias("taken"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items they leak."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows for every vector whose id is divisible by 50."""
    vectors = topk.whole_vectors(table(spark, sf_dir, "embeddings"))
    return topk.exact_top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, by 2-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated windows of 13 words."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document."""
    counts = tokens.count_tokens(table(spark, sf_dir, "documents"), vocabulary_path())
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents, with the proof of every document checked
    after the texts of a third of them were lower-cased."""
    changed = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    return merkle.merkle_manifest(table(spark, sf_dir, "documents"), changed).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five hard negatives for each of the five positives of every anchor
    (vec_id divisible by 100); every seventh label is moved on first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score and toxic spans of every document."""
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_mixing": op2_mixing,
    "op3_chat_format": op3_chat_format,
    "op4_decontaminate": op4_decontaminate,
    "op5_top_k": op5_top_k,
    "op6_shards": op6_shards,
    "op7_near_dedup": op7_near_dedup,
    "op8_substrings": op8_substrings,
    "op9_quality": op9_quality,
    "op10_token_counts": op10_token_counts,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_toxicity": op13_toxicity,
}
