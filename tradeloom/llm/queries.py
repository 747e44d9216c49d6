"""The registered queries of this subpackage: thin callers with production parameters, and the SQL
that gives the same rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tradeloom.llm import (
    exact_dedup,
    inner_products,
    line_dedup,
    lm,
    mixing,
    near_dedup,
    packing,
    prefix_trie,
    quality,
    secret_scan,
    token_alignment,
    toxicity,
    url_filter,
)
from tradeloom.llm.common import table
from tradeloom.llm.sql import SQL as _SQL

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER, END_ID = "word_bpe_49k.json", 2


def op1_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed to flattened source weights: the whole rows, replicated."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "text", "lang", "n_chars", "n_copies", "copy", "shuffle_key")


def op2_pitman_yor_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of every document; six sevenths of them are learnt from."""
    docs = table(spark, sf_dir, "documents")
    counted = lm.blocks(docs, "doc_id", "text")
    scores = lm.score(lm.fit(counted), counted)
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return scores.withColumnRenamed("id", "doc_id").withColumn("perplexity", perplexity)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table as one batch for a fresh digest index."""
    decided = exact_dedup.decide(table(spark, sf_dir, "documents"))
    return decided.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op4_risk_controlled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document, and the verdict of rules certified on the labels per language."""
    judged = quality.decide(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.withColumnRenamed("id", "doc_id").withColumn("failed", F.array_join("failed", ","))


def op5_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document; the character models learn from what the patterns find."""
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.find(docs, secret_scan.fit(secret_scan.labelled_samples(docs)))
    return found.select(
        F.col("id").alias("doc_id"),
        *[secret_scan.count_kind("base", kind).alias(f"n_{kind}") for kind in secret_scan.KINDS[:3]],
        F.sha2(secret_scan.written("base"), 256).alias("base_sha256"),
        secret_scan.written("spans").alias("spans"),
    )


# The rules of the contract.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op6_url_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict for every page's url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules).withColumnRenamed("id", "page_id")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of every document, learnt from the labels."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.judge(docs, model).withColumnRenamed("id", "doc_id")


def op8_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with a Jaccard similarity of at least 0.85 on 3-word shingles."""
    decided = near_dedup.decide(table(spark, sf_dir, "documents"), width=3, percent=85)
    return decided.select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept"
    )


def op9_template_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of templates that recur in at least five texts, long ones in two."""
    return line_dedup.dedup(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    pieces = packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), END_ID, 4096, with_ids=False
    )
    return pieces.select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        "offset",
        "padded_length",
    )


def op11_norm_sorted_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector with all others."""
    return inner_products.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5, scale=256)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of conversations that start with up to eight turns of every fifth one."""
    ordered = prefix_trie.turns_in_order(table(spark, sf_dir, "conversations"))
    conv = F.col("conv_id")
    paths, convs = prefix_trie.branched(ordered, F.crc32(conv.cast("string")) % 9, conv - conv % 5, most=8)
    return prefix_trie.nodes(paths, convs)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in a byte-level and a sentence-piece vocabulary, aligned."""
    a, b = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_alignment.align(table(spark, sf_dir, "documents"), a, b).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_poisson_mixing,
        op2_pitman_yor_scoring,
        op3_exact_dedup,
        op4_risk_controlled_quality,
        op5_markov_secrets,
        op6_url_range_join,
        op7_toxicity,
        op8_minmax_near_dedup,
        op9_template_line_dedup,
        op10_sum_of_squares_packing,
        op11_norm_sorted_top_k,
        op12_prefix_trie,
        op13_token_alignment,
    )
} | {"pipeline": corpus_pipeline.run}

SQL: dict[str, str] = dict(_SQL) | (
    {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
)
