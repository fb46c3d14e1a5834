"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, fill_middle, host_suffixes, mixing, ngram_join, prefix_trie, quality, secret_scan, sharding, token_blocks, toxicity, warc
from .common import read, with_rows


def tokenizer_path() -> str:
    """The public tokenizer's file: TIDEMARK_TOKENIZER, else where the tokenizer package has it."""
    if path := os.environ.get("TIDEMARK_TOKENIZER"):
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.score_documents(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(read(spark, sf_dir, "documents", "doc_id", "text"), 3, 90, 100)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source")
    rows = mixing.mix(docs.withColumn("_row", F.monotonically_increasing_id()), "_row")
    return rows.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(read(spark, sf_dir, "documents", "doc_id", "text"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages", "page_id", "url", "html")
    return warc.archive(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, row = with_rows(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    return chat.recover_turns(turns, row)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))


def op8_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_blocks.token_output(read(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path())


def op9_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(read(spark, sf_dir, "documents", "doc_id", "text"), 40)


def op10_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.find_leaks(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def op11_host_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_suffixes.extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return prefix_trie.prefix_trie(prefix_trie.share_heads(prefix_trie.paths_of(turns), every=20, most=3))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fill_in_middle(read(spark, sf_dir, "documents", "doc_id", "text"), outputs=False)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_ngram_join": op2_ngram_join,
    "op3_mixing": op3_mixing,
    "op4_secrets": op4_secrets,
    "op5_warc": op5_warc,
    "op6_chat": op6_chat,
    "op7_quality": op7_quality,
    "op8_token_blocks": op8_token_blocks,
    "op9_jump_shards": op9_jump_shards,
    "op10_leaks": op10_leaks,
    "op11_host_suffixes": op11_host_suffixes,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_fill_middle": op13_fill_middle,
}
