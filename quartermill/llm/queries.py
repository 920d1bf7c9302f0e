"""Registered queries of the training-data operators, over the whole given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from quartermill.llm import chosen_path, kmeans_tree, lexical, line_rules, mixing, pieces, preferences, prefix_tokens, prefix_trie, quality, tag_paths, token_files, warc
from quartermill.llm.common import table
from quartermill.session import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_quality_trees")
def op1_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    trees = quality.train(documents, table(spark, sf_dir, "labels"))
    scored = quality.score(documents, trees, keep=["doc_id"])
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@query("op2_piece_codec")
def op2_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"],
        outputs=["n_tokens", "ids_sha256", "decoded_sha256", "span_bytes"],
    )


@query("op3_line_rules", line_rules.sql())
def op3_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.clean(
        table(spark, sf_dir, "documents"), keep=["doc_id"],
        outputs=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                 "n_failed_lines", "lost_chars"],
    )


@query("op4_tag_paths")
def op4_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_paths.extract(table(spark, sf_dir, "pages"))


@query("op5_chosen_path", chosen_path.sql())
def op5_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


@query("op6_warc_salvage", warc.SQL)
def op6_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"), new_path(spark, "archive"))


@query("op7_kmeans_tree")
def op7_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, neighbours=10)


#: The first four letters of a source stand in for its domain; two domains and one language weigh more.
MIX = mixing.Mix(weights={("src0",): 2, ("src1",): 4, ("src1", "en"): 3, ("src2", "de"): 2})


@query("op8_source_mix", mixing.sql(MIX, ["left(source, 4)", "lang", "source"]))
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    domain = F.substring("source", 1, 4)
    taken = mixing.select_mix(table(spark, sf_dir, "documents"), mixing.count_words("text"), MIX, extra={"domain": domain})
    return taken.select("doc_id", domain.alias("domain"), "lang", "source", F.col("_mix_epochs").alias("epochs"))


@query("op9_prefix_tokens")
def op9_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tokens.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024, keep=["doc_id"],
    )


@query("op10_preferences", preferences.SQL)
def op10_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen, rejected = preferences.diverging_pairs(table(spark, sf_dir, "conversations"))
    pairs = preferences.format_preferences(chosen, rejected)
    return pairs.withColumns({c: preferences.spans_text(c) for c in ("chosen_spans", "rejected_spans")})


@query("op11_block_max", lexical.SQL)
def op11_block_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


@query("op12_prefix_trie", prefix_trie.SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.family_trie(table(spark, sf_dir, "conversations"))


@query("op13_token_files")
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return token_files.round_trip(documents, public_tokenizers.path("word_bpe_49k.json"), new_path(spark, "token-ids"), end_id=2)
