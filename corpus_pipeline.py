"""The corpus pipeline: documents are scored, cleaned, deduplicated, mixed and encoded, each stage on what the last one kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermill.llm import chosen_path, line_rules, mixing, pieces, quality
from quartermill.llm.queries import MIX
from quartermill.session import materialise


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of ``sf_dir``, takes for good ones.

    Null and empty texts are scored like any other and go; repeated rows stay or go together; an empty table
    gives none. Columns beyond those of ``documents`` stay as they are, whatever their names.
    """
    trees = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.good_ones(docs, trees)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep, without their failed lines.

    Null and empty texts go, repeated rows stay or go together, an empty table gives none; other columns stay.
    """
    kept = line_rules.cleaned(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id.

    Texts without words have no copies and stay; repeated rows are copies; a null id yields to any other.
    """
    return chosen_path.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the target mix, a row for each epoch that takes them.

    Null sources and languages are leaves of their own, texts without words cost nothing, ties go by id.
    """
    taken = mixing.select_mix(docs, mixing.count_words("text"), MIX, extra={"domain": F.substring("source", 1, 4)})
    repeated = taken.withColumn("_mix_epoch", F.explode(F.sequence(F.lit(1), F.col("_mix_epochs"))))
    return repeated.select(docs.columns)


def piece_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with digests of the ids and of the text decoded from them; a null text is empty."""
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id", "lang", "source"],
                         outputs=["n_tokens", "ids", "ids_sha256", "decoded_sha256"])


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("piece_codec", piece_codec),
]

#: The classifier and the encoder cannot be written in SQL; the tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
