"""SQL twins of the queries, and the pipeline against plain Python."""

import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

import check
import corpus_pipeline
from quartermill.llm import line_rules, quality, queries
from test_group_operators import plain_classes

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql_twin(spark, name):
    _, problems = check.compare(spark, check.connect(SF), SF, name, queries.QUERIES, queries.ORACLES)
    assert not problems


def test_every_operator_has_its_query():
    assert {int(name[2:].split("_")[0]) for name in queries.QUERIES} == set(range(1, 14))


def test_stages_equal_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality_classifier"](spark, docs, SF)
    assert good.columns == docs.columns
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    stayed = {r["doc_id"] for r in good.collect()}
    known = [d for d in (r["doc_id"] for r in docs.collect()) if d in labels]
    assert sum((d in stayed) == bool(labels[d]) for d in known) / len(known) > 0.95

    trees = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert stayed == {r["doc_id"] for r in quality.score(docs, trees).filter("predicted = 1").collect()}

    ruled = {r["doc_id"]: r for r in stages["quality_rules"](spark, docs, SF).collect()}
    for row in docs.collect():
        want = line_rules.clean_text(row["text"], line_rules.LineRules())
        assert (row["doc_id"] in ruled) == want["kept"]
        if want["kept"]:
            assert ruled[row["doc_id"]]["text"] == want["clean_text"] and ruled[row["doc_id"]]["n_chars"] == len(want["clean_text"])

    rows = docs.orderBy("doc_id").collect()
    classes, _ = plain_classes([r["text"] for r in rows])
    one = stages["near_duplicates"](spark, docs, SF)
    assert one.columns == docs.columns
    assert sorted(r["doc_id"] for r in one.collect()) == sorted({rows[c]["doc_id"] for c in classes})

    mixed = stages["source_mix"](spark, docs, SF)
    assert mixed.columns == docs.columns
    epochs = {r["doc_id"]: r["epochs"] for r in queries.op8_source_mix(spark, SF).collect()}
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == epochs


def test_run_feeds_each_stage_with_the_last(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.public_tokenizers.path("piece_bpe_32k.model"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    want = sorted((r["doc_id"], tuple(library.encode(r["text"], add_eos=True))) for r in docs.collect())
    got = sorted((r["doc_id"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want


def test_stages_take_nulls_repeats_and_empty_tables(spark, tmp_path):
    rng = random.Random(1)
    text = " ".join(f"w{rng.randint(0, 999)}." for _ in range(80))
    rows = [(1, text, "en", "src1", len(text)), (1, text, "en", "src1", len(text)), (2, None, None, None, None), (3, "", "en", "src1", 0), (None, text + " more.", "en", None, 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumn("score", F.lit("x"))
    for table in (docs, docs.limit(0)):
        folder = str(tmp_path / f"d{table.count()}")
        spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, folder)
            assert out.count() <= 2 * max(1, table.count())
            assert name == "piece_codec" or out.columns == table.columns
