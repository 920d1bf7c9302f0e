"""Every registered query with a SQL twin against DuckDB, on whole tables."""

import re

import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.01"
ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql_twin(spark, con, name):
    _, problems = check.compare(spark, con, SF, name, QUERIES, ORACLES)
    assert not problems


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_gives_one_row_per_series(spark):
    df = entry.entry(spark)
    assert df.columns == ["series_id", "n", "rmse", "mae", "mape", "da"] and df.count() == 5


def plan(df):
    return df._jdf.queryExecution().toString()


def test_scans_read_only_the_needed_columns(spark):
    text = plan(QUERIES["filter_start_date"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert {c.split(":")[0] for s in schemas for c in s.split(",")} == {
        "o_custkey", "o_totalprice", "o_orderdate", "c_custkey", "c_mktsegment"}


def test_country_filter_reaches_the_scan(spark):
    text = plan(QUERIES["log_weight"](spark, SF))
    assert "EqualTo(r_name,ASIA)" in text and "p_name" not in text


@pytest.mark.parametrize("name", ["evaluate_all", "rec_popularity", "tfidf", "bm25_weights", "density_stats", "histogram",
                                  "rec_content", "naive_accuracy", "merge_exog"])
def test_no_cross_join_is_planned(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_term_counts_are_shuffled_once(spark):
    df = QUERIES["tfidf"](spark, SF)
    df.collect()
    assert "ReusedExchange" in plan(df) or plan(df).count("regexp_extract_all") <= 2
