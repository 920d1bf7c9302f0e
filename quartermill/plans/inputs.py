"""Canonical inputs of the operators, derived by Spark from the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermill.functions.periods import month_label, quarter_label
from quartermill.session import materialise

MONEY = "decimal(18,2)"
# The labels of the industry table, as the pivot needs them: all brands of the parts table.
BRANDS = [f"Brand#{i}" for i in range(1, 26)]

_stages: dict[tuple, DataFrame] = {}


def stage(spark: SparkSession, key: tuple, build: Callable[[], DataFrame]) -> DataFrame:
    """A derived input written once per application and read by every query that needs it."""
    full = (spark.sparkContext.applicationId, *key)
    if full not in _stages:
        _stages[full] = materialise(build(), str(key[0]))
    return _stages[full]


def forget_stages() -> None:
    _stages.clear()


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def money_sum(column: str):
    """Exact sum of a two-decimal amount, so totals do not depend on the order of addition."""
    return F.sum(F.col(column).cast(MONEY)).cast("double")


def panel(spark: SparkSession, sf: str, freq: str = "quarter", wide: bool = False) -> DataFrame:
    """``(series_id, date, y)``: order value per customer segment (or nation and segment) and period.

    One row per series and period, so a series holds at most as many rows as the calendar has
    periods; every per-series window below relies on that bound. Orders are summed per customer
    before they meet the customer table, which also keeps a hot customer from travelling whole.
    """
    label = quarter_label if freq == "quarter" else month_label
    orders = table(spark, sf, "orders")
    per_customer = orders.groupBy(
        "o_custkey", label(F.col("o_orderdate")).alias("date")
    ).agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("amount"))
    series = F.col("c_mktsegment")
    if wide:
        series = F.concat_ws("|", F.col("c_nationkey").cast("string"), series)
    customer = table(spark, sf, "customer").select("c_custkey", series.alias("series_id"))
    return (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("series_id", "date")
        .agg(F.sum("amount").cast("double").alias("y"))
    )


def lineitem_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """One scan of the lines: amounts per supplier region and shipping month (5 x months rows)."""

    def build() -> DataFrame:
        lines = table(spark, sf, "lineitem").groupBy(
            "l_suppkey", month_label(F.col("l_shipdate")).alias("date")
        ).agg(
            F.sum(F.col("l_extendedprice").cast(MONEY)).alias("amount"),
            F.sum(F.col("l_quantity").cast(MONEY)).alias("quantity"),
            F.sum(F.col("l_discount").cast(MONEY)).alias("discount"),
            F.sum((F.col("l_returnflag") == "R").cast("bigint")).alias("returned"),
            F.count(F.lit(1)).alias("lines"),
        )
        region = (
            table(spark, sf, "nation")
            .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", F.col("r_name").alias("region"))
        )
        supplier = (
            table(spark, sf, "supplier")
            .join(region, F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", "region")
        )
        sums = [F.sum(c).alias(c) for c in ("amount", "quantity", "discount", "returned", "lines")]
        return (
            lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy("region", "date")
            .agg(*sums)
        )

    return stage(spark, ("lineitem_monthly", sf), build)


def price_index_regional(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly unit price per region: the stand-in for a regional price index."""
    value = F.col("amount").cast("double") / F.col("quantity").cast("double")
    return lineitem_monthly(spark, sf).select("region", "date", value.alias("cpi"))


def price_index(spark: SparkSession, sf: str) -> DataFrame:
    value = F.sum("amount").cast("double") / F.sum("quantity").cast("double")
    return lineitem_monthly(spark, sf).groupBy("date").agg(value.alias("cpi"))


def annual_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly share of returned lines in percent, placed at 1 July."""
    year = F.year("date")
    share = F.sum("returned").cast("double") * 100 / F.sum("lines").cast("double")
    return (
        lineitem_monthly(spark, sf)
        .groupBy(F.make_date(year, F.lit(7), F.lit(1)).alias("date"))
        .agg(share.alias("unemployment_rate"))
    )


def interest_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly mean discount in percent."""
    rate = F.sum("discount").cast("double") * 100 / F.sum("lines").cast("double")
    return (
        lineitem_monthly(spark, sf)
        .groupBy("date")
        .agg(rate.alias("interest_rate_90d"))
    )


def industry(spark: SparkSession, sf: str) -> DataFrame:
    """Long ``(date, industry, value)``: quarterly line value per part brand."""

    def build() -> DataFrame:
        per_part = table(spark, sf, "lineitem").groupBy(
            "l_partkey", quarter_label(F.col("l_shipdate")).alias("date")
        ).agg(F.sum(F.col("l_extendedprice").cast(MONEY)).alias("amount"))
        part = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("industry"))
        return (
            per_part.join(part, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy("date", "industry")
            .agg(F.sum("amount").cast("double").alias("value"))
        )

    return stage(spark, ("industry", sf), build)


def transactions(spark: SparkSession, sf: str, describe: bool = False) -> DataFrame:
    """Purchase lines ``(invoice, line_no, item_id, quantity, price, user_id, invoice_date, country)``.

    Dimensions come first so that a country filter thins the orders before the lines are shuffled.
    The part table is joined only when the description is asked for.
    """
    place = (
        table(spark, sf, "nation")
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", F.col("r_name").alias("country"))
    )
    customer = (
        table(spark, sf, "customer")
        .join(place, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "country")
    )
    orders = (
        table(spark, sf, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", F.col("o_custkey").alias("user_id"), "country",
                F.to_date("o_orderdate").alias("invoice_date"))
    )
    mark = F.when(F.col("l_returnflag") == "R", F.lit("C")).otherwise(F.lit(""))
    lines = table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    columns = [
        F.concat(mark, F.col("l_orderkey").cast("string")).alias("invoice"),
        F.col("l_linenumber").cast("int").alias("line_no"),
        F.col("l_partkey").cast("string").alias("item_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("user_id"), F.col("invoice_date"), F.col("country"),
    ]
    if describe:
        part = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("description"))
        lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        columns.append(F.col("description"))
    return lines.select(*columns)
