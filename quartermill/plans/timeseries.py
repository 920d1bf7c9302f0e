"""Named queries: sources, conforming, features, splits, validation and accuracy."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermill.functions import periods
from quartermill.operators import accuracy, aggregates, conform, features, scaling, splits, validate
from quartermill.plans import ctes, inputs  # noqa: F401  (ctes registers the SQL inputs)
from quartermill.plans.catalog import query, r, rounded, with_
from quartermill.session import new_path
from quartermill.sources import release, sdmx, store

# ---- merged table and features ---------------------------------------------------------------


def merged(spark: SparkSession, sf: str) -> DataFrame:
    return conform.merge_exog(inputs.panel(spark, sf), {
        "cpi": conform.quarter_end_rows(inputs.price_index(spark, sf)),
        "unemployment_rate": conform.interpolate_annual(inputs.annual_rate(spark, sf), "unemployment_rate"),
        "interest_rate_90d": conform.resample_quarter_mean(inputs.interest_monthly(spark, sf), "interest_rate_90d"),
        "employment_count": None,
    })


def staged_panel(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.stage(spark, ("panel", sf), partial(inputs.panel, spark, sf))


def staged_merged(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.stage(spark, ("merged", sf), partial(merged, spark, sf))


def featured(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.panel(spark, sf).transform(features.build_features)


def split(spark: SparkSession, sf: str) -> DataFrame:
    return splits.holdout_split(featured(spark, sf), 8)


def naive(spark: SparkSession, sf: str) -> DataFrame:
    """Seasonal naive forecast of the hold-out: the value of the same quarter a year before."""
    return split(spark, sf).filter("is_test").select("series_id", "date", "y", F.col("y_lag_4").alias("y_hat"))


METRICS = {"rmse": 2, "mae": 2, "mape": 6, "da": 6}

FLAGSHIP_SQL = with_("naive_dir", """
SELECT series_id, COUNT(*) AS n, round(sqrt(avg((y - y_hat) * (y - y_hat))), 2) + 0.0 AS rmse,
       round(avg(abs(y - y_hat)), 2) + 0.0 AS mae,
       round(avg(abs(y - y_hat) / (abs(y) + 1e-8)) * 100, 6) + 0.0 AS mape,
       round(avg(same_direction), 6) + 0.0 AS da
FROM naive_dir GROUP BY series_id""")


@query("naive_accuracy", FLAGSHIP_SQL)
def naive_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """Panel, features, hold-out split, seasonal naive forecast, four metrics per series."""
    return rounded(accuracy.evaluate_forecast(naive(spark, sf)), **METRICS)


@query("lag_features", with_("feats", "SELECT series_id, date, y, y_lag_1, y_lag_2, y_lag_4, y_lag_8 FROM feats"))
def lag_features(spark, sf):
    return features.lag_features(inputs.panel(spark, sf))


@query("rolling_features", with_("feats", """
SELECT series_id, date, """ + ", ".join(
    f"round(y_roll_mean_{w}, 5) + 0.0 AS y_roll_mean_{w}, round(y_roll_std_{w}, 2) + 0.0 AS y_roll_std_{w}"
    for w in (2, 4, 8)) + " FROM feats"))
def rolling_features(spark, sf):
    df = features.rolling_features(inputs.panel(spark, sf)).drop("y")
    digits = {f"y_roll_mean_{w}": 5 for w in (2, 4, 8)} | {f"y_roll_std_{w}": 2 for w in (2, 4, 8)}
    return rounded(df, **digits)


@query("yoy_pct", with_("feats", "SELECT series_id, date, round(y_yoy_pct, 6) + 0.0 AS y_yoy_pct FROM feats"))
def yoy_pct(spark, sf):
    return rounded(features.yoy_pct(inputs.panel(spark, sf)).drop("y"), y_yoy_pct=6)


@query("pct_change_12", with_("panel_monthly", """
SELECT series_id, date, round((y / nullif(lag(y, 12) OVER s, 0) - 1) * 100, 6) + 0.0 AS pct_change_12
FROM panel_monthly WINDOW s AS (PARTITION BY series_id ORDER BY date)"""))
def pct_change_12(spark, sf):
    return rounded(features.pct_change_12(inputs.panel(spark, sf, "month")).drop("y"), pct_change_12=6)


@query("cyclical_month", with_("feats", """
SELECT series_id, date, round(month_sin, 6) + 0.0 AS month_sin, round(month_cos, 6) + 0.0 AS month_cos FROM feats"""))
def cyclical_month(spark, sf):
    return rounded(features.cyclical_month(inputs.panel(spark, sf)).drop("y"), month_sin=6, month_cos=6)


@query("cpi_adjust", with_("mfeats", "SELECT series_id, date, round(y_real, 2) + 0.0 AS y_real FROM mfeats"))
def cpi_adjust(spark, sf):
    cpi = conform.quarter_end_rows(inputs.price_index(spark, sf))
    df = conform.merge_exog(inputs.panel(spark, sf), {"cpi": cpi})
    return rounded(features.cpi_adjust(df).select("series_id", "date", "y_real"), y_real=2)


@query("exog_lags", with_("mfeats", """
SELECT series_id, date, round(unemployment_rate_lag1, 6) + 0.0 AS unemployment_rate_lag1,
       round(unemployment_rate_lag4, 6) + 0.0 AS unemployment_rate_lag4, round(interest_rate_90d_lag1, 6) + 0.0 AS interest_rate_90d_lag1,
       round(interest_rate_90d_lag4, 6) + 0.0 AS interest_rate_90d_lag4 FROM mfeats"""))
def exog_lags(spark, sf):
    """The empty employment count falls below the coverage gate."""
    df = features.exog_lags(staged_merged(spark, sf))
    lagged = [c for c in df.columns if "_lag" in c]
    return rounded(df.select("series_id", "date", *lagged), **{c: 6 for c in lagged})


_ENGINEERED = [f"y_lag_{k}" for k in (1, 2, 4, 8)] + [
    f"y_roll_{s}_{w}" for w in (2, 4, 8) for s in ("mean", "std")] + ["y_yoy_pct", "month_sin", "month_cos"]


@query("nan_policy", with_("feats", f"""
SELECT 'drop' AS policy, series_id, COUNT(*) AS n_rows, MIN(date) AS first_date, CAST(0 AS BIGINT) AS n_zero_lags
FROM feats WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _ENGINEERED)} GROUP BY series_id
UNION ALL
SELECT 'fill_zero', series_id, COUNT(*), MIN(date), COUNT(*) FILTER (coalesce(y_lag_8, 0) = 0)
FROM feats GROUP BY series_id"""))
def nan_policy(spark, sf):
    def summary(policy):
        df = staged_panel(spark, sf).transform(partial(features.build_features, policy=policy))
        return df.groupBy(F.lit(policy).alias("policy"), "series_id").agg(
            F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_date"),
            F.count_if(F.col("y_lag_8") == 0).alias("n_zero_lags"))

    return summary("drop").unionByName(summary("fill_zero"))


_EXOG = ["cpi", "unemployment_rate", "interest_rate_90d", "employment_count",
         "unemployment_rate_lag1", "unemployment_rate_lag4", "interest_rate_90d_lag1", "interest_rate_90d_lag4"]
_SUBSETS = {
    "all": _ENGINEERED + ["y_real"] + _EXOG,
    "own": _ENGINEERED + ["y_real"],
    "engineered": _ENGINEERED,
    "exog": _EXOG,
}


@query("feature_subsets", with_("mfeats", " UNION ALL ".join(
    f"SELECT '{s}' AS subset, '{c}' AS feature, COUNT({c}) AS n_valid FROM mfeats WHERE "
    + " AND ".join(f"{e} IS NOT NULL" for e in _ENGINEERED) for s, cols in _SUBSETS.items() for c in cols)))
def feature_subsets(spark, sf):
    df = features.build_features(staged_merged(spark, sf))
    counted = features.coverage(df, features.feature_columns(df)).select(F.col("column").alias("feature"), "n_valid")
    names = [F.struct(F.lit(s).alias("subset"), F.lit(c).alias("feature"))
             for s in ("all", "own", "engineered", "exog") for c in features.feature_columns(df, s)]
    listing = df.sparkSession.range(1).select(F.inline(F.array(*names)))
    return counted.join(listing, "feature").select("subset", "feature", "n_valid")


@query("coverage", with_("merged", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", COUNT(*) AS n_rows, COUNT({c}) AS n_valid,
        round(COUNT({c}) / COUNT(*), 6) AS share, COUNT({c}) / COUNT(*) >= 0.2 AS passes FROM merged"""
    for c in ("cpi", "unemployment_rate", "interest_rate_90d", "employment_count"))))
def coverage(spark, sf):
    df = features.coverage(merged(spark, sf), ["cpi", "unemployment_rate", "interest_rate_90d", "employment_count"])
    return rounded(df.withColumn("passes", F.col("share") >= features.MIN_COVERAGE), share=6)


@query("seasonal_decompose", with_("panel_monthly", """
, t AS (SELECT *, (sum(y) OVER (PARTITION BY series_id ORDER BY date ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)
                   + 0.5 * (lag(y, 6) OVER s + lead(y, 6) OVER s)) / 12 AS trend
        FROM panel_monthly WINDOW s AS (PARTITION BY series_id ORDER BY date)),
m AS (SELECT series_id, month(date) AS mon, avg(y - trend) AS v FROM t GROUP BY 1, 2),
g AS (SELECT series_id, avg(v) AS grand FROM m GROUP BY 1)
SELECT t.series_id, date, y, round(trend, 1) + 0.0 AS trend, round(v - grand, 1) + 0.0 AS seasonal,
       round(y - trend - (v - grand), 1) + 0.0 AS resid
FROM t JOIN m ON t.series_id = m.series_id AND month(date) = mon JOIN g ON t.series_id = g.series_id"""))
def seasonal_decompose(spark, sf):
    monthly = inputs.panel(spark, sf, "month")
    return rounded(features.seasonal_decompose(monthly), trend=1, seasonal=1, resid=1)


_SEQ_FEATURES = ("y_lag_1", "y_lag_4")


def _exploded(sequences: DataFrame) -> DataFrame:
    steps = sequences.select("series_id", "date", "target", F.posexplode("sequence").alias("step", "row"))
    return steps.select("series_id", "date", (F.col("step") + 1).cast("bigint").alias("step"), "target",
                        *[F.col("row")[i].alias(c) for i, c in enumerate(_SEQ_FEATURES)])


_SEQ_SQL = """
, n AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date) AS i FROM split)
SELECT e.series_id, e.date, s.i - e.i + 4 AS step, e.y AS target, s.y_lag_1, s.y_lag_4
FROM n e JOIN n s ON e.series_id = s.series_id AND s.i BETWEEN e.i - 3 AND e.i WHERE e.i >= 4"""


@query("make_sequences", with_("split", _SEQ_SQL))
def make_sequences(spark, sf):
    return _exploded(features.make_sequences(split(spark, sf), _SEQ_FEATURES, 4))


@query("sequence_context", with_("split", _SEQ_SQL + " AND e.is_test"))
def sequence_context(spark, sf):
    return _exploded(features.sequence_context(split(spark, sf), _SEQ_FEATURES, 4))


@query("holdout_split", with_("split", "SELECT series_id, date, y, is_test FROM split"))
def holdout_split(spark, sf):
    return split(spark, sf).select("series_id", "date", "y", "is_test")


FOLDS_SQL = """
, n AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date) - 1 AS i,
               count(*) OVER (PARTITION BY series_id) AS n FROM featured),
folds AS (SELECT *, CASE WHEN i < n - (6 - fold) * (n // 6) THEN 'train' ELSE 'val' END AS role
          FROM n CROSS JOIN (SELECT unnest(range(1, 6)) AS fold)
          WHERE i < n - (6 - fold) * (n // 6) + n // 6)"""


@query("walk_forward_folds", with_("featured", FOLDS_SQL + """
SELECT series_id, date, y, CAST(fold AS INTEGER) AS fold, role FROM folds"""))
def walk_forward_folds(spark, sf):
    return splits.walk_forward_folds(featured(spark, sf), 5).select("series_id", "date", "y", "fold", "role")


# ---- conforming ------------------------------------------------------------------------------


@query("filter_start_date", with_("panel", "SELECT * FROM panel WHERE date >= DATE '1998-01-01'"))
def filter_start_date(spark, sf):
    return conform.filter_start_date(inputs.panel(spark, sf), "1998-01-01")


@query("quarter_end_rows", with_("cpi_quarterly", "SELECT date, round(cpi, 6) AS cpi FROM cpi_quarterly"))
def quarter_end_rows(spark, sf):
    return rounded(conform.quarter_end_rows(inputs.price_index(spark, sf)), cpi=6)


@query("mean_by_date", with_("cpi_regional", "SELECT date, round(avg(cpi), 6) AS cpi FROM cpi_regional GROUP BY date"))
def mean_by_date(spark, sf):
    return rounded(conform.mean_by_date(inputs.price_index_regional(spark, sf), "cpi"), cpi=6)


@query("resample_quarter_mean", with_("interest_quarterly", """
SELECT date, round(interest_rate_90d, 6) AS interest_rate_90d FROM interest_quarterly"""))
def resample_quarter_mean(spark, sf):
    df = conform.resample_quarter_mean(inputs.interest_monthly(spark, sf), "interest_rate_90d")
    return rounded(df, interest_rate_90d=6)


@query("interpolate_annual", with_("unemployment_quarterly", """
SELECT date, round(unemployment_rate, 6) AS unemployment_rate FROM unemployment_quarterly"""))
def interpolate_annual(spark, sf):
    df = conform.interpolate_annual(inputs.annual_rate(spark, sf), "unemployment_rate")
    return rounded(df, unemployment_rate=6)


@query("merge_exog", with_("merged", """
SELECT series_id, date, y, round(cpi, 6) AS cpi, round(unemployment_rate, 6) AS unemployment_rate,
       round(interest_rate_90d, 6) AS interest_rate_90d, employment_count FROM merged"""))
def merge_exog(spark, sf):
    return rounded(merged(spark, sf), cpi=6, unemployment_rate=6, interest_rate_90d=6)


_BRANDS = inputs.BRANDS


@query("pivot_matrix", with_("industry", "SELECT date, " + ", ".join(
    f"""min(value) FILTER (industry = '{b}') AS "{b}" """ for b in _BRANDS) + " FROM industry GROUP BY date"))
def pivot_matrix(spark, sf):
    return conform.pivot_matrix(inputs.industry(spark, sf), _BRANDS)


@query("tail_rows", with_("merged", """
SELECT series_id, date, y, round(cpi, 6) AS cpi FROM merged ORDER BY date DESC, series_id LIMIT 10"""))
def tail_rows(spark, sf):
    last = merged(spark, sf).orderBy(F.desc("date"), "series_id").limit(10)
    return rounded(last.select("series_id", "date", "y", "cpi"), cpi=6)


# ---- sources and sinks -----------------------------------------------------------------------


def long_release(spark: SparkSession, sf: str, label) -> DataFrame:
    """The industry table as a published release: text cells, some unreadable, empty or suppressed."""
    month, number = F.month("date"), F.regexp_extract("industry", r"(\d+)$", 1).cast("int")
    cell = F.when((month == 3) & (number % 5 == 0), F.lit("n/a")).when(
        (month == 6) & (number % 7 == 0), F.lit(None).cast("string")).otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
    hidden = F.when((month == 9) & (number % 3 == 0), F.lit("Y"))
    return inputs.industry(spark, sf).select(
        F.col("industry").alias("Series_reference"), label.alias("Period"),
        cell.alias("Data_value"), hidden.alias("Suppressed"))


def released(spark: SparkSession, sf: str, label) -> DataFrame:
    path = new_path(spark, "release")
    long_release(spark, sf, label).write.option("header", True).csv(path)
    return release.read_release(spark, path)


def _ym():
    return F.date_format("date", "yyyy.MM")


def _ym_or_year():
    return F.when(F.month("date") == 12, F.date_format("date", "yyyy")).otherwise(_ym())


def _ym_or_quarter():
    return F.when(F.month("date") == 6, F.concat(F.date_format("date", "yyyy"), F.lit(" Q2"))).otherwise(_ym())


_RELEASE_SQL = """
, rel AS (SELECT *, CAST(substr(industry, 7) AS INTEGER) AS no, month(date) AS mon FROM industry),
cells AS (SELECT *, NOT (mon = 3 AND no % 5 = 0) AND NOT (mon = 6 AND no % 7 = 0) AS readable,
                 mon = 9 AND no % 3 = 0 AS hidden FROM rel)"""


@query("src_series_csv", with_("industry", _RELEASE_SQL + """
SELECT date, value AS y FROM cells WHERE industry = 'Brand#15' AND readable"""))
def src_series_csv(spark, sf):
    return release.series_rows(released(spark, sf, _ym_or_year()), "Brand#15")


@query("suppressed_filter", with_("industry", _RELEASE_SQL + """
SELECT date, 'Industry ' || no AS industry, value FROM cells
WHERE readable AND NOT hidden AND no <= 15"""))
def suppressed_filter(spark, sf):
    labels = inputs.table(spark, sf, "part").select(F.col("p_brand").alias("series_reference")).distinct()
    number = F.regexp_extract("series_reference", r"(\d+)$", 1).cast("int")
    labels = labels.filter(number <= 15).withColumn("industry", F.concat(F.lit("Industry "), number.cast("string")))
    return release.labelled_rows(released(spark, sf, _ym_or_quarter()), labels)


@query("parse_period_ym", """
SELECT CASE WHEN month(l_shipdate) = 12 THEN strftime(l_shipdate, '%Y') ELSE strftime(l_shipdate, '%Y.%m') END AS period,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS date, COUNT(*) AS n FROM lineitem GROUP BY 1, 2""")
def parse_period_ym(spark, sf):
    day = F.col("l_shipdate")
    text = F.when(F.month(day) == 12, F.date_format(day, "yyyy")).otherwise(F.date_format(day, "yyyy.MM"))
    lines = inputs.table(spark, sf, "lineitem").groupBy(text.alias("period")).agg(F.count(F.lit(1)).alias("n"))
    return lines.withColumn("date", periods.period_year_month(F.col("period")))


@query("parse_period_mixed", """
WITH p AS (SELECT CASE WHEN month(l_shipdate) = 10 THEN strftime(l_shipdate, '%Y') || '.1'
                       WHEN month(l_shipdate) % 3 = 0 THEN strftime(l_shipdate, '%Y') || ' Q' || quarter(l_shipdate)
                       ELSE strftime(l_shipdate, '%Y.%m') END AS period,
                  CAST(date_trunc('month', l_shipdate) AS DATE) AS date FROM lineitem)
SELECT period, date, COUNT(*) AS n FROM p GROUP BY 1, 2""")
def parse_period_mixed(spark, sf):
    day = F.col("l_shipdate")
    text = F.when(F.month(day) == 10, F.concat(F.date_format(day, "yyyy"), F.lit(".1"))).when(
        F.month(day) % 3 == 0, F.concat(F.date_format(day, "yyyy"), F.lit(" Q"), F.quarter(day).cast("string"))
    ).otherwise(F.date_format(day, "yyyy.MM"))
    lines = inputs.table(spark, sf, "lineitem").groupBy(text.alias("period")).agg(F.count(F.lit(1)).alias("n"))
    return lines.withColumn("date", periods.period_mixed(F.col("period")))


@query("src_archive_series", with_("industry", _RELEASE_SQL + """
SELECT 'release-' || year(date) || '.zip' AS path, 'data.csv' AS member, date, value AS y
FROM cells WHERE industry = 'Brand#15' AND readable"""))
def src_archive_series(spark, sf):
    """One archive per year: a member without the series, then one with untidy header names."""
    rows = long_release(spark, sf, _ym()).select(
        F.concat(F.lit("release-"), F.substring("Period", 1, 4)).alias("archive"),
        F.col("Series_reference").alias("note"), F.col("Series_reference").alias(" Series reference "),
        F.col("Period"), F.col("Data_value").alias("DataValue"))
    archives = release.pack_archives(rows, "archive", {
        "notes.csv": ["note", "Period"], "data.csv": [" Series reference ", "Period", "DataValue"]})
    return release.archive_series(archives, "Brand#15")


def sdmx_messages(spark: SparkSession, sf: str) -> DataFrame:
    """``(area, body)``: one message per nation, one series per segment, observations per quarter.

    A message holds the nation's calendar, so its size is bounded by segments x periods.
    """
    df = inputs.panel(spark, sf, wide=True).select(
        F.split("series_id", r"\|")[0].cast("int").alias("area"),
        F.split("series_id", r"\|")[1].alias("segment"),
        F.date_format("date", "yyyy-MM").alias("label"), "y")
    times = df.groupBy("area").agg(F.array_sort(F.collect_set("label")).alias("times"),
                                   F.array_sort(F.collect_set("segment")).alias("segments"))
    placed = df.join(times, "area").select(
        "area", "times", "segments",
        (F.array_position("segments", F.col("segment")) - 1).cast("string").alias("seg"),
        (F.array_position("times", F.col("label")) - 1).cast("string").alias("idx"), "y")
    series = placed.groupBy("area", "times", "segments", "seg").agg(
        F.map_from_entries(F.collect_list(F.struct("idx", F.array("y")))).alias("observations"))
    message = series.groupBy("area", "times", "segments").agg(F.map_from_entries(F.collect_list(
        F.struct(F.concat(F.col("seg"), F.lit(":0:0")), F.struct("observations")))).alias("series"))

    def values(column):
        return F.transform(column, lambda v: F.struct(v.alias("id")))

    dims = F.struct(
        F.array(F.struct(F.lit("TIME").alias("id"), values(F.col("times")).alias("values"))).alias("observation"),
        F.array(F.struct(F.lit("SEGMENT").alias("id"), values(F.col("segments")).alias("values")),
                F.struct(F.lit("UNIT").alias("id"), values(F.array(F.lit("CUR"))).alias("values")),
                F.struct(F.lit("AREA").alias("id"), values(F.array(F.col("area").cast("string"))).alias("values"))
                ).alias("series"))
    body = F.struct(F.struct(F.array(F.struct(dims.alias("dimensions"))).alias("structures"),
                             F.array(F.struct("series")).alias("dataSets")).alias("data"))
    return message.select("area", F.to_json(body).alias("body"))


_AREA = "CAST(split_part(series_id, '|', 1) AS INTEGER) AS area"


@query("src_sdmx_json", with_("panel_wide", f"""
SELECT {_AREA}, (dense_rank() OVER (PARTITION BY split_part(series_id, '|', 1)
       ORDER BY split_part(series_id, '|', 2)) - 1) || ':0:0' AS series_key, date, y FROM panel_wide"""))
def src_sdmx_json(spark, sf):
    return sdmx.observations(sdmx_messages(spark, sf), "y", ["area"])


@query("src_sdmx_keyed", with_("panel_wide", f"""
SELECT {_AREA}, date, y FROM panel_wide WHERE split_part(series_id, '|', 2) = 'MACHINERY'"""))
def src_sdmx_keyed(spark, sf):
    """The series named by its first two dimensions, out of every message."""
    return sdmx.keyed_series(sdmx_messages(spark, sf), ["MACHINERY", "CUR"], "y", ["area"])


@query("src_sdmx_period_totals", with_("panel_wide", f"""
SELECT {_AREA}, date, round(sum(y), 2) AS total FROM panel_wide GROUP BY 1, 2"""))
def src_sdmx_period_totals(spark, sf):
    return rounded(sdmx.period_totals(sdmx_messages(spark, sf), "total", ["area"]), total=2)


@query("src_annual_map", with_("annual", """
SELECT date, unemployment_rate FROM annual"""))
def src_annual_map(spark, sf):
    year, cell = F.year("date"), F.col("unemployment_rate").cast("string")
    years = inputs.annual_rate(spark, sf).agg(F.map_from_entries(
        F.collect_list(F.struct(year.cast("string"), cell))).alias("years"))
    body = F.to_json(F.struct(F.create_map(F.lit("RATE"), F.create_map(F.lit("AREA"), F.col("years"))).alias("values")))
    return sdmx.annual_map(years.select(body.alias("body")), "RATE", "AREA", "unemployment_rate")


@query("cache_parquet", with_("panel", "SELECT * FROM panel"))
def cache_parquet(spark, sf):
    cache = store.ParquetCache(spark, new_path(spark, "cache"))
    cache.get("panel", lambda: inputs.panel(spark, sf))
    return cache.load("panel")


@query("sink_merged", with_("merged", "SELECT series_id, date, y, round(cpi, 6) AS cpi FROM merged"))
def sink_merged(spark, sf):
    path = new_path(spark, "merged")
    store.write_merged(validate.validate(merged(spark, sf), {"y_positive": F.col("y") > 0}), path)
    return rounded(store.read_merged(spark, path).select("series_id", "date", "y", "cpi"), cpi=6)


@query("sink_results_csv", f"""SELECT series_id AS model, n, rmse, mape FROM ({FLAGSHIP_SQL})
UNION ALL SELECT 'mean', NULL, round(avg(rmse), 6), round(avg(mape), 6) FROM ({FLAGSHIP_SQL})""")
def sink_results_csv(spark, sf):
    path = new_path(spark, "results")
    results = naive_accuracy(spark, sf).select(F.col("series_id").alias("model"), "n", "rmse", "mape")
    store.write_results_csv(rounded(store.with_summary(results, ["rmse", "mape"]), rmse=6, mape=6), path)
    return spark.read.option("header", True).schema("model string, n bigint, rmse double, mape double").csv(path)


@query("run_metrics_log", with_("feats", """
, metrics AS (SELECT series_id AS experiment, strftime(date, '%Y') AS run_id, MAX(date) AS start_time,
                  round(avg(abs(y - y_lag_4) / (abs(y) + 1e-8)) * 100, 6) AS value
           FROM feats WHERE y_lag_4 IS NOT NULL GROUP BY 1, 2),
last AS (SELECT * FROM metrics QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC) = 1)
SELECT experiment, run_id, CAST(start_time AS DATE) AS run_date, 'naive' AS model, 'mape' AS metric, value FROM last
UNION ALL SELECT experiment, run_id, CAST(start_time AS DATE), 'naive', 'param:lag', 4.0 FROM last"""))
def run_metrics_log(spark, sf):
    """One run per series and year of the naive forecast; the latest run of each is read back."""
    path = new_path(spark, "runs")
    scored = features.lag_features(staged_panel(spark, sf), [4]).dropna().withColumnRenamed("y_lag_4", "y_hat")
    runs = scored.groupBy(F.col("series_id").alias("experiment"), F.date_format("date", "yyyy").alias("run_id")).agg(
        F.max("date").cast("timestamp").alias("start_time"), accuracy.mape().alias("value"))
    runs = runs.select("experiment", "run_id", "start_time", F.lit("naive").alias("model"),
                       F.lit("mape").alias("metric"), "value")
    runs = store.with_parameters(runs, {"lag": 4})
    store.append_run(runs.filter("run_id < '2000'"), path)
    store.append_run(runs.filter("run_id >= '2000'"), path)
    last = store.latest_run(store.read_runs(spark, path))
    return rounded(last.withColumn("run_date", F.to_date("start_time")).drop("start_time"), value=6)


# ---- validation ------------------------------------------------------------------------------


@query("validate_retail", """
SELECT 'date_known' AS rule, COUNT(*) FILTER (o_orderdate IS NULL) AS n_violations FROM orders
UNION ALL SELECT 'date_not_future', COUNT(*) FILTER (CAST(o_orderdate AS DATE) > DATE '2001-01-01') FROM orders
UNION ALL SELECT 'y_known', COUNT(*) FILTER (o_totalprice IS NULL) FROM orders
UNION ALL SELECT 'y_positive', COUNT(*) FILTER (o_totalprice <= 0) FROM orders
UNION ALL SELECT 'y_plausible', COUNT(*) FILTER (o_totalprice >= 1e9) FROM orders""")
def validate_retail(spark, sf):
    orders = inputs.table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("y"))
    return validate.violations(orders, validate.retail_rules("2001-01-01"))


@query("validate_merged", with_("merged", """
SELECT 'y_positive' AS rule, COUNT(*) FILTER (y IS NULL OR y <= 0) AS n_violations FROM merged
UNION ALL SELECT 'cpi_positive', COUNT(*) FILTER (cpi <= 0) FROM merged
UNION ALL SELECT 'unemployment_in_range', COUNT(*) FILTER (unemployment_rate < 0 OR unemployment_rate >= 30) FROM merged
UNION ALL SELECT 'interest_in_range', COUNT(*) FILTER (interest_rate_90d < 0 OR interest_rate_90d >= 50) FROM merged
UNION ALL SELECT 'employment_positive', COUNT(*) FILTER (employment_count <= 0) FROM merged"""))
def validate_merged(spark, sf):
    return validate.violations(merged(spark, sf), validate.merged_rules())


@query("quarantine", with_("panel", """
SELECT series_id, date, y, y >= 1e9 AS broken FROM panel"""))
def quarantine(spark, sf):
    """Good and bad rows of the anchor told apart instead of failing the whole table."""
    df = validate.quarantine(inputs.panel(spark, sf), validate.retail_rules("2010-01-01"))
    return df.withColumn("broken", F.size("broken_rules") > 0).drop("broken_rules")


@query("validate_feature_input", with_("panel", "SELECT series_id, COUNT(*) AS n FROM panel GROUP BY series_id"))
def validate_feature_input(spark, sf):
    return features.validate_input(inputs.panel(spark, sf)).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"))


# ---- accuracy --------------------------------------------------------------------------------


def _metric_sql(expr: str, name: str, digits: int) -> str:
    return with_("naive", f"SELECT series_id, round({expr}, {digits}) + 0.0 AS {name} FROM naive GROUP BY series_id")


@query("rmse", _metric_sql("sqrt(avg((y - y_hat) ** 2))", "rmse", 2))
def rmse(spark, sf):
    return naive(spark, sf).groupBy("series_id").agg(r(accuracy.rmse(), 2).alias("rmse"))


@query("mae", _metric_sql("avg(abs(y - y_hat))", "mae", 2))
def mae(spark, sf):
    return naive(spark, sf).groupBy("series_id").agg(r(accuracy.mae(), 2).alias("mae"))


@query("mape", _metric_sql("avg(abs((y - y_hat) / (abs(y) + 1e-8))) * 100", "mape", 6))
def mape(spark, sf):
    return naive(spark, sf).groupBy("series_id").agg(r(accuracy.mape(), 6).alias("mape"))


@query("directional_accuracy", with_("naive_dir", """
SELECT series_id, round(avg(same_direction), 6) + 0.0 AS da FROM naive_dir GROUP BY series_id"""))
def directional_accuracy(spark, sf):
    return rounded(accuracy.directional_accuracy(naive(spark, sf)), da=6)


_CHI2 = """round(CASE WHEN q > 300 THEN 0.0 ELSE greatest(0.0, 1 - (SELECT sum(exp(-q / 2 + (k / 2.0 + n) * ln(q / 2)
   - lgamma(k / 2.0 + n + 1))) FROM range(0, 400) t(n))) END, 6) + 0.0"""


@query("ljung_box", with_("feats", f"""
, e AS (SELECT series_id, date, y - y_lag_4 AS resid FROM feats WHERE y_lag_4 IS NOT NULL),
c AS (SELECT series_id, resid - avg(resid) OVER (PARTITION BY series_id) AS e,
             row_number() OVER (PARTITION BY series_id ORDER BY date) AS i FROM e),
m AS (SELECT series_id, count(*) AS n, sum(e * e) AS c0 FROM c GROUP BY 1),
lags AS (SELECT a.series_id, a.i - b.i AS k, sum(a.e * b.e) AS ck FROM c a JOIN c b
         ON a.series_id = b.series_id AND a.i - b.i BETWEEN 1 AND 10 GROUP BY 1, 2),
qs AS (SELECT series_id, k, n * (n + 2) * sum((ck / c0) ** 2 / (n - k))
              OVER (PARTITION BY series_id ORDER BY k) AS q FROM lags JOIN m USING (series_id)),
ps AS (SELECT series_id, CAST(k AS INTEGER) AS lag, round(q, 6) + 0.0 AS q_stat, {_CHI2} AS p_value FROM qs)
SELECT *, min(p_value) OVER (PARTITION BY series_id) < 0.05 AS autocorrelated FROM ps"""))
def ljung_box(spark, sf):
    residuals = features.lag_features(inputs.panel(spark, sf), [4]).select(
        "series_id", "date", (F.col("y") - F.col("y_lag_4")).alias("resid"))
    return rounded(accuracy.ljung_box(residuals), q_stat=6, p_value=6)


@query("cv_rmse", with_("featured", FOLDS_SQL + """
, f AS (SELECT series_id, fold, sqrt(avg((y - y_lag_4) ** 2)) AS rmse FROM folds WHERE role = 'val' GROUP BY 1, 2)
SELECT series_id, round(avg(rmse), 2) AS cv_rmse FROM f GROUP BY 1"""))
def cv_rmse(spark, sf):
    folds = splits.walk_forward_folds(featured(spark, sf), 5).filter("role = 'val'")
    return rounded(accuracy.cv_rmse(folds.withColumn("y_hat", F.col("y_lag_4"))), cv_rmse=2)


def naive_models(spark: SparkSession, sf: str) -> DataFrame:
    """Three simple forecasts of the hold-out in long form, to rank against each other."""
    test = split(spark, sf).filter("is_test")
    return test.unpivot(["series_id", "date", "y"], ["y_lag_1", "y_lag_4", "y_roll_mean_4"], "model", "y_hat")


_MODELS_SQL = """
, preds AS (SELECT series_id, date, y, unnest(['y_lag_1', 'y_lag_4', 'y_roll_mean_4']) AS model,
                   unnest([y_lag_1, y_lag_4, y_roll_mean_4]) AS y_hat FROM split WHERE is_test),
scores AS (SELECT series_id, model, round(sqrt(avg((y - y_hat) ** 2)), 2) AS rmse,
                  round(avg(abs(y - y_hat) / (abs(y) + 1e-8)) * 100, 6) AS mape FROM preds GROUP BY 1, 2)"""


def model_scores(spark: SparkSession, sf: str) -> DataFrame:
    scores = accuracy.evaluate_forecast(naive_models(spark, sf), ["series_id", "model"])
    return rounded(scores.select("series_id", "model", "rmse", "mape"), rmse=2, mape=6)


@query("leaderboard", with_("split", _MODELS_SQL + """
SELECT model, round(avg(rmse), 2) AS rmse, round(avg(mape), 6) AS mape FROM scores GROUP BY model ORDER BY rmse"""))
def leaderboard(spark, sf):
    means = model_scores(spark, sf).groupBy("model").agg(F.avg("rmse").alias("rmse"), F.avg("mape").alias("mape"))
    return accuracy.leaderboard(rounded(means, rmse=2, mape=6))


@query("best_model", with_("split", _MODELS_SQL + """
SELECT series_id, model, mape FROM scores
QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY mape, model) = 1"""))
def best_model(spark, sf):
    return accuracy.best_model(model_scores(spark, sf), keys=["series_id"])


@query("pred_interval_80", with_("naive", """
, m AS (SELECT series_id, sqrt(avg((y - y_hat) ** 2)) AS rmse FROM naive GROUP BY 1)
SELECT series_id, date, round(y_hat, 2) + 0.0 AS y_hat, round(y_hat - coalesce(rmse, y_hat * 0.05) * 1.28, 2) + 0.0 AS lower_80,
       round(y_hat + coalesce(rmse, y_hat * 0.05) * 1.28, 2) + 0.0 AS upper_80
FROM naive LEFT JOIN m USING (series_id)"""))
def pred_interval_80(spark, sf):
    test = naive(spark, sf)
    errors = test.groupBy("series_id").agg(accuracy.rmse().alias("rmse"))
    df = accuracy.prediction_interval(test.join(errors, "series_id", "left"))
    return df.select("series_id", "date", "y_hat", "lower_80", "upper_80")


# ---- scaling and summaries -------------------------------------------------------------------

_SCALED = ("y_lag_1", "y_lag_4", "y_yoy_pct")


@query("zscore", with_("split", "SELECT series_id, date, " + ", ".join(
    f"""round(({c} - avg({c}) FILTER (NOT is_test) OVER s) / CASE WHEN stddev_pop({c}) FILTER (NOT is_test) OVER s = 0
        THEN 1 ELSE stddev_pop({c}) FILTER (NOT is_test) OVER s END, 6) + 0.0 AS {c}""" for c in _SCALED)
    + " FROM split WINDOW s AS (PARTITION BY series_id)"))
def zscore(spark, sf):
    df = split(spark, sf)
    scaled = scaling.zscore(df, _SCALED, ~F.col("is_test"))
    return rounded(scaled.select("series_id", "date", *_SCALED), **{c: 6 for c in _SCALED})


@query("minmax", with_("industry", """
SELECT date, industry, round(coalesce((value - min(value) OVER s) / nullif(max(value) OVER s - min(value) OVER s, 0), 0), 6)
       + 0.0 AS value FROM industry WINDOW s AS (PARTITION BY industry)"""))
def minmax(spark, sf):
    return rounded(scaling.minmax(inputs.industry(spark, sf), ["value"], ["industry"]), value=6)


@query("impute_median", with_("merged", """
, sp AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date DESC) <= 8 AS is_test FROM merged),
gaps AS (SELECT series_id, date, is_test, CASE WHEN month(date) <> 3 THEN cpi END AS cpi, unemployment_rate FROM sp)
SELECT series_id, date, round(coalesce(cpi, median(cpi) FILTER (NOT is_test) OVER s), 6) AS cpi,
       round(coalesce(unemployment_rate, median(unemployment_rate) FILTER (NOT is_test) OVER s), 6) AS unemployment_rate
FROM gaps WINDOW s AS (PARTITION BY series_id)"""))
def impute_median(spark, sf):
    """First quarters have no cpi here; the all-NULL employment count is dropped."""
    df = splits.holdout_split(merged(spark, sf), 8).withColumn("cpi", F.when(F.month("date") != 3, F.col("cpi")))
    columns = ["cpi", "unemployment_rate", "employment_count"]
    out = scaling.impute_median(df.select("series_id", "date", "is_test", *columns), columns, ~F.col("is_test"))
    return rounded(out.drop("is_test"), cpi=6, unemployment_rate=6)


@query("inverse_scale", with_("split", """
SELECT series_id, date, round(y_lag_1, 2) + 0.0 AS y_lag_1 FROM split WHERE is_test"""))
def inverse_scale(spark, sf):
    """Scaling with the training statistics and undoing it gives the values back."""
    df = split(spark, sf).select("series_id", "date", "is_test", "y_lag_1")
    stats = scaling.zscore_stats(df, ["y_lag_1"], ~F.col("is_test"))
    scaled = scaling.apply_zscore(df, stats, ["y_lag_1"]).filter("is_test").drop("is_test")
    return rounded(scaling.inverse_zscore(scaled, stats, {"y_lag_1": "y_lag_1"}), y_lag_1=2)


@query("describe", with_("panel", """
SELECT series_id, count(y) AS n, round(avg(y), 2) AS mean, round(stddev_samp(y), 2) AS std, min(y) AS min,
       round(quantile_cont(y, 0.25), 2) AS q25, round(quantile_cont(y, 0.5), 2) AS q50,
       round(quantile_cont(y, 0.75), 2) AS q75, max(y) AS max FROM panel GROUP BY 1"""))
def describe(spark, sf):
    return aggregates.describe(inputs.panel(spark, sf), "y", ["series_id"])


_CORR = ("y", "cpi", "unemployment_rate")


@query("corr_matrix", with_("merged", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS corr FROM merged" for a in _CORR for b in _CORR)))
def corr_matrix(spark, sf):
    return rounded(aggregates.corr_matrix(merged(spark, sf), _CORR), corr=6)


@query("histogram", """
WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
SELECT CAST(least(floor((value - lo) / (hi - lo) * 50), 49) AS BIGINT) + 1 AS bin, COUNT(*) AS n
FROM events, b GROUP BY 1""")
def histogram(spark, sf):
    return aggregates.histogram(inputs.table(spark, sf, "events"), "value", 50)


