import datetime as dt

import pytest
from conftest import PANEL, month_starts
from pyspark.sql import functions as F

from quartermill.operators import features, scaling, splits

SMALL = {"lags": [1, 3], "windows": [3]}


def test_lags_equal_the_earlier_rows(retail):
    rows = features.build_features(retail, **SMALL).orderBy("date").collect()
    assert len(rows) == 19  # the yearly change needs five earlier rows
    for i, r in enumerate(rows, start=5):
        assert r["y_lag_1"] == 5000 + 50 * (i - 1)
        assert r["y_lag_3"] == 5000 + 50 * (i - 3)


def test_rolling_windows_leave_out_the_current_row(retail):
    rows = features.build_features(retail, **SMALL).orderBy("date").collect()
    for i, r in enumerate(rows, start=5):
        assert r["y_roll_mean_3"] == pytest.approx(5000 + 50 * (i - 2))
        assert r["y_roll_std_3"] == pytest.approx(50)


def test_changing_the_current_value_changes_no_feature(spark, retail):
    last = retail.agg(F.max("date")).first()[0]
    changed = retail.withColumn("y", F.when(F.col("date") == last, 1.0).otherwise(F.col("y")))

    def row(df):
        r = features.build_features(df, **SMALL).filter(F.col("date") == last).drop("y").first()
        return tuple(r)

    assert row(retail) == row(changed)


def test_fill_zero_keeps_all_rows_and_unknown_policy_fails(retail):
    assert features.build_features(retail, policy="fill_zero", **SMALL).count() == 24
    with pytest.raises(ValueError):
        features.build_features(retail, policy="guess", **SMALL)


def test_short_series_drops_to_nothing(spark):
    rows = [("a", d, v) for d, v in zip(month_starts(5, dt.date(2023, 1, 1)), [5100.0, 5200.0, 5150.0, 5300.0, 5250.0], strict=True)]
    assert features.build_features(spark.createDataFrame(rows, PANEL), **SMALL).count() == 0


def test_rolling_is_null_when_a_value_in_the_window_is_missing(spark):
    rows = [("a", d, v) for d, v in zip(month_starts(5), [1.0, None, 3.0, 4.0, 5.0], strict=True)]
    out = features.rolling_features(spark.createDataFrame(rows, PANEL), [2]).orderBy("date").collect()
    assert [r["y_roll_mean_2"] for r in out] == [None, None, None, None, 3.5]


def test_missing_columns_and_text_dates_are_refused(spark):
    with pytest.raises(ValueError):
        features.validate_input(spark.createDataFrame([(1.0,)], "y double"))
    with pytest.raises(ValueError):
        features.validate_input(spark.createDataFrame([("2020-01-01",)], "date string"))
    with pytest.raises(ValueError):
        features.validate_input(spark.createDataFrame([("2020-01-01", 1.0)], "date string, y double"))


def test_deflated_lag_and_passthrough_columns(spark, retail):
    df = retail.withColumn("i", (F.months_between("date", F.lit("2022-01-01").cast("date"))).cast("int"))
    df = df.withColumns({"cpi": 100 + 0.3 * F.col("i"), "employment_rate": 67 + 0.05 * F.col("i")})
    rows = features.build_features(df, **SMALL).orderBy("date").collect()
    for i, r in enumerate(rows, start=5):
        assert r["y_real"] == pytest.approx((5000 + 50 * (i - 1)) / ((100 + 0.3 * i) / 100))
        assert r["employment_rate"] == pytest.approx(67 + 0.05 * i)


def test_all_null_cpi_uses_base_one_and_sparse_columns_get_no_lags(retail):
    df = retail.withColumns({"cpi": F.lit(None).cast("double"),
                             "interest_rate_90d": F.when(F.month("date") == 1, 1.0),
                             "unemployment_rate": F.lit(5.0)})
    out = features.build_features(df, **SMALL)
    assert out.filter(F.col("y_real").isNotNull()).count() == 0
    assert "interest_rate_90d_lag1" not in out.columns and "unemployment_rate_lag4" in out.columns


def test_sequences_end_at_their_target_row(retail):
    out = features.make_sequences(features.lag_features(retail, [1]).dropna(), ["y_lag_1"], 4).orderBy("date").collect()
    assert len(out) == 23 - 4 + 1
    assert [r[0] for r in out[0]["sequence"]] == [5000, 5050, 5100, 5150] and out[0]["target"] == 5200


def test_sequence_context_reaches_back_into_training_rows(retail):
    df = splits.holdout_split(retail, 3)
    assert features.sequence_context(df, ["y"], 4).count() == 3


def test_walk_forward_folds_follow_the_expanding_scheme(spark, retail):
    out = splits.walk_forward_folds(retail, 5).collect()
    by_fold = {k: ([r for r in out if r["fold"] == k and r["role"] == "train"],
                   [r for r in out if r["fold"] == k and r["role"] == "val"]) for k in range(1, 6)}
    assert [(len(t), len(v)) for t, v in by_fold.values()] == [(4, 4), (8, 4), (12, 4), (16, 4), (20, 4)]
    assert all(max(r["date"] for r in t) < min(r["date"] for r in v) for t, v in by_fold.values())


def test_scalers_use_training_rows_only_and_handle_constants(spark):
    rows = [("a", i, float(v), 7.0, i >= 3) for i, v in enumerate([1, 2, 3, 100])]
    df = spark.createDataFrame(rows, "series_id string, i int, x double, c double, is_test boolean")
    out = scaling.zscore(df, ["x", "c"], ~F.col("is_test")).orderBy("i").collect()
    assert out[0]["x"] == pytest.approx(-1.224744871) and out[1]["x"] == 0 and all(r["c"] == 0 for r in out)
    flat = scaling.minmax(df, ["x", "c"]).orderBy("i").collect()
    assert flat[3]["x"] == 1 and flat[0]["x"] == 0 and all(r["c"] == 0 for r in flat)


def test_median_is_exact_and_empty_columns_are_dropped(spark):
    rows = [("a", v, None, t) for v, t in [(1.0, False), (2.0, False), (3.0, False), (10.0, False), (None, True)]]
    df = spark.createDataFrame(rows, "series_id string, x double, e double, is_test boolean")
    out = scaling.impute_median(df, ["x", "e"], ~F.col("is_test"))
    assert "e" not in out.columns
    assert out.filter("is_test").first()["x"] == 2.5
