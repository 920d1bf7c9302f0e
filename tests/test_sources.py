import datetime as dt
import json
import zipfile

import pytest
from conftest import PANEL, month_starts
from pyspark.sql import functions as F

from quartermill.functions import periods
from quartermill.operators import conform, validate
from quartermill.sources import release, sdmx, store
from quartermill.sources import transactions as sheets


def message(values, series, dims=()):
    return json.dumps({"data": {
        "structures": [{"dimensions": {
            "observation": [{"id": "TIME", "values": [{"id": v} for v in values]}],
            "series": [{"id": f"D{i}", "values": [{"id": v} for v in d]} for i, d in enumerate(dims)]}}],
        "dataSets": [{"series": series}]}})


def messages(spark, *bodies):
    return spark.createDataFrame([(b,) for b in bodies], "body string")


MONTHS = [f"2023-0{m}" for m in range(1, 7)]


def test_message_gives_one_row_per_observation(spark):
    body = message(MONTHS, {"0:0:0": {"observations": {str(i): [5000 + 100 * i] for i in range(6)}}})
    out = sdmx.observations(messages(spark, body), "y").orderBy("date").collect()
    assert [r["date"].month for r in out] == [1, 2, 3, 4, 5, 6] and {r["date"].year for r in out} == {2023}
    assert [r["y"] for r in out] == [5000 + 100 * i for i in range(6)]


def test_message_skips_unknown_times_and_empty_cells(spark):
    body = message(MONTHS[:2], {"0": {"observations": {"0": [1.5], "1": [None], "2": [9.0], "7": []}}})
    assert [r["y"] for r in sdmx.observations(messages(spark, body), "y").collect()] == [1.5]


def test_empty_message_and_malformed_message_are_errors(spark):
    for body in (message([], {}), message(MONTHS, {"0": {"observations": {}}})):
        with pytest.raises(Exception, match="no observations"):
            sdmx.observations(messages(spark, body), "y").collect()
        with pytest.raises(Exception, match="no observations"):
            sdmx.period_totals(messages(spark, body), "y").collect()
    with pytest.raises(Exception, match="unexpected message structure"):
        sdmx.observations(messages(spark, '{"error": "nope"}'), "y").collect()


def test_keyed_series_is_found_by_its_dimension_values(spark):
    dims = [["A1", "A2"], ["M", "Q"], ["RATE"], ["PCT"], ["X"]]
    body = message(MONTHS, {"1:0:0:0:0": {"observations": {"2": [4.5], "3": [4.75]}},
                            "0:0:0:0:0": {"observations": {"2": [1.0]}}}, dims)
    out = sdmx.keyed_series(messages(spark, body), ["A2", "M", "RATE", "PCT"], "rate").orderBy("date").collect()
    assert [(r["date"].month, r["rate"]) for r in out] == [(3, 4.5), (4, 4.75)]
    with pytest.raises(Exception, match="no value 'A9'"):
        sdmx.keyed_series(messages(spark, body), ["A9"], "rate").collect()


def test_period_totals_add_all_series(spark):
    body = message(MONTHS, {"0": {"observations": {"0": [1], "1": [2]}}, "1": {"observations": {"0": [10]}}})
    out = {r["date"].month: r["n"] for r in sdmx.period_totals(messages(spark, body), "n").collect()}
    assert out == {1: 11.0, 2: 2.0}


def test_annual_map_skips_nulls_and_interpolates_over_missing_years(spark):
    body = json.dumps({"values": {"RATE": {"AREA": {"2000": 6.0, "2001": None, "2003": 12.0, "20xx": 1.0, "2002": "n/a"}}}})
    annual = sdmx.annual_map(messages(spark, body), "RATE", "AREA", "rate")
    assert [(r["date"], r["rate"]) for r in annual.orderBy("date").collect()] == [
        (dt.date(2000, 7, 1), 6.0), (dt.date(2003, 7, 1), 12.0)]
    out = conform.interpolate_annual(annual, "rate").orderBy("date").collect()
    assert out[0]["date"] == dt.date(2000, 9, 1) and out[0]["rate"] == pytest.approx(6.0 + 6 / 36)
    assert out[-1]["date"] == dt.date(2003, 9, 1) and out[-1]["rate"] == 12.0
    assert len(out) == 13


def test_period_texts(spark):
    df = spark.createDataFrame([("1995.09",), ("1995",), ("1995.1",), ("2023 Q3",), ("junk",), (None,), ("1995.13",)], "p string")
    out = [(r["p"], r["a"], r["b"]) for r in df.select(
        "p", periods.period_year_month(F.col("p")).alias("a"), periods.period_mixed(F.col("p")).alias("b")).collect()]
    assert out == [
        ("1995.09", dt.date(1995, 9, 1), dt.date(1995, 9, 1)), ("1995", dt.date(1995, 12, 1), None),
        ("1995.1", dt.date(1995, 1, 1), dt.date(1995, 10, 1)), ("2023 Q3", None, dt.date(2023, 9, 1)),
        ("junk", None, None), (None, None, None), ("1995.13", None, None)]


def test_release_csv(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        "Series_reference,Period,Data_value,Suppressed,UNITS\n"
        "A1,2020.06,11.5,,x\nA1,2020.03,10,,x\nA1,2020.09,n/a,,x\nA1,2020.12,,,x\nB1,2020 Q1,5,Y,x\nB1,2020 Q2,7,,x\n")
    df = release.read_release(spark, str(tmp_path / "r.csv"))
    assert [(r["date"].month, r["y"]) for r in release.series_rows(df, "A1").orderBy("date").collect()] == [(3, 10.0), (6, 11.5)]
    with pytest.raises(ValueError, match="Z9"):
        release.series_rows(df, "Z9")
    labels = spark.createDataFrame([("B1", "Books")], "series_reference string, industry string")
    assert [tuple(r) for r in release.labelled_rows(df, labels).collect()] == [(dt.date(2020, 6, 1), "Books", 7.0)]


def test_archive_takes_the_first_member_with_the_series(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("notes.csv", "title\nnothing\n")
        z.writestr("readme.txt", "S1,2020.03,99\n")
        z.writestr("one.csv", " Series reference ,Period,DataValue\nS1 ,2020.06,2\n S1,2020.03,1\nS2,2020.03,5\n S1,2020.09,..\n")
        z.writestr("two.csv", "Series_reference,Period,Data_value\nS1,2020.03,77\n")
    out = release.archive_series(release.read_archives(spark, str(tmp_path / "*.zip")), "S1").orderBy("date").collect()
    assert [(r["member"], r["date"].month, r["y"]) for r in out] == [("one.csv", 3, 1.0), ("one.csv", 6, 2.0)]


def test_cache_round_trip_miss_and_refetch(spark, tmp_path, retail):
    cache = store.ParquetCache(spark, str(tmp_path / "cache"))
    assert cache.load("absent") is None
    calls = []

    def fetch():
        calls.append(1)
        return retail

    first, second = cache.get("retail", fetch), cache.get("retail", fetch)
    assert calls == [1] and first.schema == second.schema and second.dtypes == retail.dtypes
    assert sorted(map(tuple, second.collect())) == sorted(map(tuple, retail.collect()))
    (tmp_path / "cache" / "broken").mkdir()
    (tmp_path / "cache" / "broken" / "part-0.parquet").write_bytes(b"not parquet")
    assert cache.load("broken") is None


def test_merged_sink_and_run_table(spark, tmp_path, retail):
    path = str(tmp_path / "merged")
    store.write_merged(retail, path, buckets=4)
    assert store.read_merged(spark, path).count() == 24
    runs = [("e", "r1", dt.datetime(2024, 1, 1), "m", "rmse", 1.0), ("e", "r2", dt.datetime(2024, 2, 1), "m", "rmse", 2.0),
            ("f", "r3", dt.datetime(2023, 1, 1), "m", "rmse", 3.0)]
    for r in runs:
        store.append_run(spark.createDataFrame([r], store.RUN_SCHEMA), str(tmp_path / "runs"))
    latest = store.latest_run(store.read_runs(spark, str(tmp_path / "runs"))).collect()
    assert {(r["experiment"], r["run_id"]) for r in latest} == {("e", "r2"), ("f", "r3")}


def test_sheets_keep_duplicates_and_make_ids_text(spark):
    columns = "`Invoice` {0}, `StockCode` {0}, `Description` string, `Quantity` int, `InvoiceDate` timestamp, `Price` double, `Customer ID` double, `Country` string"
    day = dt.datetime(2010, 1, 1)
    old = spark.createDataFrame([(1, 22, "x", 1, day, 1.0, 7.0, "UK")] * 2, columns.format("bigint"))
    new = spark.createDataFrame([("C1", "22A", None, 1, day, 1.0, None, "UK")], columns.format("string"))
    out = sheets.read_sheets(old, new)
    assert out.count() == 3 and dict(out.dtypes)["item_id"] == "string" and dict(out.dtypes)["user_id"] == "bigint"


def test_merge_refuses_a_repeated_key_and_fills_missing_sources(spark, retail):
    one = retail.select("date", F.lit(1.0).alias("cpi"))
    out = conform.merge_exog(retail, {"cpi": one, "employment_count": None})
    assert out.count() == 24 and out.filter("employment_count IS NOT NULL").count() == 0
    with pytest.raises(Exception, match="more than one row per date"):
        conform.merge_exog(retail, {"cpi": one.unionByName(one)}).collect()


@pytest.mark.parametrize("date, y, rule", [
    ("2022-01-01", "-100", "y_positive"), ("2022-01-01", "0", "y_positive"), ("2099-01-01", "10", "date_not_future"),
    ("2022-01-01", "2e9", "y_plausible"), ("soon", "10", "date_known"), ("2022-01-01", "many", "y_known")])
def test_each_violation_is_named(spark, date, y, rule):
    df = spark.createDataFrame([(date, y), ("2022-02-01", "5")], "date string, y string")
    rules = validate.retail_rules("2024-01-01")
    coerced = validate.coerce_panel(df)
    assert {r["rule"] for r in validate.violations(coerced, rules).filter("n_violations > 0").collect()} == {rule}
    with pytest.raises(ValueError, match=rule):
        validate.validate(coerced, rules)
    assert validate.quarantine(coerced, rules).filter(F.size("broken_rules") > 0).count() == 1


def test_text_dates_are_coerced(spark, retail):
    text = retail.select("series_id", F.col("date").cast("string"), F.col("y").cast("string"))
    good = validate.validate(validate.coerce_panel(text), validate.retail_rules("2025-01-01"))
    assert good.schema["date"].dataType.simpleString() == "date" and good.count() == 24


def test_quarter_mean_labels_the_last_month_and_keeps_partial_quarters(spark):
    rows = [("a", d, float(i)) for i, d in enumerate(month_starts(4, dt.date(2023, 2, 1)))]
    out = conform.resample_quarter_mean(spark.createDataFrame(rows, PANEL), "y").orderBy("date").collect()
    assert [(r["date"], r["y"]) for r in out] == [(dt.date(2023, 3, 1), 0.5), (dt.date(2023, 6, 1), 2.5)]


def test_pivot_needs_enough_columns(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), "a", 1.0)], "date date, industry string, value double")
    with pytest.raises(ValueError):
        conform.pivot_matrix(df, ["a", "b"])


def test_archive_skips_a_damaged_member_and_misses_a_series_aloud(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("bad.csv", "Series_reference,Period,Data_value\n" + "S1,2020.03,1\n" * 500)
        z.writestr("good.csv", "Series_reference,Period,Data_value\nS1,2020.06,2\n")
    raw = bytearray((tmp_path / "a.zip").read_bytes())
    raw[40:50] = b"\xff" * 10  # inside the packed data of the first member
    (tmp_path / "a.zip").write_bytes(bytes(raw))
    archives = release.read_archives(spark, str(tmp_path / "a.zip"))
    assert [(r["member"], r["y"]) for r in release.archive_series(archives, "S1").collect()] == [("good.csv", 2.0)]
    with pytest.raises(Exception, match="series 'S9' not found"):
        release.archive_series(archives, "S9").collect()
    assert release.archive_series(archives, "S9", required=False).count() == 0


def test_cache_fetches_again_when_a_data_file_is_damaged(spark, tmp_path, retail):
    cache = store.ParquetCache(spark, str(tmp_path / "cache"))
    cache.get("retail", lambda: retail.repartition(1))
    part = next((tmp_path / "cache" / "retail").glob("part-*.parquet"))
    raw = bytearray(part.read_bytes())
    raw[8:200] = b"\x00" * 192  # pages are gone, the footer still stands
    part.write_bytes(bytes(raw))
    for crc in (tmp_path / "cache" / "retail").glob(".part-*.crc"):
        crc.write_bytes(b"")
    assert cache.load("retail") is None
    assert cache.get("retail", lambda: retail).count() == 24
