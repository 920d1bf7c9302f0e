"""Nested JSON statistics messages, one message per row in the column ``body``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermill.functions.periods import first_of_month

_DIMENSION = "array<struct<id: string, values: array<struct<id: string>>>>"
MESSAGE_SCHEMA = (
    "data struct<"
    f"structures: array<struct<dimensions: struct<observation: {_DIMENSION}, series: {_DIMENSION}>>>,"
    "dataSets: array<struct<series: map<string, struct<observations: map<string, array<double>>>>>>>"
)
ANNUAL_SCHEMA = "values map<string, map<string, map<string, string>>>"


def label_date(label: Column) -> Column:
    """``YYYY``, ``YYYY-MM``, ``YYYY-Qn`` or ``YYYY-MM-DD`` to the first day of the period."""
    year = F.regexp_extract(label, r"^(\d{4})", 1).try_cast("int")
    quarter = F.regexp_extract(label, r"^\d{4}-?Q([1-4])$", 1).try_cast("int")
    month = F.regexp_extract(label, r"^\d{4}-(\d{2})$", 1).try_cast("int")
    full = F.try_to_timestamp(label, F.lit("yyyy-MM-dd")).cast("date")
    bare = F.when(label.rlike(r"^\d{4}$"), F.lit(1))
    return F.coalesce(full, first_of_month(year, F.coalesce(month, quarter * 3 - 2, bare)))


def _parsed(messages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys, data sets, first structure; a message without these parts or without observations fails the job."""
    parsed = messages.select(*keys, F.from_json("body", MESSAGE_SCHEMA).alias("m"))
    structure = F.get(F.col("m.data.structures"), F.lit(0))
    sets = F.col("m.data.dataSets")
    valid = structure.isNotNull() & sets.isNotNull()
    broken = F.raise_error(F.lit("unexpected message structure: no data, structures or dataSets"))
    filled = F.exists(sets, lambda s: F.exists(F.map_values(s["series"]), lambda o: F.size(o["observations"]) > 0))
    empty = F.raise_error(F.lit("no observations in the message"))
    # the check sits on the exploded column itself, so no filter can drop a broken message before it
    kind = parsed.select(sets.alias("s")).schema["s"].dataType
    checked = F.when(~valid, broken.cast(kind)).when(F.coalesce(filled, F.lit(False)), sets).otherwise(empty.cast(kind))
    return parsed.select(*keys, structure.alias("structure"), checked.alias("sets"))


def _labels(values: Column) -> Column:
    return F.transform(values, lambda v: v["id"])


def _flatten(series: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``observations`` map per row to ``(keys, date, value)``; unknown times and nulls are skipped."""
    flat = series.select(*keys, "times", F.explode("observations").alias("_idx", "_obs"))
    at = F.get(F.col("times"), F.col("_idx").try_cast("int"))
    return flat.select(
        *keys, label_date(at).alias("date"), F.get(F.col("_obs"), F.lit(0)).alias(value)
    ).dropna(subset=["date", value])


def observations(messages: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """All observations of all series: ``(keys, series_key, date, value)``."""
    times = _labels(F.get(F.col("structure.dimensions.observation"), F.lit(0))["values"])
    per_set = _parsed(messages, keys).select(*keys, times.alias("times"), F.explode("sets").alias("s"))
    per_series = per_set.select(*keys, "times", F.explode("s.series").alias("series_key", "o")).select(
        *keys, "times", "series_key", F.col("o.observations").alias("observations")
    )
    return _flatten(per_series, [*keys, "series_key"], value)


def keyed_series(messages: DataFrame, wanted: Sequence[str], value: str, keys: Sequence[str] = ()) -> DataFrame:
    """One series picked by dimension values; dimensions beyond ``wanted`` take their first value.

    The composite key is built from the position of each wanted value; a value missing from its
    dimension fails the job.
    """
    dims = F.col("structure.dimensions.series")
    positions = []
    for i, name in enumerate(wanted):
        at = F.array_position(_labels(F.get(dims, F.lit(i))["values"]), name) - 1
        missing = F.raise_error(F.lit(f"dimension {i} has no value '{name}'")).cast("bigint")
        positions.append(F.when(at >= 0, at).otherwise(missing).cast("string"))
    rest = F.array_repeat(F.lit("0"), (F.size(dims) - len(wanted)).cast("int"))
    key = F.concat_ws(":", F.concat(F.array(*positions), rest))
    times = _labels(F.get(F.col("structure.dimensions.observation"), F.lit(0))["values"])
    per_set = _parsed(messages, keys).select(
        *keys, times.alias("times"), key.alias("_key"), F.explode("sets").alias("s")
    )
    picked = per_set.select(
        *keys, "times", F.try_element_at(F.col("s.series"), F.col("_key"))["observations"].alias("observations")
    )
    return _flatten(picked, keys, value)


def period_totals(messages: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Sum over all series of a message per period."""
    return observations(messages, value, keys).groupBy(*keys, "date").agg(F.sum(value).alias(value))


def annual_map(messages: DataFrame, indicator: str, area: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """``{indicator: {area: {year: value}}}`` to rows at 1 July; empty or unreadable cells skipped."""
    parsed = messages.select(*keys, F.from_json("body", ANNUAL_SCHEMA)["values"].alias("v"))
    years = F.try_element_at(F.try_element_at(F.col("v"), F.lit(indicator)), F.lit(area))
    return (
        parsed.select(*keys, F.explode(years).alias("_year", "_value"))
        .select(*keys, first_of_month(F.col("_year").try_cast("int"), F.lit(7)).alias("date"),
                F.col("_value").try_cast("double").alias(value))
        .dropna(subset=["date", value])
    )
