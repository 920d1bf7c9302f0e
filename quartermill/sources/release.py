"""Long statistical releases: CSV files and archives of CSV files."""

from __future__ import annotations

import csv
import io
import zipfile
import zlib
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermill.functions.periods import period_mixed, period_year_month

RELEASE_COLUMNS = ("series_reference", "period", "data_value", "suppressed")
# Header spellings accepted for the value column, after trimming and lower-casing.
VALUE_HEADERS = ("data_value", "datavalue")
BATCH_ROWS = 50_000


def header_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def read_release(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text under normalised names; periods must never be read as numbers."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*[F.col(f"`{c}`").alias(header_name(c)) for c in raw.columns])


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df


def series_rows(release: DataFrame, series: str, value: str = "y") -> DataFrame:
    """One series as ``(date, value)``; cells that are no number are dropped."""
    chosen = require_rows(
        release.filter(F.trim("series_reference") == series), f"series '{series}' not found in the release"
    )
    return chosen.select(
        period_year_month(F.col("period")).alias("date"),
        F.trim("data_value").try_cast("double").alias(value),
    ).dropna()


def labelled_rows(release: DataFrame, labels: DataFrame) -> DataFrame:
    """``(date, industry, value)`` of the listed series, without suppressed or empty cells.

    ``labels`` is a small ``(series_reference, industry)`` table; the join picks and names the
    series in one step.
    """
    kept = release.filter(F.col("data_value").isNotNull() & F.col("suppressed").isNull())
    return (
        kept.join(labels, "series_reference")
        .select(period_mixed(F.col("period")).alias("date"), "industry",
                F.trim("data_value").try_cast("double").alias("value"))
        .dropna(subset=["date", "value"])
    )


def lookup_label(df: DataFrame, labels: DataFrame, key: str, label: str, missing: str = "") -> DataFrame:
    """Left join of a label by key; unknown keys get ``missing``."""
    return df.join(labels.select(key, label), key, "left").fillna(missing, subset=[label])


def _member_rows(archive: zipfile.ZipFile, member: str, series: str) -> Iterator[tuple[str, str]]:
    """(period, value) texts of one series in one CSV member, read as a stream."""
    with archive.open(member) as handle:
        reader = csv.reader(io.TextIOWrapper(handle, encoding="utf-8", errors="replace", newline=""))
        header = [h.strip().lower() for h in next(reader, [])]
        names = [h.replace(" ", "_") for h in header]
        value_at = next((i for i, h in enumerate(header) if h in VALUE_HEADERS), None)
        if value_at is None or "series_reference" not in names or "period" not in header:
            return
        series_at, period_at = names.index("series_reference"), header.index("period")
        for row in reader:
            if len(row) > max(series_at, period_at, value_at) and row[series_at].strip() == series:
                yield row[period_at].strip(), row[value_at].strip()


def archive_series(archives: DataFrame, series: str, value: str = "y", required: bool = True) -> DataFrame:
    """``(path, member, date, value)`` from a binary-file frame ``(path, content)`` of ZIP archives.

    Archives are spread over the tasks; inside one, members are streamed in stored order and the
    first member that holds the series wins. A member that can't be read is skipped. An archive in
    which no readable member holds the series fails the job, unless the series is not ``required``.
    One archive is one row, as a ZIP file can't be read in parts.
    """

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["path", "member", "period", "data_value"]
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                found = False
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in (n for n in archive.namelist() if n.lower().endswith(".csv")):
                        rows = []
                        try:
                            rows = [(path, member, *cells) for cells in _member_rows(archive, member, series)]
                        except (zipfile.BadZipFile, zlib.error, csv.Error, NotImplementedError, EOFError):
                            continue
                        for start in range(0, len(rows), BATCH_ROWS):
                            yield pd.DataFrame(rows[start:start + BATCH_ROWS], columns=columns)
                        if rows:
                            found = True
                            break
                if required and not found:
                    raise ValueError(f"series '{series}' not found in {path}")

    found = archives.select("path", "content").mapInPandas(
        extract, "path string, member string, period string, data_value string"
    )
    return found.select(
        "path", "member", period_year_month(F.col("period")).alias("date"),
        F.col("data_value").try_cast("double").alias(value),
    ).dropna()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def pack_archives(rows: DataFrame, group: str, members: Mapping[str, Sequence[str]]) -> DataFrame:
    """Inverse of :func:`archive_series`: one ZIP per ``group``, members written in the given order.

    ``rows`` has one text column per header; ``members`` maps a member name to its columns. A group
    holds one release period, so its size is bounded by series x periods.
    """
    order = dict(members)

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            for name, columns in order.items():
                archive.writestr(name, pdf[list(columns)].to_csv(index=False))
        path = f"{pdf[group].iloc[0]}.zip"
        return pd.DataFrame({"path": [path], "content": [buffer.getvalue()]})

    return rows.groupBy(group).applyInPandas(pack, "path string, content binary")
