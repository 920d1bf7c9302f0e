"""Purchase lines staged as tabular files, one per sheet of the original workbook."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column names of the published data set and their canonical names and types.
SHEET_COLUMNS = {
    "Invoice": ("invoice", "string"),
    "StockCode": ("item_id", "string"),
    "Description": ("description", "string"),
    "Quantity": ("quantity", "bigint"),
    "InvoiceDate": ("invoice_date", "timestamp"),
    "Price": ("price", "double"),
    "Customer ID": ("user_id", "bigint"),
    "Country": ("country", "string"),
}


def conform_sheet(sheet: DataFrame) -> DataFrame:
    """Canonical names and types; ids become text even where a sheet stores them as numbers."""
    return sheet.select(
        *[F.col(f"`{raw}`").cast(kind).alias(name) for raw, (name, kind) in SHEET_COLUMNS.items()]
    )


def union_sheets(*sheets: DataFrame) -> DataFrame:
    """Concatenate without removing duplicates."""
    return reduce(DataFrame.unionByName, sheets)


def read_sheets(*sheets: DataFrame) -> DataFrame:
    return union_sheets(*[conform_sheet(s) for s in sheets])
