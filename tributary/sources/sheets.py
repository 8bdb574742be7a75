"""Spreadsheet tabs, re-aimed at tabs exported as CSV.

A spreadsheet is a folder; each tab is one ``<tab>.csv`` file whose first
row is the header.  A tab is chosen by name, else by its position in the
name-sorted list.  The remote API login itself is not rebuilt (see README).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.columns import clean_sheet
from tributary.operators.metadata import stamp_metadata
from tributary.sources.csvsrc import read_csv_files
from tributary.sources.files import list_objects
from tributary.schemas import SOURCE_SYSTEMS


def _tabs(spark: SparkSession, spreadsheet_dir: str) -> list[tuple[str, list[str]]]:
    """``(tab name, csv files)`` per tab: a ``<tab>.csv`` file, or a folder
    ``<tab>.csv`` / ``<tab>`` of part files as Spark writes them."""
    listing = list_objects(spark, spreadsheet_dir).where(F.col("extension") == ".csv")
    top = F.element_at(F.split(F.col("rel_path"), "/"), 1)
    rows = listing.select(F.regexp_replace(top, r"(?i)\.csv$", "").alias("tab"), "path").collect()
    tabs: dict[str, list[str]] = {}
    for r in rows:  # one row per file of the spreadsheet
        tabs.setdefault(r["tab"], []).append(r["path"])
    return sorted((t, sorted(p)) for t, p in tabs.items())


def list_worksheets(spark: SparkSession, spreadsheet_dir: str) -> list[str]:
    """Tab names, sorted."""
    return [n for n, _ in _tabs(spark, spreadsheet_dir)]


def read_worksheet(spark: SparkSession, spreadsheet_dir: str, worksheet_name: str | None = None,
                   worksheet_index: int = 0) -> DataFrame:
    """Header row -> column names, remaining rows -> records (text)."""
    tabs = _tabs(spark, spreadsheet_dir)
    if worksheet_name:
        hit = [p for n, p in tabs if n == worksheet_name]
        if not hit:
            raise LookupError(f"Worksheet not found: {worksheet_name}")
        paths = hit[0]
    else:
        if worksheet_index >= len(tabs):
            raise LookupError(f"no worksheet at index {worksheet_index}")
        paths = tabs[worksheet_index][1]
    return read_csv_files(spark, paths)


def extract_agents(spark: SparkSession, spreadsheet_dir: str, worksheet_name: str = "agents", as_of=None) -> DataFrame:
    """The agents tab, cleaned (P3) and stamped."""
    df = clean_sheet(read_worksheet(spark, spreadsheet_dir, worksheet_name))
    location = f"spreadsheet:{spreadsheet_dir}/worksheet:{worksheet_name}"
    return stamp_metadata(df, SOURCE_SYSTEMS["agents"], location, as_of=as_of)
