"""Synthetic deliveries of any size, and writers for the delivery format."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from batchgate.operators.contract import DEFAULT
from batchgate.sources import files
from batchgate.sources.landing import control_path, data_path

# What each site delivers for every synthetic row.
_SITE_VALUES = {"A": ("yyyy-MM-dd", "90", "mg/dL"), "B": ("yyyy/MM/dd", "5", "mmol/L")}
_DIRT = (("patient_id", ""), ("measurement_date", "2026-02-30"), ("unit", "unknown"))


def site_rows(numbers: DataFrame, site: str, day: Column) -> DataFrame:
    """Delivered text rows for a DataFrame of row numbers ``id``: two visits per patient."""
    pattern, value, unit = _SITE_VALUES[site]
    text = F.date_format(day, pattern)
    number = F.col("id").cast("string")
    patient = F.floor(F.col("id") / 2).cast("string")
    return numbers.select(
        F.concat(F.lit("SYN-P-"), patient).alias("patient_id"),
        F.lit("1980").alias("birth_year"),
        F.concat(F.lit("SYN-V-"), number).alias("visit_id"),
        text.alias("visit_date"),
        F.concat(F.lit("SYN-M-"), number).alias("measurement_id"),
        text.alias("measurement_date"),
        F.lit("DEMO_GLU").alias("test_code"),
        F.lit(value).alias("value"),
        F.lit(unit).alias("unit"),
    )


def dirty_rows(first: DataFrame) -> DataFrame:
    """An exact copy of the given row and three copies with one bad field each."""
    out = first
    for column, value in _DIRT:
        out = out.unionByName(first.withColumn(column, F.lit(value)))
    return out


def write_control(spark: SparkSession, folder: str, site: str, rows: int) -> None:
    """Sender-side count of data rows, without the header."""
    files.delete_tree(spark, control_path(folder, site))
    files.write_new(spark, control_path(folder, site), f"{rows}\n")


def write_csv(rows: DataFrame, path: str, line_separator: str = "\n",
              by: str | None = None) -> None:
    """Write rows as part files that each start with the header, in a folder per ``by``."""
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).csv(
        path, header=True, escape='"', emptyValue="", nullValue="", lineSep=line_separator,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_site(spark: SparkSession, rows: DataFrame, folder: str, site: str,
               line_separator: str = "\n") -> None:
    """Write one site's rows as a delivery."""
    write_csv(rows, data_path(folder, site), line_separator)


def generate(spark: SparkSession, folder: str, day: str, rows_per_hospital: int = 1000,
             dirty: bool = True) -> dict:
    """Write both sites' deliveries, control files and ``manifest.json``."""
    if rows_per_hospital < 1:
        raise ValueError("a site delivers one row at least")
    batch_day = F.lit(date.fromisoformat(day))
    folder = str(folder).rstrip("/")
    for site in DEFAULT.sites:
        rows = site_rows(spark.range(rows_per_hospital), site, batch_day)
        if dirty:
            rows = rows.unionByName(dirty_rows(site_rows(spark.range(1), site, batch_day)))
        write_site(spark, rows, folder, site)
        write_control(spark, folder, site, rows_per_hospital + (4 if dirty else 0))
    sites = len(DEFAULT.sites)
    manifest = {
        "synthetic_only": True, "batch_date": day,
        "expected_unique": sites * rows_per_hospital,
        "expected_duplicates": sites if dirty else 0,
        "expected_rejected": 3 * sites if dirty else 0,
    }
    files.delete_tree(spark, f"{folder}/manifest.json")
    files.write_new(spark, f"{folder}/manifest.json", json.dumps(manifest, indent=2))
    return manifest
