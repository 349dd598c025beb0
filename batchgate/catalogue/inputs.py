"""Inputs of the registered queries, derived from the whole ``events`` table.

The tables hold no delivered files, so every event becomes one delivered text row, clean or
broken in a way its number decides.  The derivation is one SQL text that both engines
read, so that a comparison tests the operators and not the input.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from batchgate.operators.contract import DEFAULT, classify
from batchgate.session import scratch_folder
from batchgate.sources.synthetic import write_control, write_site

FIRST_DAY, LAST_DAY = date(2024, 1, 5), date(2024, 1, 25)
BATCH_DAY = date(2024, 1, 10)
SITES = DEFAULT.sites

_DELIVERED = """
SELECT event_id, hospital,
  CASE WHEN event_id % 97 = 0 THEN '   '
       WHEN event_id % 67 = 0 THEN 'patient-' || CAST(user_id AS STRING)
       WHEN event_id % 61 = 0 THEN 'SYN-V-' || CAST(user_id AS STRING)
       WHEN event_id % 53 = 0 THEN '\t SYN-P-' || CAST(user_id AS STRING) || '　'
       ELSE 'SYN-P-' || CAST(user_id AS STRING) END AS patient_id,
  CASE WHEN event_id % 59 = 0 THEN '1899'
       WHEN event_id % 37 = 0
         THEN translate(CAST(1940 + user_id % 60 AS STRING), '0123456789', '０１２３４５６７８９')
       ELSE CAST(1940 + user_id % 60 AS STRING) END AS birth_year,
  'SYN-V-' || CAST(event_id AS STRING) AS visit_id,
  day_text AS visit_date,
  'SYN-M-' || CAST(event_id AS STRING) AS measurement_id,
  CASE WHEN event_id % 89 = 0 AND hospital = 'A' THEN '2024-02-30'
       WHEN event_id % 89 = 0 THEN '2024/02/30'
       WHEN event_id % 31 = 0 THEN substr(day_text, 1, 7)
       ELSE day_text END AS measurement_date,
  CASE WHEN event_id % 79 = 0 THEN props ELSE 'DEMO_GLU' END AS test_code,
  CASE WHEN event_id % 73 = 0 THEN '-' || plain
       WHEN event_id % 71 = 0 THEN 'oops'
       WHEN event_id % 47 = 0 THEN plain || 'e0'
       WHEN event_id % 43 = 0 THEN '0_' || plain
       WHEN event_id % 41 = 0 AND hospital = 'A'
         THEN cents || lpad(CAST(event_id % 100 AS STRING), 2, '0') || '5'
       WHEN event_id % 41 = 0
         THEN cents || lpad(CAST(event_id % 100 AS STRING), 2, '0') || '25'
       ELSE plain END AS value,
  CASE WHEN event_id % 83 = 0 THEN event_type
       WHEN hospital = 'A' THEN 'mg/dL' ELSE 'mmol/L' END AS unit
FROM (
  SELECT *, CASE WHEN event_id % 2 = 0 THEN {day_a} ELSE {day_b} END AS day_text
  FROM (
    SELECT event_id, user_id, event_type, props, ts,
      CASE WHEN event_id % 2 = 0 THEN 'A' ELSE 'B' END AS hospital,
      CAST(CAST(value AS DECIMAL(18,4)) AS STRING) AS plain,
      CAST(CAST(value AS DECIMAL(18,2)) AS STRING) AS cents
    FROM {events}
  ) AS typed
) AS dated
"""


def delivered_sql(events: str, day_a: str, day_b: str) -> str:
    return _DELIVERED.format(events=events, day_a=day_a, day_b=day_b)


# For DuckDB: rows dated as they happened, and the same rows all on the batch date.
DELIVERED = delivered_sql("events", "strftime(ts, '%Y-%m-%d')", "strftime(ts, '%Y/%m/%d')")
DELIVERED_ONE_DAY = delivered_sql("events", f"'{BATCH_DAY:%Y-%m-%d}'", f"'{BATCH_DAY:%Y/%m/%d}'")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def delivered(spark: SparkSession, sf_dir: str, one_day: bool = False) -> DataFrame:
    """Delivered text rows of all events: ``event_id, hospital`` and the contract columns."""
    days = (
        (f"'{BATCH_DAY:%Y-%m-%d}'", f"'{BATCH_DAY:%Y/%m/%d}'") if one_day
        else ("date_format(ts, 'yyyy-MM-dd')", "date_format(ts, 'yyyy/MM/dd')")
    )
    return spark.sql(delivered_sql("{events}", *days), events=read(spark, sf_dir, "events"))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(delivered(spark, sf_dir), FIRST_DAY, LAST_DAY)


def deliver_files(spark: SparkSession, rows: DataFrame, sites=SITES) -> str:
    """Write delivered rows as both sites' files and control files; returns the folder."""
    folder = scratch_folder(spark)
    counts = {r["hospital"]: r["count"] for r in rows.groupBy("hospital").count().collect()}
    for site in sites:
        mine = rows.where(F.col("hospital") == site).select(*DEFAULT.columns)
        write_site(spark, mine, folder, site)
        write_control(spark, folder, site, counts.get(site, 0))
    return folder
