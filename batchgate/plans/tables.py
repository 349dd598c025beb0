"""Schemas of the published tables and of the run ledger."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType, DecimalType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampType,
)


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


_TEXT, _DAY = StringType(), DateType()

TABLES: dict[str, StructType] = {
    "patient_snapshot": _schema(
        batch_date=_DAY, hospital=_TEXT, person_id=_TEXT, birth_year=IntegerType()),
    "visit_snapshot": _schema(
        batch_date=_DAY, hospital=_TEXT, visit_id=_TEXT, person_id=_TEXT, visit_date=_DAY),
    "measurement_snapshot": _schema(
        batch_date=_DAY, hospital=_TEXT, measurement_id=_TEXT, visit_id=_TEXT, person_id=_TEXT,
        measurement_date=_DAY, test_code=_TEXT, value=DecimalType(18, 4), unit=_TEXT),
}

QUARANTINE = _schema(hospital=_TEXT, file=_TEXT, line=LongType(), reason=_TEXT)

RUNS = _schema(
    run_id=_TEXT, batch_date=_DAY, status=_TEXT, source_sha256=_TEXT, metrics_json=_TEXT,
    error_code=_TEXT, recorded_at=TimestampType())

COMMITS = _schema(number=LongType(), batch_date=_DAY, run_id=_TEXT, key_id=_TEXT)

ALERTS = _schema(batch_date=_DAY, message=_TEXT, recorded_at=TimestampType())
