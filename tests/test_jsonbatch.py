"""Typed JSON batches: bad entries are rows with a position and a reason."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql.types import (
    BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType, StringType, StructField,
    StructType,
)

from batchgate.sources.jsonbatch import pack_json, typed_entries

SCHEMA = StructType([
    StructField("id", LongType(), False), StructField("small", IntegerType()),
    StructField("day", DateType()), StructField("value", DecimalType(18, 4)),
    StructField("share", DoubleType()), StructField("name", StringType()),
    StructField("flag", BooleanType())])


def judged(spark, *payloads, strict=False):
    batches = spark.createDataFrame(list(enumerate(payloads)), "batch int, payload string")
    return sorted(map(tuple, typed_entries(batches, SCHEMA, strict=strict).collect()), key=str)


@pytest.mark.parametrize("entry, reason", [
    ('{"id": 1}', None),
    ('{"id": 1, "other": [1, {"a": 2}], "name": null}', None),
    ('{"id": 9223372036854775807, "small": -2147483648, "value": 12345678901234.5678}', None),
    ('{}', "MISSING_FIELD:id"),
    ('{"id": null}', "MISSING_FIELD:id"),
    ('{"id": "1"}', "WRONG_TYPE:id"),
    ('{"id": 1.5}', "WRONG_TYPE:id"),
    ('{"id": 9223372036854775808}', "WRONG_TYPE:id"),
    ('{"id": 1, "small": 2147483648}', "WRONG_TYPE:small"),
    ('{"id": 1, "day": "2026-02-30"}', "WRONG_TYPE:day"),
    ('{"id": 1, "day": 20260203}', "WRONG_TYPE:day"),
    ('{"id": 1, "value": 0.00001}', "WRONG_TYPE:value"),
    ('{"id": 1, "value": 123456789012345}', "WRONG_TYPE:value"),
    ('{"id": 1, "value": "2"}', "WRONG_TYPE:value"),
    ('{"id": 1, "share": true}', "WRONG_TYPE:share"),
    ('{"id": 1, "name": 5}', "WRONG_TYPE:name"),
    ('{"id": 1, "name": {"a": 1}}', "WRONG_TYPE:name"),
    ('{"id": 1, "flag": "true"}', "WRONG_TYPE:flag"),
    ('{"small": "x", "id": []}', "WRONG_TYPE:id"),
    ('7', "NOT_AN_OBJECT"), ('null', "NOT_AN_OBJECT"), ('[1]', "NOT_AN_OBJECT"),
])
def test_entries(spark, entry, reason):
    first, second = judged(spark, f'[{{"id": 5}}, {entry}]')
    assert first[:4] == (0, 0, None, 5)
    assert second[:3] == (0, 1, reason)
    assert reason is None or set(second[3:]) == {None}


def test_values(spark):
    text = ('[{"id": 1, "small": 2, "day": "2026-02-03", "value": 4.5, "share": 0.25,'
            ' "name": "é \\"x\\"", "flag": false}]')
    assert judged(spark, text) == [
        (0, 0, None, 1, 2, date(2026, 2, 3), Decimal("4.5000"), 0.25, 'é "x"', False)]


def test_batches(spark):
    rows = judged(spark, None, "", "[]", "{}", "[", '[{"id": 1, "id": 2}]', '[{"id": 3}]', "null")
    assert [r[:4] for r in rows] == [
        (1, None, "NOT_AN_ARRAY", None), (3, None, "NOT_AN_ARRAY", None),
        (4, None, "NOT_AN_ARRAY", None), (5, None, "NOT_AN_ARRAY", None), (6, 0, None, 3),
        (7, None, "NOT_AN_ARRAY", None)]


def test_strict(spark):
    assert len(judged(spark, '[{"id": 1}, {"id": 2}]', strict=True)) == 2
    with pytest.raises(Exception, match="entry 1: WRONG_TYPE:id"):
        judged(spark, '[{"id": 1}, {"id": "secret"}]', strict=True)


def test_round_trip(spark):
    rows = spark.range(1000).selectExpr(
        "id % 7 AS b", "id", "cast(id AS int) AS small",
        "date_add(date '2026-01-01', cast(id % 90 AS int)) AS day",
        "cast(id / 8 AS decimal(18,4)) AS value", "id / 16 AS share",
        "if(id % 5 = 0, null, concat('n', id)) AS name", "id % 2 = 0 AS flag")
    schema = StructType(SCHEMA.fields)
    back = typed_entries(pack_json(rows, "b"), schema)
    assert back.where("reason IS NOT NULL").isEmpty()
    assert back.drop("position", "reason").exceptAll(rows).isEmpty() and back.count() == 1000
