"""Row batches sent as JSON arrays: strict, typed, expanded to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType, ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType,
    ShortType, StructField, StructType,
)

# JSON kinds that a column of a type takes, as Spark names them; other types come as strings.
_WHOLE = r"BIGINT|DECIMAL\([0-9]+,0\)"
_NUMBER = r"BIGINT|DECIMAL\([0-9]+,[0-9]+\)|DOUBLE"
_KINDS: dict[type[DataType], str] = {
    BooleanType: "BOOLEAN", DecimalType: _NUMBER, DoubleType: _NUMBER, FloatType: _NUMBER,
    **dict.fromkeys((ByteType, ShortType, IntegerType, LongType), _WHOLE),
}
_TEXT = "STRING"


def pack_json(rows: DataFrame, group: str, column: str = "payload") -> DataFrame:
    """One JSON array per group; callers choose groups of bounded size."""
    names = [c for c in rows.columns if c != group]
    return rows.groupBy(group).agg(
        F.to_json(F.collect_list(F.struct(*names)), {"ignoreNullFields": "false"}).alias(column)
    )


def expand_json(batches: DataFrame, schema: StructType, column: str = "payload") -> DataFrame:
    """Rows of the JSON arrays in ``column``; any value of the wrong type fails the job."""
    parsed = F.from_json(column, f"array<{schema.simpleString()}>", {"mode": "FAILFAST"})
    keep = [c for c in batches.columns if c != column]
    return batches.select(*keep, F.inline(parsed))


def _wrong(entry: Column, field: StructField, value: Column) -> Column:
    """What is wrong with one field of an entry; null if nothing is."""
    path = f"$['{field.name}']"
    raw = F.try_variant_get(entry, path, "variant")
    absent = raw.isNull() | F.is_variant_null(raw)
    kind = F.schema_of_variant(raw)
    wrong = ~kind.rlike(rf"\A(?:{_KINDS.get(type(field.dataType), _TEXT)})\z") | value.isNull()
    if isinstance(field.dataType, DecimalType):
        # More places than the column has would be rounded away; 38 digits hold what JSON says.
        wrong = wrong | ~value.eqNullSafe(F.try_variant_get(entry, path, "string").try_cast(
            f"decimal(38,{min(38, field.dataType.scale + 10)})"))
    missing = F.lit(None) if field.nullable else F.lit(f"MISSING_FIELD:{field.name}")
    return F.when(absent, missing).when(wrong, F.lit(f"WRONG_TYPE:{field.name}"))


def typed_entries(batches: DataFrame, schema: StructType, column: str = "payload",
                  strict: bool = False) -> DataFrame:
    """Every entry of the JSON arrays: the batch's columns, ``position``, ``reason``, the fields.

    The text is parsed once, to a VARIANT.  A good entry has a null ``reason``; a bad one has null
    fields and the first reason in the schema's order: ``MISSING_FIELD:<name>`` (absent or null in
    a column that takes no null), ``WRONG_TYPE:<name>`` (another JSON kind, out of range, or more
    decimal places than the column has), ``NOT_AN_OBJECT``.  A batch that is no JSON array, or has
    an object with a name twice, is one row, ``NOT_AN_ARRAY``, without a position.  Null and empty
    batches have no entries; names not in the schema are ignored.

    With ``strict`` the first bad entry fails the job and names position and reason, no value.
    """
    keep = [c for c in batches.columns if c != column]
    entries = F.try_variant_get(F.try_parse_json(column), "$", "array<variant>")
    listed = batches.where(F.col(column).isNotNull()).select(*keep, entries.alias("_entries"))
    whole = listed.select(
        *keep, F.col("_entries").isNull().alias("_broken"),
        F.posexplode(F.coalesce("_entries", F.array(F.parse_json(F.lit("null"))))).alias(
            "_at", "_entry"))
    entry = F.col("_entry")
    values = {f.name: F.try_variant_get(entry, f"$['{f.name}']", f.dataType.simpleString())
              for f in schema}
    reason = F.coalesce(
        F.when(F.col("_broken"), F.lit("NOT_AN_ARRAY")),
        F.when(~F.coalesce(F.schema_of_variant(entry).startswith("OBJECT"), F.lit(False)),
               F.lit("NOT_AN_OBJECT")),
        *[_wrong(entry, f, values[f.name]) for f in schema])
    judged = whole.withColumn("reason", reason)
    if strict:
        message = F.format_string("entry %d: %s", F.col("_at"), F.col("reason"))
        judged = judged.withColumn("reason", F.when(
            F.col("reason").isNotNull(), F.raise_error(message).cast("string")))
    good = F.col("reason").isNull()
    return judged.select(
        *keep, F.when(~F.col("_broken"), F.col("_at")).alias("position"), "reason",
        *[F.when(good, value).alias(name) for name, value in values.items()])
