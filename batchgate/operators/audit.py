"""Audit of published tables by expectations, independent of the batch gates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from batchgate.operators.contract import DEFAULT, Contract

# What a token looks like, and the largest value after unit conversion.
TOKEN_PATTERN = r"\A[0-9a-f]{64}\z"
MAX_CONVERTED = 180000


@dataclass(frozen=True)
class Expectation:
    """One expectation: its report name, its column, and how to count what breaks it.

    ``unexpected`` is a row test; row-count and uniqueness expectations use ``rows`` and
    ``keys`` instead.
    """

    kind: str
    column: str = ""
    unexpected: Column | None = None
    rows: int | None = None
    keys: tuple[str, ...] = ()


def row_count(rows: int) -> Expectation:
    return Expectation("expect_table_row_count_to_equal", rows=rows)


def unique(*keys: str) -> Expectation:
    return Expectation("expect_compound_columns_to_be_unique", keys=keys)


def not_null(column: str) -> Expectation:
    return Expectation("expect_column_values_to_not_be_null", column, F.col(column).isNull())


def matches(column: str, pattern: str) -> Expectation:
    return Expectation(
        "expect_column_values_to_match_regex", column, ~F.col(column).rlike(pattern))


def in_set(column: str, values: Sequence[str]) -> Expectation:
    return Expectation("expect_column_values_to_be_in_set", column, ~F.col(column).isin(*values))


def between(column: str, low: int, high: int) -> Expectation:
    return Expectation(
        "expect_column_values_to_be_between", column, ~F.col(column).between(low, high))


def snapshot_suites(expected_rows: int, year: int,
                    contract: Contract = DEFAULT) -> dict[str, list[Expectation]]:
    """The expectations on the published measurement and patient tables."""
    ids = ("person_id", "visit_id", "measurement_id")
    return {
        "measurement_snapshot": [
            row_count(expected_rows),
            unique("batch_date", "hospital", "measurement_id"),
            *[not_null(c) for c in (*ids, "value")],
            *[matches(c, TOKEN_PATTERN) for c in ids],
            in_set("hospital", contract.sites),
            in_set("unit", [contract.canonical_unit]),
            in_set("test_code", contract.codes),
            between("value", 0, MAX_CONVERTED),
        ],
        "patient_snapshot": [
            unique("batch_date", "hospital", "person_id"),
            matches("person_id", TOKEN_PATTERN),
            between("birth_year", contract.first_year, year),
        ],
    }


def evaluate(table: DataFrame, name: str, suite: Sequence[Expectation]) -> DataFrame:
    """Rows ``table, position, expectation, column, evaluated, unexpected, success``.

    All row tests of a table share one aggregation; every uniqueness test adds one that
    counts its keys.
    """
    total = F.count(F.lit(1))

    def row(position: int, e: Expectation, evaluated: Column, unexpected: Column,
            success: Column) -> Column:
        return F.struct(
            F.lit(name).alias("table"), F.lit(position).alias("position"),
            F.lit(e.kind).alias("expectation"), F.lit(e.column).alias("column"),
            evaluated.cast("long").alias("evaluated"), unexpected.cast("long").alias("unexpected"),
            success.alias("success"),
        )

    counts, rows, results = [total.alias("total")], [], []
    for position, e in enumerate(suite):
        if e.keys:
            repeated = F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
            found = table.groupBy(*e.keys).agg(total.alias("n")).agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("total"), repeated.alias("bad"))
            results.append(found.select(
                F.inline(F.array(row(position, e, F.col("total"), F.col("bad"),
                                     F.col("bad") == 0)))))
        elif e.rows is not None:
            rows.append(row(position, e, F.col("total"), F.abs(F.col("total") - e.rows),
                            F.col("total") == e.rows))
        else:
            counts.append(F.count_if(e.unexpected).alias(f"bad{position}"))
            bad = F.col(f"bad{position}")
            rows.append(row(position, e, F.col("total"), bad, bad == 0))
    if rows:
        results.append(table.agg(*counts).select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, results)


def audit_rows(tables: dict[str, DataFrame],
               suites: dict[str, list[Expectation]]) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [evaluate(tables[t], t, suite) for t, suite in suites.items()])
