"""Batch checks as DataFrames: conflicts, references, counts, ratios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def reject_histogram(classified: DataFrame, by: Sequence[str] = ("hospital",)) -> DataFrame:
    """Rejected rows per reason."""
    return (
        classified.where(F.col("reason").isNotNull())
        .groupBy(*by, "reason").agg(F.count(F.lit(1)).alias("rows"))
    )


def quarantine(located: DataFrame) -> DataFrame:
    """Locator and reason of rejected rows; never a delivered value."""
    keep = [c for c in ("hospital", "file", "line", "reason") if c in located.columns]
    return located.where(F.col("reason").isNotNull()).select(*keep)


def reject_ratio(classified: DataFrame) -> DataFrame:
    """Input, rejected rows and their share over all sites together; null for no input."""
    rejected = F.count_if(F.col("reason").isNotNull())
    total = F.count(F.lit(1))
    return classified.agg(
        total.alias("input_rows"), rejected.alias("rejected_rows"),
        (rejected / F.nullif(total, F.lit(0))).alias("ratio"),
    )


def conflicting_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; give it distinct rows."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def conflicting_values(rows: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Keys with more than one distinct value of ``column``.

    Comparing the extremes needs two values per key where a distinct count would shuffle
    every pair.
    """
    return (
        rows.groupBy(*keys)
        .agg(F.min(column).alias("lowest"), F.max(column).alias("highest"))
        .where("lowest <> highest")
    )


def missing_sites(rows: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected sites without a row; the rows shrink to one per site before the join."""
    return expected.join(rows.select("hospital").distinct(), "hospital", "left_anti")


def control_mismatch(counts: DataFrame, controls: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose ``rows`` differ from the sender's ``control_rows`` or lack a partner."""
    return counts.join(controls, list(keys), "full").where(
        ~F.col("rows").eqNullSafe(F.col("control_rows"))
    )


def orphans(measurements: DataFrame, visits: DataFrame, patients: DataFrame,
            scope: Sequence[str], visit: str, person: str) -> DataFrame:
    """Rows of ``measurements`` without visit or patient, or with another person's visit."""
    scope = list(scope)
    v = visits.select(*scope, visit, F.col(person).alias("_owner"), F.lit(True).alias("_visit"))
    p = patients.select(*scope, person, F.lit(True).alias("_person"))
    return (
        measurements.join(v, [*scope, visit], "left").join(p, [*scope, person], "left")
        .where(
            F.col("_visit").isNull() | F.col("_person").isNull()
            | (F.col(person) != F.col("_owner"))
        )
        .drop("_owner", "_visit", "_person")
    )


def orphan_count(measurements: DataFrame, visits: DataFrame, patients: DataFrame,
                 scope: Sequence[str], visit: str, person: str) -> DataFrame:
    """Number of :func:`orphans` as ``orphan_rows``, by counting keys instead of joining rows.

    Visits must be unique per scope and visit.  Each step stacks child counts and parent
    keys and aggregates them together: the counts combine before the shuffle, so neither
    a visit nor a person with a large share of all rows makes a hot key.
    """
    scope = list(scope)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    pairs = (
        measurements.select(*scope, visit, person, one.alias("_rows"), none.alias("_parents"))
        .unionByName(visits.select(*scope, visit, person, none.alias("_rows"), one.alias("_parents")))
        .groupBy(*scope, visit, person)
        .agg(F.sum("_rows").alias("_rows"), F.sum("_parents").alias("_parents"))
        .where("_rows > 0")
    )
    bad = (F.col("_parents") == 0) | F.col(visit).isNull()
    persons = (
        pairs.select(
            *scope, person, "_rows", F.when(bad, F.col("_rows")).otherwise(none).alias("_bad"),
            none.alias("_parents"),
        )
        .unionByName(patients.select(
            *scope, person, none.alias("_rows"), none.alias("_bad"), one.alias("_parents")))
        .groupBy(*scope, person)
        .agg(*[F.sum(c).alias(c) for c in ("_rows", "_bad", "_parents")])
    )
    unknown = (F.col("_parents") == 0) | F.col(person).isNull()
    return persons.agg(
        F.coalesce(
            F.sum(F.when(unknown, F.col("_rows")).otherwise(F.col("_bad"))), none
        ).alias("orphan_rows")
    )


def key_counts(tables: dict[str, DataFrame], keys: dict[str, Sequence[str]]) -> DataFrame:
    """Per table: ``rows`` and ``conflicts`` (keys on more than one row), in one aggregation.

    Tables with the same number of key columns are stacked under their name.
    """
    stacked = None
    for name, table in tables.items():
        row = table.select(
            F.lit(name).alias("table"),
            *[F.col(c).alias(f"k{i}") for i, c in enumerate(keys[name])],
        )
        stacked = row if stacked is None else stacked.unionByName(row)
    names = stacked.columns
    return (
        stacked.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("table")
        .agg(F.sum("_n").alias("rows"), F.count_if(F.col("_n") > 1).alias("conflicts"))
    )


def gate_report(classified: DataFrame, clean: DataFrame, sites: Sequence[str],
                max_reject_ratio: float) -> DataFrame:
    """The row gates in order: ``gate, code, observed, threshold, passed``.

    ``clean`` holds the distinct accepted rows.  The first row that did not pass names the
    failure of the batch.
    """
    number = lambda c: c.cast("double")
    totals = reject_ratio(classified)
    found = F.count_distinct(F.when(F.col("hospital").isin(*sites), F.col("hospital")))
    rows = F.count(F.lit(1))

    def row(gate: int, code: str, table: DataFrame, observed, threshold, passed) -> DataFrame:
        return table.agg(number(observed).alias("observed")).select(
            F.lit(gate).alias("gate"), F.lit(code).alias("code"), "observed",
            F.lit(float(threshold)).alias("threshold"),
            F.coalesce(passed(F.col("observed")), F.lit(False)).alias("passed"),
        )

    none = lambda c: c == 0
    gates = [
        row(6, "EMPTY_BATCH", totals, F.max("input_rows"), 0, lambda c: c > 0),
        row(7, "REJECT_RATIO_EXCEEDED", totals, F.max("ratio"), max_reject_ratio,
            lambda c: c <= max_reject_ratio),
        row(8, "HOSPITAL_WITHOUT_VALID_ROWS", clean, found, len(sites),
            lambda c: c == len(sites)),
        row(9, "CONFLICTING_MEASUREMENT",
            conflicting_keys(clean, ["hospital", "measurement_id"]), rows, 0, none),
        row(10, "CONFLICTING_PERSON",
            conflicting_values(clean, ["hospital", "person_id"], "birth_year"), rows, 0, none),
        row(11, "CONFLICTING_VISIT",
            conflicting_values(clean, ["hospital", "visit_id"], "person_id"), rows, 0, none),
    ]
    out = gates[0]
    for gate in gates[1:]:
        out = out.unionByName(gate)
    return out
