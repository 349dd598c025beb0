"""The row contract: one ordered chain of rules, first failure names the reason."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from batchgate.functions.decimals import contract_decimal
from batchgate.functions.text import ascii_digits, full_match, strip
from batchgate.functions.tokens import token


@dataclass(frozen=True)
class IdRule:
    """Identifier column: its prefix, the kind mixed into its token, its output name."""

    prefix: str
    kind: str
    target: str


@dataclass(frozen=True)
class Contract:
    """What a delivered row must look like.  The defaults describe the two-site delivery."""

    # The delivery format.
    columns: tuple[str, ...] = (
        "patient_id", "birth_year", "visit_id", "visit_date", "measurement_id",
        "measurement_date", "test_code", "value", "unit",
    )
    id_pattern: str = "SYN-[PVM]-[0-9]+"
    ids: Mapping[str, IdRule] = field(default_factory=lambda: {
        "patient_id": IdRule("SYN-P-", "person", "person_id"),
        "visit_id": IdRule("SYN-V-", "visit", "visit_id"),
        "measurement_id": IdRule("SYN-M-", "measurement", "measurement_id"),
    })
    dates: tuple[str, ...] = ("visit_date", "measurement_date")
    date_separators: Mapping[str, str] = field(default_factory=lambda: {"A": "-", "B": "/"})
    year_column: str = "birth_year"
    first_year: int = 1900
    code_column: str = "test_code"
    codes: tuple[str, ...] = ("DEMO_GLU",)
    value_column: str = "value"
    value_range: tuple[int, int] = (0, 10000)
    unit_column: str = "unit"
    unit_factors: Mapping[str, int] = field(default_factory=lambda: {"mg/dL": 1, "mmol/L": 18})
    canonical_unit: str = "mg/dL"

    @property
    def sites(self) -> tuple[str, ...]:
        return tuple(self.date_separators)


DEFAULT = Contract()

CANONICAL = (
    "batch_date", "hospital", "person_id", "birth_year", "visit_id", "visit_date",
    "measurement_id", "measurement_date", "test_code", "value", "unit",
)


def site_date(column: Column, site: Column, separators: Mapping[str, str]) -> Column:
    """Calendar date written year-month-day with the site's separator, else null.

    The year may use any Unicode digits, the month only ASCII ones, the day may use
    them in its second place after 1 or 2; there is no year zero.
    """
    parsed = F.lit(None).cast("date")
    for name, separator in separators.items():
        shape = (
            rf"\p{{Nd}}{{4}}{separator}(?:0[1-9]|1[0-2]){separator}"
            r"(?:0[1-9]|[12]\p{Nd}|3[01])"
        )
        plain = F.replace(ascii_digits(column), F.lit(separator), F.lit("-"))
        parsed = F.when(
            (site == name) & full_match(column, shape) & ~plain.startswith("0000"),
            plain.try_cast("date"),
        ).otherwise(parsed)
    return parsed


def _batch_date(column: Column, site: Column, separators: Mapping[str, str], day: date) -> Column:
    """:func:`site_date`, with the usual case first: the text of the batch day itself."""
    usual = F.lit(False)
    for name, separator in separators.items():
        text = f"{day.year:04d}{separator}{day.month:02d}{separator}{day.day:02d}"
        usual = F.when(site == name, column == text).otherwise(usual)
    return F.when(usual, F.lit(day)).otherwise(site_date(column, site, separators))


def unit_factor(unit: Column, factors: Mapping[str, int]) -> Column:
    chain = F.lit(1)
    for name, factor in factors.items():
        if factor != 1:
            chain = F.when(unit == name, F.lit(factor)).otherwise(chain)
    return chain


def classify(
    rows: DataFrame,
    first_day: date,
    last_day: date | None = None,
    contract: Contract = DEFAULT,
) -> DataFrame:
    """Strip the contract columns and add ``reason`` (null = accepted) and parsed ``_`` columns.

    ``rows`` carries the delivered text columns plus ``hospital``.  An optional
    ``field_count`` column marks records with too many fields, an optional ``plain`` column
    rows without any blank to strip.  A delivery covers one day; ``last_day`` widens that to
    a window.
    """
    last_day = last_day or first_day
    site = F.col("hospital")
    counted = "field_count" in rows.columns
    missing = reduce(
        lambda a, b: a | b,
        [F.col(c).isNull() | (F.col(c) == "") for c in contract.columns],
    )
    plain = F.col("plain") if "plain" in rows.columns else F.lit(False)
    stripped = rows.withColumns({
        c: F.when(plain, F.col(c)).otherwise(strip(F.col(c))) for c in contract.columns
    })

    year_text = ascii_digits(F.col(contract.year_column))
    parsed = {
        f"_{c}": _batch_date(F.col(c), site, contract.date_separators, first_day)
        for c in contract.dates
    }
    parsed[f"_{contract.year_column}"] = F.when(
        full_match(year_text, "[0-9]{4}"), year_text.try_cast("int")
    )
    parsed[f"_{contract.value_column}"] = contract_decimal(
        F.col(contract.value_column), *contract.value_range,
        unit_factor(F.col(contract.unit_column), contract.unit_factors),
    )
    typed = stripped.withColumns(parsed)

    any_of = lambda tests: reduce(lambda a, b: a | b, tests)
    dates = [F.col(f"_{c}") for c in contract.dates]
    year = F.col(f"_{contract.year_column}")
    rules: list[tuple[Column, str]] = [
        (missing, "MISSING_FIELD"),
        (any_of(~full_match(F.col(c), contract.id_pattern) for c in contract.ids),
         "NON_SYNTHETIC_ID"),
        (any_of(~F.col(c).startswith(r.prefix) for c, r in contract.ids.items()), "ID_KIND"),
        (any_of(d.isNull() for d in dates), "INVALID_DATE"),
        (any_of(~d.between(F.lit(first_day), F.lit(last_day)) for d in dates),
         "OUTSIDE_BATCH_DATE"),
        (year.isNull() | ~year.between(contract.first_year, last_day.year),
         "INVALID_BIRTH_YEAR"),
        (~F.col(contract.code_column).isin(*contract.codes), "UNKNOWN_TEST_CODE"),
        (~F.col(contract.unit_column).isin(*contract.unit_factors), "UNKNOWN_UNIT"),
        (F.col(f"_{contract.value_column}").isNull(), "INVALID_NUMERIC_VALUE"),
    ]
    if counted:
        rules.insert(0, (F.col("field_count") > len(contract.columns), "COLUMN_COUNT"))
    chain = F.when(rules[0][0], rules[0][1])
    for test, reason in rules[1:]:
        chain = chain.when(test, reason)
    return typed.withColumn("reason", chain)


def canonical(classified: DataFrame, key: bytes, contract: Contract = DEFAULT,
              batch_date: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The eleven published columns; all null on rows the contract rejects.

    ``batch_date`` defaults to the first date column, which is right for one-day batches
    and for windows alike.
    """
    accepted = F.col("reason").isNull()
    if "kind" in classified.columns:
        accepted = accepted & (F.col("kind") == "row")
    only = lambda c: F.when(accepted, c)
    columns = {
        "batch_date": only(batch_date if batch_date is not None else F.col(f"_{contract.dates[0]}")),
        contract.year_column: only(F.col(f"_{contract.year_column}")),
        contract.code_column: only(F.col(contract.code_column)),
        "value": only(F.col(f"_{contract.value_column}")),
        contract.unit_column: only(F.lit(contract.canonical_unit)),
    }
    for name in contract.dates:
        columns[name] = only(F.col(f"_{name}"))
    for name, rule in contract.ids.items():
        columns[rule.target] = only(token(key, F.col("hospital"), rule.kind, F.col(name)))
    names = [c for c in CANONICAL if c != "hospital"]
    return classified.select(
        "hospital", *keep, "reason", *[columns[c].alias(c) for c in names]
    )


def strict_shape(contract: Contract, first_day: date, last_day: date | None = None) -> Column:
    """Plain-ASCII test that implies acceptance; rows failing it may still be accepted."""
    last_day = last_day or first_day
    tests = [full_match(F.col(c), rf"{r.prefix}[0-9]+") for c, r in contract.ids.items()]
    for name in contract.dates:
        shape = F.lit(False)
        for site, sep in contract.date_separators.items():
            text = F.replace(F.col(name), F.lit(sep), F.lit("-")).try_cast("date")
            shape = F.when(
                F.col("hospital") == site,
                full_match(F.col(name), rf"[0-9]{{4}}{sep}[0-9]{{2}}{sep}[0-9]{{2}}")
                & text.between(F.lit(first_day), F.lit(last_day)),
            ).otherwise(shape)
        tests.append(shape)
    year = F.col(contract.year_column)
    tests.append(full_match(year, "[0-9]{4}")
                 & year.try_cast("int").between(contract.first_year, last_day.year))
    tests.append(F.col(contract.code_column).isin(*contract.codes))
    tests.append(F.col(contract.unit_column).isin(*contract.unit_factors))
    value = F.col(contract.value_column)
    tests.append(full_match(value, r"[0-9]{1,5}(?:[.][0-9]{1,4})?")
                 & value.try_cast("decimal(18,4)").between(*contract.value_range))
    return F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False))
